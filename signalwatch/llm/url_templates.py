"""URL filters by a tree of path templates per host.

A page's path is read segment by segment, digits of a segment as ``#``. At each node of a host's tree a segment that
holds a small share of a node with many children is variable and becomes ``*``; the others stay literal. Sibling branches
whose labelled shares of bad pages don't differ by a two-proportion test are merged into one branch ``{a|b}``; branches
without labels are merged with each other only, if what other hosts' labels say of them doesn't differ either. Below
``DEPTH`` segments the rest of a path is ``**`` only where no label can tell its pages apart: all pages of the node, and
all pages of any host with the node's path shapes, are without labels, or all labelled bad, or all labelled good.
Elsewhere the tree goes on to the paths' ends.

A template is rejected if its purity, the judged share of bad pages, reaches ``PURITY``. With labels of its own, it is
(bad + above * PRIOR_ROWS) / (labelled + PRIOR_ROWS), where above is its node's share, smoothed in the same way towards
the nodes above, the host and all labelled pages; a node that holds all labels of the one above adds nothing.
Without, it is judged by branches, not pages, since the labels below a branch are mostly one decision: a branch counts
labelled / (labelled + PRIOR_ROWS). From ``NEUTRAL``, which pages have labels being the rules' choice, the share is
smoothed with the labelled branches of the host and of each node on the way, then with the same path shape (the path
without merging) over all hosts, at the deepest level that has labels. A single labelled branch rejects no other.

Given rules come first: a rule (host, path) fits its host and all subdomains where the path begins with the rule's, and
the longest fitting rule decides. Pages that a rule decides are the labelled pages of the tree.

The tree is built from counts by (host, path). A node has few children once the rare ones are ``*``, so its windows are
small; the shuffles carry partial counts. A null url, or one without ``://``, has an empty host and path and is judged
like any other; repeated rows each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import LOWER, UPPER, stored

DEPTH = 6
#: A literal child holds this share of its node, or the node has at most FEW children.
SHARE, FEW = 0.05, 8
#: Standard deviations from which two branches differ.
DIFFER = 1.96
PRIOR_ROWS, PURITY = 5.0, 0.8
#: The share of bad pages where nothing is known.
NEUTRAL = 0.5
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> Column:
    return F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/", -1)


def _differ(n: Column, bad: Column, n2: Column, bad2: Column) -> Column:
    share = (bad + bad2) / (n + n2)
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(0.0)) * (1 / n + 1 / n2))
    return F.abs(bad / n - bad2 / n2) >= F.greatest(DIFFER * spread, F.lit(1e-9))


def _smooth(bad: Column, n: Column, towards: Column) -> Column:
    return (bad + towards * PRIOR_ROWS) / (n + PRIOR_ROWS)


def _weight() -> Column:
    return F.col("labelled") / (F.col("labelled") + PRIOR_ROWS)


def _bad_weight() -> Column:
    return F.coalesce(_weight() * F.try_divide(F.col("bad"), F.col("labelled")), F.lit(0.0))


#: What a node hands down: its smoothed share of bad pages and labels; the same by branches, with and without the node
#: itself; what the same shape has over all hosts.
HANDED = ("share", "held", "judged", "above", "lent", "lent_bad")


def build_templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For (host, path, label) rows, label 1 for bad, 0 for good, null for unknown: the template of each
    (host, path), and (host, template, n, labelled, bad, purity, rejected) of the templates."""
    rows = pages.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")
    )
    rows = stored(rows.withColumn("segments", _segments(F.col("path"))), "url-paths")
    labelled, bad = rows.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    start = (bad / labelled if labelled else 0.0, labelled, NEUTRAL, NEUTRAL, 0.0, 0.0)
    rows = rows.select("*", F.lit("").alias("template"), F.lit("").alias("shape"), *[F.lit(v).alias(c) for c, v in zip(HANDED, start, strict=True)])
    ended, depth = [], 0
    while not rows.isEmpty():
        if depth >= DEPTH:
            rows = _close(rows, depth)
            ended.append(rows.where("closed").drop("closed"))
            rows = rows.where("NOT closed").drop("closed")
        rows = _level(rows, depth)
        ended.append(rows.where(F.size("segments") <= depth))
        rows = rows.where(F.size("segments") > depth)
        depth += 1
    rows = functools.reduce(DataFrame.unionByName, ended, rows)
    templates = rows.groupBy("host", "template").agg(
        *[F.sum(c).alias(c) for c in ("n", "labelled", "bad")], *[F.max(c).alias(c) for c in HANDED]
    )
    own = F.when(F.col("labelled") == F.col("held"), F.col("share")).otherwise(_smooth(F.col("bad"), F.col("labelled"), F.col("share")))
    others = _smooth(F.col("lent_bad"), F.col("lent"), F.col("judged"))
    templates = templates.withColumn("purity", F.when(F.col("labelled") > 0, own).otherwise(others)).drop(*HANDED)
    templates = templates.withColumn("rejected", F.col("purity") >= PURITY)
    return rows.select("host", "path", "template"), templates


def _close(rows: DataFrame, depth: int) -> DataFrame:
    """The rows with ``closed``, and ``/**`` on the templates of closed rows: no label tells the node's pages apart."""
    kind = F.when(F.col("labelled") == 0, 0).when(F.col("labelled") < F.col("n"), 3)
    kind = kind.when(F.col("bad") == 0, 1).when(F.col("bad") == F.col("labelled"), 2).otherwise(3)
    # a row per node and shape, then per shape, then per node
    own = rows.groupBy("host", "template", "shape").agg(F.min(kind).alias("low"), F.max(kind).alias("high"))
    shapes = own.groupBy("shape").agg(F.min("low").alias("least"), F.max("high").alias("most"))
    nodes = own.join(shapes, "shape").groupBy("host", "template").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    nodes = nodes.select("host", "template", ((F.col("least") == F.col("most")) & (F.col("most") < 3)).alias("alike"))
    rows = rows.join(nodes, ["host", "template"]).withColumn("closed", F.col("alike") & (F.size("segments") > depth)).drop("alike")
    rest = F.when(F.col("closed"), F.lit("/**")).otherwise(F.lit(""))
    return stored(rows.withColumn("template", F.concat("template", rest)), f"url-closed{depth}")


def _level(rows: DataFrame, depth: int) -> DataFrame:
    """The rows with the templates of one more segment."""
    node = ["host", "template"]
    rows = rows.withColumn("segment", F.get("segments", F.lit(depth)))
    counts = rows.groupBy(*node, "shape", "segment").agg(
        *[F.sum(c).alias(c) for c in ("n", "labelled", "bad")], *[F.max(c).alias(c) for c in HANDED]
    )
    # distinct segments of a node in two steps: partial sums, no gathering of a node's children
    children = counts.groupBy(*node, "segment").agg(F.sum("n").alias("n"))
    nodes = children.groupBy(*node).agg(F.sum("n").alias("total"), F.count("*").alias("children"))
    keep = F.col("segment").isNull() | (F.col("children") <= FEW) | (F.col("n") >= F.col("total") * SHARE)
    kinds = children.join(nodes, node).select(*node, "segment", keep.alias("keep"))
    same = [F.col("c.host") == F.col("o.host"), F.col("c.template") == F.col("o.template"), F.col("c.segment").eqNullSafe(F.col("o.segment"))]
    sized = counts.alias("c").join(kinds.alias("o"), functools.reduce(Column.__and__, same)).select("c.*", "keep")
    piece = F.when(F.col("keep"), F.coalesce("segment", F.lit(""))).otherwise(F.lit("*"))
    ends = F.col("segment").isNull() & F.col("keep")
    sized = sized.select(
        *node, "labelled", "bad", *HANDED, piece.alias("piece"), ends.alias("ends"), (~F.col("keep")).alias("rare"),
        F.when(F.col("keep"), F.col("segment")).alias("segment"),
        F.when(ends, F.col("shape")).otherwise(F.concat("shape", F.lit("/"), piece)).alias("shape"),
    )
    child = [*node, "segment", "piece", "rare", "ends"]
    sums, handed = [F.sum(c).alias(c) for c in ("labelled", "bad")], [F.max(c).alias(c) for c in HANDED]
    shaped = stored(sized.groupBy(*child, "shape").agg(*sums, *handed), f"url-shapes{depth}")
    # a host counts once for a shape; rounded, as sums of doubles depend on their order
    lent = shaped.groupBy("host", "ends", "shape").agg(*sums).groupBy("ends", "shape").agg(
        F.round(F.sum(_weight()), 9).alias("new"), F.round(F.sum(_bad_weight()), 9).alias("new_bad")
    )
    pieces = shaped.join(lent, ["ends", "shape"]).groupBy(*child).agg(
        *sums, *handed, F.sum("new").alias("new"), F.sum("new_bad").alias("new_bad")
    )
    # at most FEW, or 1 / SHARE literals, and one wildcard per node
    known = F.col("labelled") > 0
    pieces = pieces.withColumn("rows", F.when(known, F.col("labelled")).otherwise(F.col("new")))
    pieces = pieces.withColumn("bad_rows", F.when(known, F.col("bad")).otherwise(F.col("new_bad")))
    order = Window.partitionBy(*node, "ends").orderBy(known, F.try_divide(F.col("bad_rows"), F.col("rows")), "piece")
    before, before_n, before_bad = (F.lag(c).over(order) for c in ("labelled", "rows", "bad_rows"))
    apart = before.isNull() | ((before > 0) != known) | ((before_n > 0) != (F.col("rows") > 0)) | (
        (F.col("rows") > 0) & F.coalesce(_differ(F.col("rows"), F.col("bad_rows"), before_n, before_bad), F.lit(False))
    )
    whole = Window.partitionBy(*node)
    branches = pieces.withColumn("apart", apart.cast("int")).withColumn("branch", F.sum("apart").over(order))
    sums_of = {"all": F.col("labelled"), "all_bad": F.col("bad"), "weight": _weight(), "bad_weight": _bad_weight()}
    branches = branches.withColumns({c: F.round(F.sum(x).over(whole), 9) for c, x in sums_of.items()})
    group = Window.partitionBy(*node, "ends", "branch")
    members = F.sort_array(F.collect_list("piece").over(group))
    name = F.when(F.size(members) > 1, F.concat(F.lit("{"), F.array_join(members, "|"), F.lit("}"))).otherwise(F.get(members, F.lit(0)))
    branches = branches.withColumns({"name": name, **{c: F.sum(c).over(group) for c in ("new", "new_bad")}})
    none, again = F.col("all") == 0, F.col("all") == F.col("held")
    above = F.when(none | again, F.col("above")).otherwise(F.col("judged"))
    values = {
        "share": F.when(none | again, F.col("share")).otherwise(_smooth(F.col("all_bad"), F.col("all"), F.col("share"))),
        "held": F.col("all"),
        "judged": F.when(none, F.col("judged")).otherwise(_smooth(F.col("bad_weight"), F.col("weight"), above)),
        "above": above,
        "lent": F.when(F.col("new") > 0, F.col("new")).otherwise(F.col("lent")),
        "lent_bad": F.when(F.col("new") > 0, F.col("new_bad")).otherwise(F.col("lent_bad")),
    }
    found = F.struct("name", *[v.alias(c) for c, v in values.items()])
    branches = stored(branches.select(*node, "segment", "rare", found.alias("found")), f"url-tree{depth}")
    kept = branches.where("NOT rare").select(*node, "segment", F.col("found").alias("own"))
    others = branches.where("rare").select(*node, F.col("found").alias("other"))
    same = [F.col("r.host") == F.col("k.host"), F.col("r.template") == F.col("k.template"), F.col("r.segment").eqNullSafe(F.col("k.segment"))]
    rows = rows.drop(*HANDED).alias("r").join(kept.alias("k"), functools.reduce(Column.__and__, same), "left").select("r.*", "own")
    rows = rows.alias("r").join(others.alias("k"), functools.reduce(Column.__and__, same[:2]), "left").select("r.*", "other")
    rows = rows.withColumn("found", F.coalesce("own", "other"))
    step = lambda x: F.when(F.col("segment").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), x))
    literal = F.when(F.col("own").isNotNull(), F.col("segment")).otherwise(F.lit("*"))
    return stored(
        rows.select(
            "host", "path", "n", "labelled", "bad", "segments", F.concat("template", step(F.col("found.name"))).alias("template"),
            F.concat("shape", step(literal)).alias("shape"), *[F.col(f"found.{c}").alias(c) for c in HANDED],
        ),
        f"url-level{depth}",
    )


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) per row of (page_id, url)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    ruled = stored(parsed.withColumn("rule", rule).withColumn("says", says), "url-rows")
    label = F.when(F.col("says") == "block", 1).when(F.col("says") == "allow", 0)
    paths, templates = build_templates(ruled.select("host", "path", label.alias("label")))
    of_path = paths.join(templates.select("host", "template", "purity", "rejected"), ["host", "template"])
    out = ruled.join(of_path, ["host", "path"], "left")
    own = F.when(F.col("rejected"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "template", "purity")
