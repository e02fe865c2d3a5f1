"""Secret scans by a trigram index, in DataFrame operations only.

Each rule is a regular expression. From its parse tree follow the literals that every match contains, as
alternatives of sequences, and from these a Boolean query over trigrams: any of the alternatives, each all of its
trigrams. The postings (trigram, document) hold the trigrams that the rules ask for; intersecting them gives a rule's
candidates, and the expression itself decides on these. A rule whose literals give no trigram scans all texts.

Trigrams are looked for in the lower-cased text and are lower-case themselves, so rules may ignore case.

Null and empty texts have no spans. Spans count code points, the end is exclusive; per rule they are leftmost and
don't overlap. Every row gives a row of its own text, rows that repeat or lack a doc_id included.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import stored

#: Alternatives that a part of an expression may have before it counts as unknown.
MANY = 16
#: Matches whose places are added up together.
RUN = 256


@dataclass(frozen=True)
class Rule:
    """A pattern for Java's and Python's expressions alike; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # whole runs are matched, so the least length may stand in the pattern
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # runs are read once: a token begins where its run does, a scheme has 32 characters at most, and nothing is given back
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,31}+://[^\s/:@]++:[^\s/:@]++@"),
)


def literals(pattern: str) -> list[list[str]]:
    """Alternatives; each is a list of literals that a match contains, in order."""

    def product(parts):
        out = [[""]]
        for alternatives in parts:
            if len(out) * len(alternatives) > MANY:
                alternatives = [["", ""]]
            joined = []
            for left in out:
                for right in alternatives:
                    joined.append([*left[:-1], left[-1] + right[0], *right[1:]])
            out = joined
        return out

    def of(tree):
        parts = []
        for op, value in tree:
            name = str(op)
            if name == "LITERAL":
                parts.append([[chr(value).lower()]])
            elif name == "IN" and len(value) <= 6 and all(str(o) == "LITERAL" for o, _ in value):
                parts.append([[chr(v).lower()] for _, v in value])
            elif name == "SUBPATTERN":
                parts.append(of(value[-1]))
            elif name == "BRANCH":
                # parsed branches share their common beginning, which precedes them in the tree
                parts.append([a for branch in value[1] for a in of(branch)])
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                low, high, inner = value
                if high == 1:
                    parts.append([[""], *of(inner)])
                elif low:
                    parts.append(product([of(inner)] * min(low, 3) + [[["", ""]]] * (high != low or low > 3)))
                else:
                    parts.append([["", ""]])
            elif name == "AT":
                continue
            else:
                parts.append([["", ""]])
        return product(parts)

    return of(parser.parse(pattern))


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Any of the lists, all trigrams of a list; None if some alternative has no trigram."""
    out = []
    for parts in literals(pattern):
        grams = sorted({p[i : i + 3] for p in parts for i in range(len(p) - 2) if p.isascii()})
        if not grams:
            return None
        if grams not in out:
            out.append(grams)
    return out


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(trigram, row_id) of the asked trigrams, from (row_id, text)."""
    low = F.lower("text")
    held = F.filter(
        F.array(*[F.when(F.contains(F.col("low"), F.lit(g)), F.lit(g)) for g in grams]), lambda g: g.isNotNull()
    )
    rows = docs.select("row_id", low.alias("low")).select("row_id", held.alias("grams"))
    # outer: else the planner tests the arrays below this, where it would lower the text for each trigram
    return rows.select("row_id", F.explode_outer("grams").alias("trigram")).where("trigram IS NOT NULL")


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(row_id, kinds): the rules whose trigram query the document's postings satisfy."""
    held = index.groupBy("row_id").agg(F.collect_set("trigram").alias("grams"))
    kinds = []
    for rule in rules:
        query = trigram_query(rule.pattern) or []
        fits = [F.size(F.array_intersect("grams", F.array(*map(F.lit, all_of)))) == len(all_of) for all_of in query]
        met = fits[0]
        for f in fits[1:]:
            met = met | f
        kinds.append(F.when(met, F.lit(rule.kind)))
    found = F.filter(F.array(*kinds), lambda k: k.isNotNull())
    return held.select("row_id", found.alias("kinds")).where(F.size("kinds") > 0)


def _spans(rule: Rule, rank: int) -> Column:
    """The text's matches of one rule, as (start, rank, kind, end), in order.

    The texts between the matches give the places. They are added up in runs of ``RUN`` matches, each
    run from the end of the one before, so a text with very many matches takes linear time.
    """
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    pieces = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("own"), tested.alias("tested")),
        lambda x: F.struct(F.length(x.gap).alias("gap"), F.length(x.own).alias("own"), F.length(x.tested).alias("tested")),
    )
    # the text behind the last match is a piece without a match
    runs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(pieces) / RUN).cast("int")),
        lambda i: F.slice(pieces, i * RUN + 1, RUN),
    )
    span = "struct<start:int,rank:int,kind:string,end:int,tested:int>"

    def place(acc: Column, x: Column) -> Column:
        start = acc.at + x.gap
        end = start + F.coalesce(x.own, F.lit(0))
        made = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"), x.tested.alias("tested"))
        return F.struct(end.alias("at"), F.concat(acc.out, F.array(made)).alias("out"))

    def run(acc: Column, part: Column) -> Column:
        start = F.struct(acc.at.alias("at"), F.array().cast(f"array<{span}>").alias("out"))
        return F.aggregate(
            part, start, place, lambda a: F.struct(a.at.alias("at"), F.concat(acc.out, F.array(a.out)).alias("out"))
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{span}>>").alias("out"))
    placed = F.flatten(F.aggregate(runs, start, run, lambda a: a.out))
    return F.when(F.rlike(text, F.lit(rule.pattern)), F.filter(placed, lambda x: x.tested >= rule.least))


def scan(docs: DataFrame, base=BASE, more=MORE) -> DataFrame:
    """(doc_id, spans) per row: the spans (start, rank, kind, end) by start, then in the order of the rules."""
    rules = [*base, *more]
    indexed = [r for r in rules if trigram_query(r.pattern) is not None]
    grams = sorted({g for r in indexed for all_of in trigram_query(r.pattern) for g in all_of})
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row_id", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))
    found = stored(candidates(postings(rows, grams), indexed), "secret-candidates")
    asked = rows.join(found.withColumnRenamed("row_id", "c_row"), F.col("row_id") == F.col("c_row"), "left")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,tested:int>>")
    spans = []
    for rank, rule in enumerate(rules):
        own = _spans(rule, rank)
        if rule in indexed:
            own = F.when(F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), rule.kind), own)
        spans.append(F.coalesce(own, none))
    return asked.select("doc_id", F.array_sort(F.flatten(F.array(*spans))).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
