"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A document's size is its number of words. Sources, by code point with null last, share ``share`` of all
sizes by weight; a target stops at ``limit`` times its source's size and the excess is shared anew. A document is to be taken
target / source size times: its whole part for sure, and once more with its fractional probability.

The rounding pairs documents of a source and moves words between their probabilities until one of them is
0 or 1, in a direction drawn so that no probability changes on average. The sum of probability times size
stays as it is, so a source's words miss their target by the rounding of one document at most. Blocks of
about ``BLOCK`` documents are rounded side by side, each leaves at most one document open, and these
are dealt to blocks anew, as a reduction tree of a few levels. The document left at the root is rounded by
a draw, and the words it gains or loses pass on to the source's smallest documents, which stay out of the
tree for that: each, from the larger to the smaller, is rounded to the side that leaves the least. Draws are hashes of the document, so reruns agree.

Null texts have size 0, documents without words are taken their whole part of times, which is no words. Rows that agree in
doc_id, source and size are rounded as one. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import WORD, col, fresh, stored

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 64
#: A source's smallest documents that settle what the tree leaves: so many, a quarter of the source at most.
DUST = 32


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, n_units, target) from (source, size, rows) units.

    A source is full where its limit is at most its part of what the fuller sources leave; with sources in
    the order of limit over weight, the common level is the largest such part.
    """
    own = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n_units")
    )
    # A row per source; sources are few.
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    own = own.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    own = own.withColumn("cap", F.col("source_size") * limit)
    total = F.sum("source_size").over(Window.partitionBy())
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    own = own.withColumn("level", (F.least(total * share, total * limit) - before) / rest)
    level = F.max("level").over(Window.partitionBy())
    return own.select("source", "source_size", "n_units", F.least("cap", level * F.col("weight")).alias("target"))


def _pair(a: Column, b: Column) -> Column:
    """Both documents after words have moved between them until one is 0 or 1."""
    give_a = F.least((1 - a.p) * a.w, b.p * b.w)  # a up, b down
    give_b = F.least(a.p * a.w, (1 - b.p) * b.w)  # a down, b up
    up = b.u * (give_a + give_b) < give_b
    to_a, to_b = (1 - a.p) * a.w, (1 - b.p) * b.w
    from_a, from_b = a.p * a.w, b.p * b.w
    zero, one = F.lit(0.0), F.lit(1.0)
    p_a = F.when(up, F.when(to_a <= from_b, one).otherwise(a.p + from_b / a.w)).otherwise(
        F.when(from_a <= to_b, zero).otherwise(a.p - to_b / a.w)
    )
    p_b = F.when(up, F.when(from_b <= to_a, zero).otherwise(b.p - to_a / b.w)).otherwise(
        F.when(to_b <= from_a, one).otherwise(b.p + from_a / b.w)
    )
    return F.array(_unit(a, p_a), _unit(b, p_b))


def _unit(x: Column, p: Column) -> Column:
    return F.struct(x.w.alias("w"), x.u.alias("u"), x.doc_id.alias("doc_id"), x.size.alias("size"), p.alias("p"))


UNIT = "struct<w:double,u:double,doc_id:string,size:bigint,p:double>"


def _round_block(units: Column) -> Column:
    """The block's documents with p 0 or 1, all but at most one."""
    is_open = lambda x: (x.p > 0) & (x.p < 1)
    start = F.struct(
        F.lit(None).cast(UNIT).alias("held"), F.array().cast(f"array<{UNIT}>").alias("done")
    )

    def step(acc: Column, unit: Column) -> Column:
        both = F.when(acc.held.isNull(), F.array(unit)).otherwise(_pair(acc.held, unit))
        # one element: a way to name a value inside a lambda
        after = F.transform(
            F.array(both),
            lambda pair: F.struct(
                F.get(F.filter(pair, is_open), F.lit(0)).alias("held"),
                F.concat(acc.done, F.filter(pair, lambda x: ~is_open(x))).alias("done"),
            ),
        )
        return F.get(after, F.lit(0))

    return F.aggregate(units, start, step, lambda acc: F.struct(acc.done.alias("done"), acc.held.alias("held")))


def _settle(units: Column) -> Column:
    """The units, largest first, rounded one by one; what one gains or loses the next make good."""

    def step(acc: Column, x: Column) -> Column:
        due = x.p * x.w + acc.debt
        up = F.when(x.drawn, x.u < x.p).otherwise(due * 2 >= x.w)
        return F.struct(
            (due - F.when(up, x.w).otherwise(0.0)).alias("debt"),
            F.concat(acc.done, F.array(F.struct(x.doc_id.alias("doc_id"), x.size.alias("size"), up.alias("up")))).alias("done"),
        )

    start = F.struct(
        F.lit(0.0).alias("debt"), F.array().cast("array<struct<doc_id:string,size:bigint,up:boolean>>").alias("done")
    )
    return F.aggregate(units, start, step, lambda acc: acc.done)


def _draw(salt: int) -> Column:
    bits = F.xxhash64("doc_id", "source", "size", F.lit(salt))
    return F.pmod(bits, F.lit(1 << 52)).cast("double") / float(1 << 52)


def copies(sizes: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies) of (doc_id, source, size, rows) units."""
    plan = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("ratio", ratio).withColumn("whole", F.floor("ratio"))
    plan = stored(plan.withColumn("p", F.col("ratio") - F.col("whole")).drop("ratio"), "mix-plan")
    n = plan.agg(F.max("n_units")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(n, 2), BLOCK // 2)))
    is_open = (F.col("p") > 0) & (F.col("size") > 0)
    open_ = plan.where(is_open).select(
        "source", "n_units", (F.col("size") * F.col("rows")).cast("double").alias("w"),
        F.col("doc_id").cast("string").alias("doc_id"), "size", "p",
    )
    # a few rows per task and source reach the window
    nth = F.row_number().over(Window.partitionBy("source").orderBy("w", "size", "doc_id"))
    dust = open_.withColumn("nth", nth).where(F.col("nth") <= DUST).where(F.col("nth") <= F.col("n_units") / 4)
    dust = stored(dust.drop("nth"), "mix-dust")
    kept_out = dust.select("source", "size", "doc_id", F.lit(True).alias("dust"))
    is_dust = (
        open_["source"].eqNullSafe(kept_out["source"]) & open_["doc_id"].eqNullSafe(kept_out["doc_id"])
        & (open_["size"] == kept_out["size"])
    )
    open_ = open_.join(kept_out, is_dust, "left_anti")
    done = []
    for level in range(levels + 1):
        blocks = F.greatest(F.ceil(F.col("n_units") / float((BLOCK // 2) ** (level + 1))), F.lit(1))
        if level == levels:
            blocks = F.lit(1)
        block = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed + level)), blocks)
        unit = F.struct("w", _draw(seed + 100 + level).alias("u"), "doc_id", "size", "p")
        rounded = (
            open_.groupBy("source", "n_units", block.alias("block"))
            .agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
            .select("source", "n_units", _round_block(F.col("units")).alias("r"))
        )
        rounded = stored(rounded, f"mix-level{level}")
        done.append(rounded.select("source", F.explode("r.done").alias("x")))
        open_ = rounded.where("r.held IS NOT NULL").select("source", "n_units", "r.held.*").drop("u")
    root = open_.withColumn("drawn", F.lit(True)).unionByName(dust.withColumn("drawn", F.lit(False)))
    root = root.withColumn("order", F.when(F.col("drawn"), math.inf).otherwise(F.col("w")))
    unit = F.struct("order", "w", _draw(seed + 99).alias("u"), "doc_id", "size", "p", "drawn")
    last = root.groupBy("source").agg(_settle(F.sort_array(F.collect_list(unit), asc=False)).alias("done"))
    settled = last.select("source", F.explode("done").alias("x")).select(
        "source", "x.doc_id", "x.size", F.col("x.up").cast("double").alias("up")
    )
    for rows in done:
        settled = settled.unionByName(rows.select("source", "x.doc_id", "x.size", F.col("x.p").alias("up")))
    settled = settled.where("up >= 0.5").select(
        F.col("source").alias("s_source"), F.col("doc_id").alias("s_doc"), F.col("size").alias("s_size"), F.lit(1).alias("more")
    )
    same = (
        F.col("doc_id").cast("string").eqNullSafe(F.col("s_doc"))
        & F.col("source").eqNullSafe(F.col("s_source")) & (F.col("size") == F.col("s_size"))
    )
    out = plan.join(settled, same, "left")
    return out.select(
        "doc_id", "source", "size", "rows", "source_size", "target",
        (F.col("whole") + F.coalesce("more", F.lit(0))).cast("long").alias("copies"),
    )


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0, seed: int = 17) -> DataFrame:
    """How often each distinct (doc_id, source, size) is taken, and by how many ``rows`` it is held."""
    sizes = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    sizes = stored(sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "mix-sizes")
    # a table of its own, so that the planner knows how small it is
    targets = stored(source_targets(sizes, weights, share, limit), "mix-targets")
    return copies(sizes, targets, seed)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with its own columns."""
    plan = plan_mix(docs, **options)
    size, m_doc, m_source, m_size, m_copies = fresh(docs, "size", "m_doc", "m_source", "m_size", "m_copies")
    plan = plan.where("copies > 0").select(
        F.col("doc_id").alias(m_doc), F.col("source").alias(m_source), F.col("size").alias(m_size),
        F.col("copies").alias(m_copies),
    )
    rows = docs.withColumn(size, words(col("text")))
    same = (
        rows["doc_id"].eqNullSafe(plan[m_doc]) & rows["source"].eqNullSafe(plan[m_source]) & (rows[size] == plan[m_size])
    )
    taken = rows.join(plan, same)
    [copy] = fresh(taken, "copy")
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), col(m_copies).cast("int")))).select(*map(col, docs.columns))
