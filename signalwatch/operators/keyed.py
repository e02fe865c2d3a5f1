"""Joins and frames that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

# Positions per block of a series.  Also the most rows a window task holds per key and block for a
# series with one row per position.
BLOCK = 4096

# Blocks whose offsets one window adds up.
BLOCKS = 4096


def attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add per-key statistics to each row; NULL is a key like any other.

    No hint: the size of ``stats`` grows with the number of keys, so adaptive execution decides by
    measured size whether to broadcast it, and splits skewed keys when it does not.
    """
    renamed = stats.withColumnsRenamed({k: f"_stat_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_stat_{k}")) for k in keys]
    return df.join(renamed, same, "left").drop(*[f"_stat_{k}" for k in keys])


def trailing(
    df: DataFrame,
    pos: str,
    reach: int,
    by: list[str],
    exprs: dict[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Add columns computed over frames that look back at most ``reach`` positions.

    ``pos`` is an integer column.  Each key's series is cut into blocks of positions and every block
    also gets a copy of the ``reach`` positions before it, so that all its frames are complete; the
    copies are dropped afterwards.  One long or hot series is thus spread over many tasks, and a frame
    without keys does not end in a single task.  Blocks are at least four times as long as the reach,
    so at most a quarter of the rows is copied.
    """
    block = max(BLOCK, 4 * reach)
    copied = df.withColumn(
        "_block",
        F.explode(
            F.sequence(
                F.floor(F.col(pos) / block), F.floor((F.col(pos) + reach) / block)
            )
        ),
    )
    window = Window.partitionBy(*by, "_block").orderBy(pos)
    return (
        copied.withColumns({name: expr(window) for name, expr in exprs.items()})
        .where(F.col("_block") == F.floor(F.col(pos) / block))
        .drop("_block")
    )


def number_places(
    df: DataFrame, order: list[str], by: list[str] = (), name: str = "_pos"
) -> DataFrame:
    """Number each key's places 1, 2, ... in order; rows at one place share its number.

    Rows are numbered within blocks (a day, or 4096 consecutive values, of the first order column) by a
    sort that the rows stay in, and shifted by the places in the key's earlier blocks.  These offsets have a row per key
    and block; they are themselves added up in groups of ``BLOCKS`` blocks, and then over the groups.
    """
    lead = order[0]
    kind = df.schema[lead].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        block = F.unix_date(F.col(lead).cast("date"))
    elif isinstance(kind, IntegralType):
        block = F.floor(F.col(lead) / BLOCK)
    else:
        raise ValueError(f"the first order column must be a time or an integer: {lead}")
    by, places = list(by), [*by, *[c for c in order if c not in by]]
    chunk = {"_chunk": block, "_group": F.floor(block / BLOCKS)}
    sizes = (
        df.select(*places).distinct().withColumns(chunk)
        .groupBy(*by, "_group", "_chunk").agg(F.count("*").alias("_size"))
    )
    groups = sizes.groupBy(*by, "_group").agg(F.sum("_size").alias("_total"))
    before = Window.unboundedPreceding, -1
    # one row per key and group of blocks
    in_key = Window.partitionBy(*by).orderBy("_group").rowsBetween(*before)
    groups = groups.withColumn("_base", F.coalesce(F.sum("_total").over(in_key), F.lit(0)))
    in_group = Window.partitionBy(*by, "_group").orderBy("_chunk").rowsBetween(*before)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(in_group), F.lit(0)))
    offsets = attach(sizes.drop("_size"), groups.drop("_total"), [*by, "_group"])
    local = F.dense_rank().over(Window.partitionBy(*by, "_group", "_chunk").orderBy(*order))
    ranked = df.withColumns(chunk).withColumn("_local", local)
    return (
        attach(ranked, offsets, [*by, "_group", "_chunk"])
        .withColumn(name, F.col("_local") + F.col("_before") + F.col("_base"))
        .drop("_chunk", "_group", "_local", "_before", "_base")
    )
