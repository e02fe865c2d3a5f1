"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.session import run_dir

#: White space of every operator that splits words: space, tab, line feed, VT, FF, CR.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: a cut of lineage that outlives lost executors."""
    path = run_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(root: str):
    """The pyarrow file system of a shared folder, and the folder in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (Spark ignores case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str):
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut so that a slice's texts hold about ``limit`` bytes (one text at least)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: 64 bits to 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """n fixed random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(start, start + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def parts_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes reaches through the links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
