"""Line de-duplication across documents by a sharded minimal perfect hash.

A line's key is the line without white space at its ends, in lower case; it is known by a 128-bit hash. All distinct
hashes are dealt to shards. A shard is a perfect hash with arrays by place: a 32-bit fingerprint, the number
of documents with the line, and the smallest of them. Documents don't join lines: they send (hash, document)
to the shard, which probes its arrays and answers with the lines that the document loses.

Lines that at least one in ``HOT`` of all (line, document) rows hold are at most ``HOT`` many; they go to all tasks as
a small table, so no shard gets more than a few of such rows from any one line. A shard whose lines have more than
``SHARD_ROWS`` rows is copied, and its rows are dealt among the copies.

Null texts count as empty: one empty line. A null doc_id counts as one document, after all others. Rows that
share a doc_id are one document: a line that only they hold stays. Repeated rows all stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalwatch.llm.common import SPACES, col, fresh, stored
from signalwatch.llm.mph import PerfectHash

#: Code points from which a line's key counts.
MIN_CHARS = 10
HOT = 2048
#: Distinct lines per shard, on average.
SHARD_LINES = 100_000
#: Asked rows per copy of a shard, on average.
SHARD_ROWS = 1_000_000
LAST = 2**63 - 1


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key; None for one too short to count."""
    key = line.strip(SPACES)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def document_lines(docs: DataFrame, min_chars: int, known=None) -> DataFrame:
    """(h1, h2, doc): the distinct line keys of each row, without those in ``known`` (a broadcast value)."""

    def run(batches):
        for batch in batches:
            keys, owners = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {line_key(x, min_chars) for x in (text or "").encode().split(b"\n")} - {None}
                if known is not None:
                    own -= known.value.keys()
                keys += own
                owners += [doc] * len(own)
            if keys:
                h1, h2 = _halves(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), pa.array(owners, pa.int64())], names=["h1", "h2", "doc"]
                )

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select(doc.alias("doc"), "text").mapInArrow(run, "h1 long, h2 long, doc long")


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, first, n, held): each distinct line's smallest document, the rows that hold it, as n 1 if of one document."""
    counts = document_lines(docs, min_chars).groupBy("h1", "h2").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("held")
    )
    n = F.when(F.col("last") > F.col("first"), F.col("held")).otherwise(1)
    return counts.select("h1", "h2", "first", n.alias("n"), "held")


def build_shards(lines: DataFrame, n_shards: int, hot: int) -> DataFrame:
    """One row per shard: the perfect hash and its arrays, as bytes, and the number of its copies."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64)
        index = PerfectHash.build(a, b)
        place = index.find(a, b)
        prints, n, first = np.empty(len(a), np.uint32), np.empty(len(a), np.uint32), np.empty(len(a), np.int64)
        prints[place] = b.astype(np.uint32)
        n[place] = np.minimum(rows["n"].to_numpy(), 2**32 - 1)
        first[place] = rows["first"].to_numpy()
        return pd.DataFrame(
            {"shard": [rows["shard"].iloc[0]], "index": [index.to_bytes()], "prints": [prints.tobytes()],
             "counts": [n.tobytes()], "firsts": [first.tobytes()], "copies": [max(1, -(-int(rows["asked"].sum()) // shard_rows))]}
        )

    shard_rows = SHARD_ROWS
    # lines of hot rows or more ask no shard
    asked = F.when(F.col("held") < hot, F.col("held")).otherwise(0)
    dealt = lines.withColumn("asked", asked).drop("held").withColumn("shard", F.pmod("h1", F.lit(n_shards)))
    schema = "shard long, index binary, prints binary, counts binary, firsts binary, copies long"
    return dealt.groupBy("shard").applyInPandas(build, schema)


def probe(shards: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc, h1) of the asked (h1, h2, doc, shard, copy) rows whose line an earlier document holds."""

    def look(rows: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or arrays.empty:
            return pd.DataFrame({"doc": pd.Series(dtype="int64"), "h1": pd.Series(dtype="int64")})
        index = PerfectHash.from_bytes(arrays["index"].iloc[0])
        prints = np.frombuffer(arrays["prints"].iloc[0], np.uint32)
        n = np.frombuffer(arrays["counts"].iloc[0], np.uint32)
        first = np.frombuffer(arrays["firsts"].iloc[0], np.int64)
        a, b = rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64)
        place = index.find(a, b)
        hit = place >= 0
        at = np.where(hit, place, 0)
        hit &= (prints[at] == b.astype(np.uint32)) & (n[at] > 1) & (first[at] < rows["doc"].to_numpy())
        return rows.loc[hit, ["doc", "h1"]]

    copies = shards.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return asked.groupBy("shard", "copy").cogroup(copies.groupBy("shard", "copy")).applyInPandas(look, "doc long, h1 long")


def deal(asked: DataFrame, shards: DataFrame, n_shards: int) -> DataFrame:
    """The (h1, h2, doc) rows with their shard and its copy."""
    # of shards with several copies there are fewer than one per SHARD_ROWS rows
    several = F.broadcast(shards.where("copies > 1").select("shard", "copies"))
    rows = asked.withColumn("shard", F.pmod("h1", F.lit(n_shards))).join(several, "shard", "left")
    copy = F.pmod(F.xxhash64("doc", "h1"), F.coalesce("copies", F.lit(1)).cast("long"))
    return rows.select("h1", "h2", "doc", "shard", copy.alias("copy"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, out: str = "text") -> DataFrame:
    """The documents with the kept lines in ``out``, and ``n_lines`` and ``n_dropped`` (lengthened if taken).

    Keys of at least ``min_chars`` code points that two documents hold lose all their lines except in the
    smallest doc_id holding them. Other columns pass through.
    """
    spark = docs.sparkSession
    lines = stored(line_counts(docs, min_chars), "line-counts")
    distinct, held = lines.agg(F.count("*"), F.sum("held")).first()
    n_shards = max(1, -(-distinct // SHARD_LINES))
    least = max(2, -(-(held or 0) // HOT))
    # at most HOT rows: their counts sum to no more than all
    hot = {
        r["h1"].to_bytes(8, "little", signed=True) + r["h2"].to_bytes(8, "little", signed=True): r["first"]
        for r in lines.where(F.col("held") >= least).collect()
    }
    known = spark.sparkContext.broadcast(hot)
    shards = stored(build_shards(lines, n_shards, least), "line-shards")

    asked = document_lines(docs, min_chars, known)
    lost = probe(shards, deal(asked, shards, n_shards))
    drops, doc, n_lines, n_dropped = fresh(docs, "drops", "doc_key", "n_lines", "n_dropped")
    lost = lost.groupBy(F.col("doc").alias(doc)).agg(F.collect_set("h1").alias(drops))
    keyed = docs.withColumn(doc, F.coalesce(col("doc_id").cast("long"), F.lit(LAST)))
    joined = keyed.join(lost, doc, "left")
    columns = [*docs.columns] + ([out] if out not in docs.columns else [])
    at = {c: i for i, c in enumerate(joined.columns)}
    at_text, at_doc, at_drops = at["text"], at[doc], at[drops]

    def cut(batches):
        for batch in batches:
            texts, total, gone = [], [], []
            triples = (batch.column(i).to_pylist() for i in (at_doc, at_text, at_drops))
            for own, text, drop in zip(*triples, strict=True):
                lines = (text or "").encode().split(b"\n")
                drop, kept = set(drop or ()), []
                for line in lines:
                    key = line_key(line, min_chars)
                    if key is not None:
                        first = known.value.get(key)
                        if (own > first) if first is not None else (int.from_bytes(key[:8], "little", signed=True) in drop):
                            continue
                    kept.append(line)
                texts.append(b"\n".join(kept).decode())
                total.append(len(lines))
                gone.append(len(lines) - len(kept))
            made = {out: pa.array(texts, pa.string()), n_lines: pa.array(total, pa.int64()), n_dropped: pa.array(gone, pa.int64())}
            names = [*columns, n_lines, n_dropped]
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else batch.column(at[n]) for n in names], names=names
            )

    fields = {f.name: f for f in docs.schema.fields}
    schema = StructType()
    for c in columns:
        schema = schema.add(c, "string") if c == out else schema.add(fields[c])
    return joined.mapInArrow(cut, schema.add(n_lines, "long").add(n_dropped, "long"))
