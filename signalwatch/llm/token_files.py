"""Token ids in binary files in ascending key order, with a minimal perfect hash from keys to places.

A shard is one file: a header, the ids as unsigned 16- or 32-bit little-endian integers, and an index: a minimal
perfect hash of the shard's keys, per place a 32-bit fingerprint of the key and the key's rank in the file, and the
offsets by rank. Looking a key up takes one hash, one compare and one read, however many keys there are.

Keys are (doc_id, occurrence): rows that repeat a doc_id follow each other, ordered by their ids, and count from 0. A null
doc_id is a key of its own and comes first. Null and empty texts hold the end id alone.

Files are written into the shared folder through pyarrow's file systems, under a name of the attempt, then
moved to their place: a task that runs again writes the same bytes. Shards end at ``shard_bytes`` of
ids or ``shard_docs`` keys, so neither writer nor reader holds more than one shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.bpe import SLICE, encoder, load
from signalwatch.llm.common import file_system, mix, slices, stored
from signalwatch.llm.mph import PerfectHash
from signalwatch.session import run_dir

MAGIC = b"TOKS0001"
SHARD_BYTES = 32 << 20
SHARD_DOCS = 200_000
NULL_KEY = np.uint64(1) << np.uint64(63)


def key_parts(ids: np.ndarray, null: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key as the two numbers that the hash takes."""
    return ids.astype(np.int64).view(np.uint64), occurrence.astype(np.uint64) | np.where(null, NULL_KEY, np.uint64(0))


def fingerprints(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a ^ mix(b + np.uint64(7))) >> np.uint64(32)).astype(np.uint32)


def shard_bytes(a: np.ndarray, b: np.ndarray, counts: np.ndarray, payload: bytes, width: int) -> bytes:
    """A shard's file for keys in file order, with each key's count of ids."""
    index = PerfectHash.build(a, b)
    place = index.find(a, b)
    rank, prints = np.empty(len(a), np.uint32), np.empty(len(a), np.uint32)
    rank[place], prints[place] = np.arange(len(a), dtype=np.uint32), fingerprints(a, b)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64)
    packed = index.to_bytes()
    head = MAGIC + struct.pack("<IQQQ", width, len(payload), len(a), len(packed))
    return b"".join([head, payload, packed, prints.tobytes(), rank.tobytes(), offsets.tobytes()])


class Shard:
    """A shard read back: ``find`` gives places in ids, ``ids`` the ids of one of them."""

    def __init__(self, raw: bytes):
        at = len(MAGIC) + struct.calcsize("<IQQQ")
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        width, size, n, packed = struct.unpack_from("<IQQQ", raw, len(MAGIC))
        self.payload = np.frombuffer(raw, f"<u{width}", size // width, at)
        at += size
        self.index = PerfectHash.from_bytes(raw[at : at + packed])
        at += packed
        self.prints = np.frombuffer(raw, "<u4", n, at)
        self.rank = np.frombuffer(raw, "<u4", n, at + 4 * n)
        self.offsets = np.frombuffer(raw, "<u8", n + 1, at + 8 * n).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each key's ids; -1 for a key that the shard doesn't hold."""
        place = self.index.find(a, b)
        known = place >= 0
        known[known] = self.prints[place[known]] == fingerprints(a[known], b[known])
        start, end = np.full(len(a), -1, np.int64), np.full(len(a), -1, np.int64)
        rank = self.rank[place[known]].astype(np.int64)
        start[known], end[known] = self.offsets[rank], self.offsets[rank + 1]
        return start, end

    def ids(self, start: int, end: int) -> np.ndarray:
        return self.payload[start:end].astype("<u4")


def write_ids(docs: DataFrame, tokenizer: str, end_id: int | None = 0, parts: int | None = None) -> tuple[str, DataFrame, DataFrame]:
    """Encode (doc_id, text) rows and write the files; the folder, the shards and the keys.

    The shards are (shard, file, n_docs, n_ids, start), ``start`` the ids of all shards before. The keys are
    (doc_id, occurrence, shard). Rows are dealt by ranges of doc_id, cut at quantiles of the ids alone, so
    texts are encoded once and moved once, as packed ids.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    root = run_dir(spark, "token-files")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20_000)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))
    width = 2 if max(load(tokenizer)["model"]["vocab"].values()) < 1 << 16 else 4
    tail = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()

    def encode(batches):
        own = encoder(tokenizer)
        for whole in batches:
            for batch in slices(whole, 1, SLICE):
                ids, ends = own.encode_all(batch.column(1))
                raw, at = ids.astype(f"<u{width}").tobytes(), (ends * width).tolist()
                payload = [raw[s:e] + tail for s, e in zip(at, at[1:], strict=False)]
                keys = batch.column(0)
                part = 1 + np.searchsorted(bounds, keys.fill_null(0).to_numpy(), side="right")
                part[keys.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(part, pa.int32()), pa.array(payload, pa.binary())],
                    names=["doc_id", "part", "payload"],
                )

    def write(batches):
        disk, folder = file_system(root)
        disk.create_dir(folder, recursive=True)
        held: list = []
        state = {"part": None, "no": 0, "bytes": 0, "last": None, "seen": 0}

        def flush():
            if not held:
                return None
            shard = int(state["part"]) << 24 | state["no"]
            null = np.array([k is None for k, _, _ in held])
            ids = np.array([k or 0 for k, _, _ in held], np.int64)
            a, b = key_parts(ids, null, np.array([o for _, o, _ in held], np.int64))
            counts = np.array([len(p) // width for _, _, p in held], np.int64)
            raw = shard_bytes(a, b, counts, b"".join(p for _, _, p in held), width)
            file, attempt = f"{shard:016x}.tok", f"{folder}/.{uuid.uuid4().hex}"
            with disk.open_output_stream(attempt) as out:
                out.write(raw)
            disk.move(attempt, f"{folder}/{file}")
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in held], pa.int64()),
                    pa.array([o for _, o, _ in held], pa.int64()),
                    pa.array(np.full(len(held), shard), pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["doc_id", "occurrence", "shard", "n_ids"],
            )
            held.clear()
            state["no"], state["bytes"] = state["no"] + 1, 0
            return rows

        for batch in batches:
            for key, part, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fresh_part = part != state["part"]
                if held and (fresh_part or state["bytes"] >= SHARD_BYTES or len(held) >= SHARD_DOCS):
                    yield flush()
                if fresh_part:
                    state |= {"part": part, "no": 0, "last": object(), "seen": 0}
                state["seen"] = state["seen"] + 1 if key == state["last"] else 0
                state["last"] = key
                held.append((key, state["seen"], payload))
                state["bytes"] += len(payload)
        if held:
            yield flush()

    packed = docs.mapInArrow(encode, "doc_id long, part int, payload binary")
    dealt = packed.repartition(parts, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "payload")
    keys = stored(dealt.mapInArrow(write, "doc_id long, occurrence long, shard long, n_ids long"), "token-keys")
    shards = keys.groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
    # One row per shard, tens of megabytes of ids each.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    shards = shards.withColumn("file", F.concat(F.lpad(F.lower(F.hex("shard")), 16, "0"), F.lit(".tok")))
    return root, stored(shards, "token-shards"), keys.drop("n_ids")


def read_ids(root: str, shards: DataFrame, keys: DataFrame, digest: bool = False) -> DataFrame:
    """Look (doc_id, occurrence, shard) rows up in the files: start, n_tokens, and the ids or their crc32.

    Each task reads whole shards, one at a time; the perfect hash finds every key's place. A key that its
    shard doesn't hold gives nulls. The keys of one shard are at most the rows asked for it.
    """
    asked = keys.join(shards.select("shard", "file", F.col("start").alias("shard_start")), "shard")
    last, kind = ("ids_crc32", "long") if digest else ("ids", "array<long>")

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        disk, folder = file_system(root)
        with disk.open_input_stream(f"{folder}/{rows['file'].iloc[0]}") as file:
            shard = Shard(file.read())
        null = rows["doc_id"].isna().to_numpy()
        a, b = key_parts(rows["doc_id"].fillna(0).to_numpy(), null, rows["occurrence"].to_numpy())
        start, end = shard.find(a, b)
        gone = start < 0
        spans = [None if s < 0 else shard.ids(s, e) for s, e in zip(start, end, strict=True)]
        value = [None if x is None else zlib.crc32(x.tobytes()) if digest else x.astype(np.int64) for x in spans]
        out = pd.DataFrame({"doc_id": rows["doc_id"].to_numpy()})
        out["start"] = pd.array(start + rows["shard_start"].to_numpy(), "Int64")
        out["n_tokens"] = pd.array(end - start, "Int64")
        out.loc[gone, ["start", "n_tokens"]] = pd.NA
        out[last] = pd.array(value, "Int64") if digest else value
        return out

    return asked.groupBy("shard").applyInPandas(read, f"doc_id long, start long, n_tokens long, {last} {kind}")
