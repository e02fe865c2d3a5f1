"""Ranked lexical search by two hierarchies, one over items and one over documents, walked together.

An item is a vector of term weights, a document a vector of its terms' strengths; a score is their product. Nodes of both
hierarchies hold the largest value of each coordinate below them, so the product of two nodes bounds every score
between them. A pair of nodes whose bound is below the weakest k-th score that the node's items have already is
left out as a whole; ties are kept, so the result is exact.

1. One pass reads the documents' terms. A bitmap of fixed size tells the terms that some item may have; others
   count towards the length of a document only.
2. The documents that are left are ordered by the commonest of these terms and by length, so that neighbours are
   alike. 64 neighbours are a leaf, 16 leaves a node.
3. Items are taken in blocks of a bounded number of terms. Every task bounds all items by its leaves; the few leaves with the
   highest bounds of an item, over all tasks, are scored first and give its first k-th score.
4. Every task walks its hierarchy against the block's, best leaves first, raising the k-th scores as it goes, and hands
   on at most k documents an item; a window picks the best of these.

No task holds more than a batch of documents and a block of items. Hot terms, copies and sources only make rows, which
are dealt by ranges that end in doc_id.

Rows of one item_id are one item with the terms of all of them. A null or empty item has no rows; neither has an item
whose terms no document has. A null text has no terms. Rows of documents that repeat count as documents each. Of
equal scores the lower doc_id is first, null before all. Further columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import col, slices, stored

K = 50
#: Documents of a leaf (as a power of two), leaves of a node, items of a node.
LEAF_BITS, LEAVES, ITEMS = 6, 16, 16
#: (item, term) pairs and items of a block, about.
BLOCK_PAIRS, BLOCK_ITEMS = 1 << 14, 512
#: Leaves per item that are scored first.
SEEDS = 8
#: Bits of the bitmap of item terms, a multiple of those of one of Spark's bitmaps.
BITS, BITMAP = 1 << 23, 32768
#: Bytes of a text whose terms are counted at once.
PIECE = 1 << 20

#: Letters, digits and everything beyond ASCII make terms; A-Z is lower-cased.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def count_terms(text: bytes) -> Counter:
    """The terms of a text with their numbers."""
    counts, start = Counter(), 0
    while start < len(text):
        piece = text[start : start + PIECE].translate(_TABLE)
        if start + PIECE < len(text) and (cut := piece.rfind(b" ")) >= 0:
            piece = piece[: cut + 1]
        elif start + PIECE < len(text):  # one term is longer than a piece
            whole = text[start:].translate(_TABLE)
            piece = whole[: whole.find(b" ") + 1 or len(whole)]
        counts.update(piece.split())
        start += len(piece)
    return counts


def _terms(rows: DataFrame, key: str, text: str, wanted=None) -> DataFrame:
    """(key, n, lead, terms, tfs) of every row: its number of terms, the wanted ones and the commonest of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = None if wanted is None else np.unpackbits(wanted.value, bitorder="little").tobytes()
        for whole in batches:
            for batch in slices(whole, 1):
                lengths, leads, ends, terms, tfs = [], [], [0], [], []
                for value in batch.column(1).cast(pa.binary()):
                    counts = count_terms(value.as_py()) if value.is_valid else {}
                    kept = counts if may is None else [t for t in counts if may[zlib.crc32(t) % BITS]]
                    lengths.append(sum(counts.values()))
                    leads.append(min(kept, key=lambda t: (-counts[t], t), default=None))
                    terms.extend(kept)
                    tfs.extend(counts[t] for t in kept)
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(lengths, pa.int64()), pa.array(leads, pa.binary()).cast(pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                        pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                    ],
                    names=["key", "n", "lead", "terms", "tfs"],
                )

    chosen = rows.select(col(key).cast("long").alias("key"), col(text).alias("text"))
    return chosen.mapInArrow(run, "key long, n long, lead string, terms array<string>, tfs array<long>")


def _bitmap(item_terms: DataFrame) -> np.ndarray:
    """One bit per hash of a term: BITS / BITMAP rows come to the driver, however many terms there are."""
    bit = F.crc32("term") % BITS + 1
    rows = (
        item_terms.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("at"))
        .groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    )
    bits = np.zeros((BITS // BITMAP, BITMAP // 8), np.uint8)
    for part, held in rows:
        bits[part - 1] = np.frombuffer(held, np.uint8)
    return bits.reshape(-1)


class Block:
    """The hierarchy over a block of items: their weights by term, and the largest weights of each node."""

    def __init__(self, item: list, term: list[str], weight: np.ndarray):
        self.terms = pa.array(sorted(set(term)), pa.string())
        at = {t: i for i, t in enumerate(self.terms.to_pylist())}
        # items that share their commonest term are neighbours
        first: dict = {}
        for i, t, w in zip(item, term, weight, strict=True):
            first[i] = min(first.get(i, (w, t)), (w, t))
        self.ids = sorted(first, key=lambda i: (first[i][1], i is not None, i or 0))
        place = {i: n for n, i in enumerate(self.ids)}
        self.cells = np.array([place[i] for i in item], np.int64), np.array([at[t] for t in term], np.int64), np.asarray(weight)
        self._fill()

    def _fill(self) -> None:
        # sums of fewer than 2 ** 17 products below 2 ** 36 are exact in doubles
        kind = np.float64 if len(self.terms) < 1 << 17 else np.int64
        self.weights = np.zeros((len(self.ids), len(self.terms)), kind)
        self.weights[self.cells[:2]] = self.cells[2]
        self.starts = np.arange(0, len(self.ids), ITEMS)
        self.node_weights = np.maximum.reduceat(self.weights, self.starts) if self.ids else self.weights

    def __getstate__(self):
        """Only the weights that there are travel to the workers."""
        return self.terms, self.ids, self.cells

    def __setstate__(self, state):
        self.terms, self.ids, self.cells = state
        self._fill()


@dataclass
class Totals:
    """Documents with a term, and the terms of all documents."""

    docs: int
    terms: int


class Leaves:
    """The hierarchy over a batch of documents (place, key, n, terms, tfs), in the order of their places."""

    def __init__(self, batch: pa.RecordBatch, block: Block, totals: Totals):
        place, key, n, terms, tfs = batch.columns
        ends = terms.offsets.to_numpy().astype(np.int64)
        ends, inner = ends - ends[0], terms.flatten()
        at = pc.index_in(inner, value_set=block.terms)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(batch.num_rows), np.diff(ends))[known]
        self.column = pc.fill_null(at, 0).to_numpy()[known].astype(np.int64)
        tf, length = tfs.flatten().to_numpy()[known], n.to_numpy()
        m = 50 + (50 * length * totals.docs) // max(totals.terms, 1)
        kind = block.weights.dtype
        self.value = (1_000_000_000 * tf // (1000 * tf + 20 * m[row])).astype(kind)
        self.key = pc.fill_null(key, -(2**63)).to_numpy()
        # the leaves' rows and entries
        names = place.to_numpy() >> LEAF_BITS
        self.first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
        self.name = names[self.first]
        self.last = np.r_[self.first[1:], len(names)].astype(np.int64)
        self.row, self.entry = row, np.searchsorted(row, np.r_[self.first, len(names)])
        leaf = np.searchsorted(self.first, row, side="right") - 1
        self.largest = np.zeros((len(self.first), len(block.terms)), kind)
        np.maximum.at(self.largest, (leaf, self.column), self.value)
        self.starts = np.arange(0, len(self.first), LEAVES)
        self.node_largest = np.maximum.reduceat(self.largest, self.starts) if len(self.first) else self.largest


class Walk:
    """The best documents of a block's items among the batches seen, and how much was left out."""

    def __init__(self, block: Block, totals: Totals, floor: np.ndarray | None = None, k: int = K):
        self.block, self.totals, self.k = block, totals, k
        n = len(block.ids)
        self.best = np.zeros((n, k), block.weights.dtype)  # the best scores seen, the weakest first
        self.floor = np.ones(n, block.weights.dtype) if floor is None else np.maximum(floor, 1).astype(block.weights.dtype)
        self.found: list[np.ndarray] = []  # rows (item, key, score)
        self.scored = self.pairs = 0

    def add(self, batch: pa.RecordBatch) -> None:
        leaves, block = Leaves(batch, self.block, self.totals), self.block
        self.pairs += len(block.ids) * len(leaves.first)
        if not len(leaves.first) or not block.ids:
            return
        bounds = block.node_weights @ leaves.node_largest.T
        for node in np.argsort(-bounds.max(axis=0), kind="stable"):
            weakest = np.minimum.reduceat(self.floor, block.starts)
            open_ = np.flatnonzero(bounds[:, node] >= weakest)
            if not len(open_):
                continue
            items = np.concatenate([np.arange(s, min(s + ITEMS, len(block.ids))) for s in block.starts[open_]])
            below = np.arange(leaves.starts[node], min(leaves.starts[node] + LEAVES, len(leaves.first)))
            finer = block.weights[items] @ leaves.largest[below].T
            for leaf in np.argsort(-finer.max(axis=0), kind="stable"):
                asked = items[finer[:, leaf] >= self.floor[items]]
                if len(asked):
                    self._score(leaves, below[leaf], asked)
        self._trim()

    def _score(self, leaves: Leaves, leaf: int, items: np.ndarray) -> None:
        self.scored += len(items)
        part = slice(leaves.entry[leaf], leaves.entry[leaf + 1])
        columns, at = np.unique(leaves.column[part], return_inverse=True)
        first, last = leaves.first[leaf], leaves.last[leaf]
        values = np.zeros((len(columns), last - first), self.block.weights.dtype)
        values[at, leaves.row[part] - first] = leaves.value[part]
        scores = self.block.weights[np.ix_(items, columns)] @ values
        i, d = np.nonzero(scores >= self.floor[items][:, None])
        if len(i):
            self.found.append(np.column_stack([items[i], leaves.key[first + d], scores[i, d].astype(np.int64)]))
            merged = np.concatenate([self.best[items], scores], axis=1)
            self.best[items] = np.partition(merged, merged.shape[1] - self.k, axis=1)[:, -self.k :]
            self.floor[items] = np.maximum(self.floor[items], self.best[items].min(axis=1))

    def _trim(self) -> None:
        """Leave each item its k best, the lower key first of equal scores."""
        if not self.found:
            return
        rows = np.concatenate(self.found)
        rows = rows[rows[:, 2] >= self.floor[rows[:, 0]]]
        rows = rows[np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))]
        begins = np.searchsorted(rows[:, 0], rows[:, 0], side="left")
        self.found = [rows[np.arange(len(rows)) - begins < self.k]]

    def rows(self) -> pa.RecordBatch:
        rows = self.found[0] if self.found else np.zeros((0, 3), np.int64)
        items = pa.array(self.block.ids, pa.int64()).take(pa.array(rows[:, 0], pa.int64()))
        keys = pa.array(rows[:, 1], pa.int64(), mask=rows[:, 1] == -(2**63))
        return pa.RecordBatch.from_arrays([items, keys, pa.array(rows[:, 2])], names=["item", "key", "score"])


FOUND = "item long, key long, score long"


def _walked(docs: DataFrame, block, totals: Totals, floor: np.ndarray | None, k: int) -> DataFrame:
    """At most k documents an item and task, among them the k best of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(block.value, totals, floor, k)
        for batch in batches:
            walk.add(batch)
        yield walk.rows()

    return docs.select("place", "key", "n", "terms", "tfs").mapInArrow(run, FOUND)


def _bounded(docs: DataFrame, block, totals: Totals) -> DataFrame:
    """The leaves of each task with an item's highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value
        for batch in batches:
            leaves = Leaves(batch, known, totals)
            bounds = known.weights @ leaves.largest.T
            best = np.argsort(-bounds, axis=1, kind="stable")[:, :SEEDS]
            item = np.repeat(np.arange(len(known.ids)), best.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(leaves.name[best].reshape(-1)), pa.array(np.take_along_axis(bounds, best, 1).reshape(-1).astype(np.int64))],
                names=["item", "leaf", "bound"],
            )

    return docs.select("place", "key", "n", "terms", "tfs").mapInArrow(run, "item long, leaf long, bound long")


def _first_floor(docs: DataFrame, block, totals: Totals, k: int) -> np.ndarray:
    """The k-th best scores of the block's items among the leaves that promise most."""
    best = Window.partitionBy("item").orderBy(F.desc("bound"), "leaf")
    seeds = _bounded(docs, block, totals).where("bound > 0").withColumn("r", F.row_number().over(best)).where(F.col("r") <= SEEDS)
    # at most SEEDS leaves for each of a block's items: a bounded broadcast
    leaves = F.broadcast(seeds.select("leaf").distinct())
    near = docs.withColumn("leaf", F.shiftright("place", LEAF_BITS)).join(leaves, "leaf", "left_semi")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"))
    kth = _walked(near, block, totals, None, k).withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k)
    floor, place = np.zeros(len(block.value.ids), np.int64), {i: n for n, i in enumerate(block.value.ids)}
    for row in kth.select("item", "score").collect():  # a block's items
        floor[place[row.item]] = row.score
    return floor


def ordered(docs: DataFrame) -> DataFrame:
    """The rows with a ``place``: alike documents are neighbours."""
    keys = ["lead", "n", "key"]
    placed = docs.where(F.size("terms") > 0).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(placed.withColumn("place", F.monotonically_increasing_id()), "search-ordered")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    block_pairs: int = BLOCK_PAIRS, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k documents that score highest for each item."""
    spark = docs.sparkSession
    item_terms = stored(
        _terms(items, item_id, text).select(F.col("key").alias("item"), F.explode("terms").alias("term")).distinct(), "search-items"
    )
    wanted = spark.sparkContext.broadcast(_bitmap(item_terms))
    read = stored(_terms(docs, doc_id, text, wanted), "search-terms")
    n_docs, n_terms = read.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    totals = Totals(n_docs, n_terms)
    counts = read.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = stored(item_terms.join(counts, "term").select("item", "term", weight.alias("w")).where("w > 0"), "search-weights")
    placed = ordered(read)
    pairs, n_items = weighted.agg(F.count("*"), F.count_distinct(F.coalesce("item", F.lit(-1)))).first()
    blocks = max(1, math.ceil(pairs / block_pairs), math.ceil(n_items / block_items))
    found = []
    for b in range(blocks):
        # about block_pairs rows
        part = weighted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
        block = spark.sparkContext.broadcast(Block(part["item"].to_pylist(), part["term"].to_pylist(), part["w"].to_numpy()))
        floor = _first_floor(placed, block, totals, k)
        found.append(_walked(placed, block, totals, floor, k))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    return (
        _union(found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")
    )


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionAll(frame)
    return first
