"""Toxicity by a factorization machine over hashed terms.

Terms are the words of the lower-cased text and their first four and six bytes, hashed to ``BUCKETS``; a
document has a term or not. The score is the logistic of a bias, the terms' weights, and the products of
the factors of each pair of terms, so that a pair can say more than its two terms alone.

Learning: at most ``MAX_ROWS`` labelled documents, by hash of doc_id, whole texts. Buckets that stand out in one class (``MIN_DOCS``
documents, ``MIN_Z`` standard deviations from chance) are the model's terms, at most ``MAX_TERMS`` of them by that
distance. Of the others, those enter that stand out beside one of these: among the documents with both, the toxic share
differs from the first term's. A term's p-value is its best pair's times the pairs tried, and terms enter, at most ``MAX_TERMS``, as
long as a share of ``FALSE_TERMS`` at most is expected to enter by chance (Benjamini and Hochberg). The rest
has weight zero, so long clean texts gather no noise. The model is of bounded size and goes to all tasks.

Null and empty texts have no terms and score the bias. Without labelled rows of both classes the score is the
share of toxic rows, 0 without any. Rows without a doc_id are scored but not learnt from. A doc_id that
is labelled or stored several times counts each time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalwatch.llm.common import col, fresh, mix, seeds, slices, stored

BUCKETS = 1 << 20
MAX_ROWS = 20_000
MIN_DOCS, MIN_Z, MAX_TERMS = 4, 5.0, 4096
FALSE_TERMS = 0.1
FACTORS = 4
THRESHOLD = 0.7
PREFIXES = (4, 6)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    inside, lower = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    lower[65:91] += 32
    return inside, lower


INSIDE, LOWER = _classes()
SALTS, PREFIX_SALTS = seeds(256, 3000), seeds(8, 4000)
BASE = int(seeds(1, 5000)[0]) | 1


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term occurrence."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lead = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0x9F) & (raw[1:] != 0x97)) + 1
    inside, own = INSIDE[raw], LOWER[raw]
    own[lead] += 0x20  # Latin capitals with accents
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = ends[ends < len(raw)]
    begin[edges] = inside[edges]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cut = edges[edges > 0] - 1
    stop[cut] = inside[cut]
    at, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    with np.errstate(over="ignore"):
        power, back = _powers(len(raw), BASE), _powers(len(raw), pow(BASE, -1, 1 << 64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(SALTS[own] * power)])

        def bucket(start, stop, salt):
            h = (sums[stop] - sums[start]) * back[start] + PREFIX_SALTS[salt] + (stop - start).astype(np.uint64)
            return (mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64)

        row = np.searchsorted(ends, at, side="right")
        rows, buckets = [row], [bucket(at, end, 0)]
        for i, size in enumerate(PREFIXES, 1):
            long = np.flatnonzero(end - at > size)
            rows.append(row[long])
            buckets.append(bucket(at[long], at[long] + size, i))
    return np.concatenate(rows), np.concatenate(buckets)


@dataclass
class Model:
    """Terms in ascending order of bucket, their weights and factors."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Scores of n documents from their distinct (row, index of term) pairs."""
        z = np.full(n, self.bias) + np.bincount(row, self.weights[term], n)
        for k in range(self.factors.shape[1]):
            v = self.factors[term, k]
            z += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        row, bucket = terms(texts)
        if not len(self.buckets):
            return row[:0], row[:0]
        at = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
        known = self.buckets[at] == bucket
        both = np.unique(row[known] * len(self.buckets) + at[known])
        return both // len(self.buckets), both % len(self.buckets)


def fit_pairs(y: np.ndarray, row: np.ndarray, term: np.ndarray, buckets: np.ndarray, rounds: int = 500, rate: float = 0.5, decay: float = 1e-5) -> Model:
    """Full-batch Adagrad on the logistic loss of a factorization machine; ``row`` ascends."""
    n, m = len(y), len(buckets)
    share = y.mean() if n else 0.0
    if not 0 < share < 1:
        return Model(buckets[:0], 30.0 * (2 * share - 1), np.zeros(0), np.zeros((0, FACTORS)))
    v = (np.random.default_rng(7).normal(0, 0.05, (m, FACTORS))) if m else np.zeros((0, FACTORS))
    model = Model(buckets, float(np.log(share / (1 - share))), np.zeros(m), v)
    # sums over a document's terms, and over a term's documents, as sums of runs; 32 bits name a cell
    row, term = row.astype(np.int32), term.astype(np.int32)
    by_term = np.argsort(term, kind="stable").astype(np.int32)
    of_rows, of_terms = _runs(row, term, n), _runs(term[by_term], row[by_term], m)
    del row, term, by_term
    factors = np.ascontiguousarray(model.factors.T)
    g_b, g_w, g_v = 1e-8, np.full(m, 1e-8), np.full((FACTORS, m), 1e-8)
    for _ in range(rounds):
        # half of (sum of v) squared less half of the sum of squares, the squares with the weights
        totals = [of_rows(own) for own in factors]
        z = model.bias + of_rows(model.weights - 0.5 * (factors * factors).sum(axis=0)) + 0.5 * sum(t * t for t in totals)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        step = error.sum()
        g_b += step * step
        model.bias -= rate * step / np.sqrt(g_b)
        if not m:
            continue
        plain = of_terms(error)
        grad = plain + decay * model.weights / n
        grads = np.array([of_terms(error * t) for t in totals]) - factors * plain + decay * factors
        g_w += grad * grad
        g_v += grads * grads
        model.weights -= rate * grad / np.sqrt(g_w)
        factors -= rate * grads / np.sqrt(g_v) * 0.2
    model.factors = np.ascontiguousarray(factors.T)
    return model


#: Cells that are summed at once.
CELLS = 1 << 18


def _runs(owner: np.ndarray, member: np.ndarray, n: int):
    """A function from members' values to each owner's sum; owners ascend. A piece of whole runs is summed at a time."""
    has, starts = np.unique(owner, return_index=True)
    pieces, first = [], 0
    while first < len(has):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + CELLS)))
        end = starts[last] if last < len(has) else len(member)
        pieces.append((has[first:last], member[starts[first] : end], starts[first:last] - starts[first]))
        first = last

    def sums(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        for own, cells, begins in pieces:
            out[own] = np.add.reduceat(values[cells], begins)
        return out

    return sums


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: a third of the documents."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Beside:
    """The learnt documents by ascending id: whether they are toxic, and their admitted terms from ``ends`` on."""

    ids: np.ndarray
    toxic: np.ndarray
    ends: np.ndarray
    terms: np.ndarray
    n_terms: int

    def chance(self, ids: np.ndarray) -> float:
        """How likely a term of these documents stands out as much beside some admitted term by chance."""
        at = np.searchsorted(self.ids, ids)
        sizes = self.ends[at + 1] - self.ends[at]
        places = np.repeat(self.ends[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        both = self.terms[places]
        n = np.bincount(both, minlength=self.n_terms)
        tried = np.flatnonzero((n >= MIN_DOCS) & (n < self.n))
        if not len(tried):
            return 1.0
        bad = np.bincount(both, np.repeat(self.toxic[at], sizes), self.n_terms)[tried]
        # arcsines: roots make small counts comparable
        z = 2 * np.sqrt(n[tried]) * (np.arcsin(np.sqrt(bad / n[tried])) - np.arcsin(np.sqrt(self.share[tried])))
        return min(1.0, len(tried) * math.erfc(float(np.abs(z).max()) / math.sqrt(2)))

    def __post_init__(self):
        self.n = np.bincount(self.terms, minlength=self.n_terms)
        owners = np.repeat(self.toxic, np.diff(self.ends))
        self.share = np.minimum(1.0, np.bincount(self.terms, owners, self.n_terms) / np.maximum(self.n, 1))


def _packed(sample: DataFrame, kept: np.ndarray) -> pa.Table:
    """(id, toxic, held) of at most max_rows rows: ``held`` are a row's kept buckets in ascending order, as bytes."""
    known = sample.sparkSession.sparkContext.broadcast(kept)

    def of(own: np.ndarray) -> bytes:  # a row's buckets ascend
        if not len(known.value):
            return b""
        at = np.minimum(np.searchsorted(known.value, own), len(known.value) - 1)
        return own[known.value[at] == own].astype(">i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [of(own.values.to_numpy()) for own in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(held, pa.binary())], names=["id", "toxic", "held"])

    return sample.select("id", "toxic", "buckets").mapInArrow(run, "id long, toxic int, held binary").toArrow()


def _cells(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows, and where each row's end."""
    ends = np.cumsum([0, *(len(b) // 4 for b in held)])
    return np.frombuffer(b"".join(held), ">i4").astype(np.int32), ends


def _beside(sample: DataFrame, kept: list[int]) -> list[int]:
    """The buckets that stand out beside one of the kept ones."""
    if not kept:
        return []
    known_buckets = np.array(kept, np.int32)
    rows = _packed(sample, known_buckets).sort_by("id")
    cells, ends = _cells(rows["held"].to_pylist())
    beside = Beside(
        rows["id"].to_numpy(), rows["toxic"].to_numpy().astype(float), ends,
        np.searchsorted(known_buckets, cells).astype(np.int32), len(kept),
    )
    del rows, cells
    known = sample.sparkSession.sparkContext.broadcast((beside, known_buckets))
    del beside

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others, own = known.value
        for batch in batches:
            chances = [others.chance(ids.values.to_numpy()) for ids in batch.column(1)]
            is_kept = pa.array(np.isin(batch.column(0).to_numpy(), own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chances, pa.float64()), is_kept], names=["bucket", "chance", "is_kept"])

    # a bucket has max_rows ids at most
    owners = sample.select("id", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.collect_list("id").alias("ids"))
    owners = owners.where(F.size("ids") >= MIN_DOCS)
    chances = owners.mapInArrow(run, "bucket int, chance double, is_kept boolean").persist()
    try:
        tried = chances.where("not is_kept and chance < 1")
        n = chances.count()
        best = tried.where(F.col("chance") <= FALSE_TERMS).orderBy("chance", "bucket").limit(MAX_TERMS).collect()
    finally:
        chances.unpersist()
    last = max((i for i, r in enumerate(best, 1) if r.chance <= FALSE_TERMS * i / n), default=0)
    return [r.bucket for r in best[:last]]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from (doc_id, text) and (doc_id, toxic) rows, without the held-out third."""
    chosen = (
        labels.select(F.col("doc_id").alias("l_doc"), (F.col("toxic") > 0).cast("int").alias("toxic"))
        .where("l_doc IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("l_doc")))
        .orderBy(F.xxhash64("l_doc"), "l_doc", "toxic").limit(max_rows)
    )
    # max_rows rows of two numbers: a bounded broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_doc"))

    def buckets_of(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                row, bucket = terms(batch.column(1))
                both = np.unique(row * BUCKETS + bucket)
                ends = np.cumsum([0, *np.bincount(both // BUCKETS, minlength=batch.num_rows)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((both % BUCKETS).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["toxic", "buckets"])

    sample = rows.select("toxic", "text").mapInArrow(buckets_of, "toxic int, buckets array<int>")
    # kept in a table, as the ids must be the same in each reading
    sample = stored(sample.withColumn("id", F.monotonically_increasing_id()), "toxicity-sample").persist()
    try:
        n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        share = toxic / n if n else 0.0
        with_term = sample.select("toxic", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
            F.count("*").alias("n"), F.sum("toxic").alias("t")
        )
        z = F.abs(F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-9))
        terms_ = with_term.where(F.col("n") >= MIN_DOCS).withColumn("z", z).where(F.col("z") >= MIN_Z)
        kept = sorted(r[0] for r in terms_.orderBy(F.desc("z"), "bucket").limit(MAX_TERMS).select("bucket").collect())
        kept = sorted(kept + _beside(sample, kept))
        buckets = np.array(kept, np.int64)
        table_ = _packed(sample, buckets.astype(np.int32))  # max_rows rows
    finally:
        sample.unpersist()
    # an order that doesn't depend on how the rows were dealt
    data = sorted(zip(table_["toxic"].to_pylist(), table_["held"].to_pylist(), strict=True))
    del table_
    y = np.array([t for t, _ in data], float)
    cells, ends = _cells([held for _, held in data])
    del data
    row = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(ends))
    return fit_pairs(y, row, np.searchsorted(buckets, cells).astype(np.int32), buckets)


def with_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The rows with the probability that the text is toxic in a further column."""
    keep = docs.columns if keep is None else keep
    [inner] = fresh(docs, "text_in")
    docs = docs.select(*map(col, keep), col(text).alias(inner))
    [name] = fresh(docs, out)
    at = len(keep)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, at):
                row, term = known.value.pairs(batch.column(at))
                score = pa.array(known.value.score(row, term, batch.num_rows))
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], score], names=[*keep, name])

    return docs.mapInArrow(run, StructType(docs.schema.fields[:at]).add(name, "double"))
