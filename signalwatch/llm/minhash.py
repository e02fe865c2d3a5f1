"""Near-duplicates by fast similarity sketches, banding and exact verification.

A document's set: the hashes of its distinct ``SHINGLE``-word shingles (A-Z lower-cased, words between ASCII white space);
with fewer words the whole sequence as one, without words the empty set, which is linked with nothing.

Sketch: in round i every shingle draws one of the ``T`` places and a value, and each place keeps its least (round, value).
Rounds go on until all places are filled; from round T on, round T + j sends every shingle to place j, so a
place is filled for certain. Two sets agree in a place with probability their similarity, and the places agree nearly
independently. ``BANDS`` bands of ``ROWS`` places are the buckets: at similarity 0.75 a pair misses all of
them once in four million times.

Documents with equal sets form a class, of which one stands for all. The centre of a bucket is its member that meets most
others, over all its buckets; a class's family is the centre that it shares most buckets with. Links are looked for
(1) between each class and its family's centre; (2) between the members of a family outside its main component
and all members, by tiles of the family, as one product of incidence matrices per pair of tiles, which
returns a star per connected part and no pairs; (3) between classes of different families that share a bucket: pairs
in buckets of up to ``PAIRED`` members, tiles as in (2) in larger ones. Components are formed after (1) and (2), and
only classes of different components are compared in the next step, so no link between components is lost and a
group of n near copies costs about n comparisons. All compare the full sets.

Null texts have the empty set. Rows that share a doc_id are one node, linked through any of their texts. A null doc_id
is never the smallest; a row that reaches no other id has its own as component. Repeated rows all stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import col, fresh, mix, parts_of, seeds, slices, stored
from signalwatch.llm.components import components

SHINGLE = 5
ROWS, BANDS = 4, 40
T = ROWS * BANDS
SIMILARITY = 75
PAIRED = 16  # members of a bucket that are compared as rows of pairs; larger buckets are compared by tiles
LAST = 2**63 - 1

SALTS = seeds(256, 7000)
BASE = int(seeds(1, 7500)[0]) | 1
PLACE = seeds(SHINGLE, 8000) | np.uint64(1)
ROUND = seeds(2 * T, 9000)
BAND = seeds(BANDS, 9900)
EMPTY = np.uint64(2**64 - 1)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets in one array, each sorted, and where each ends, with 0 in front."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    own = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edges = ends[(ends > 0) & (ends < len(raw))]
    begin[edges] = inside[edges]
    stop[edges - 1] = inside[edges - 1]
    at, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(SALTS[own] * _powers(len(raw), BASE))])
        word = (sums[end] - sums[at]) * _powers(len(raw), pow(BASE, -1, 1 << 64))[at]
        word = mix(word + (end - at).astype(np.uint64))
        row = np.searchsorted(ends, at, side="right")
        counts = np.bincount(row, minlength=len(texts))
        first = np.cumsum(counts) - counts
        padded = np.concatenate([word, np.zeros(SHINGLE, np.uint64)])
        whole = np.zeros(len(word), np.uint64)
        for j in range(SHINGLE):
            part = padded[j : j + len(word)]
            inside_row = np.arange(len(word)) + j < (first + counts)[row]
            whole += np.where(inside_row, part * PLACE[j] + np.uint64(j), np.uint64(0))
        whole = mix(whole)
    sets = []
    for s, n in zip(first.tolist(), counts.tolist(), strict=True):
        sets.append(np.unique(whole[s : s + max(n - SHINGLE + 1, min(n, 1))]))
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def sketch(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of T places per set; empty sets have EMPTY in all."""
    sizes = np.diff(ends)
    out = np.full((len(sizes), T), EMPTY, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    with np.errstate(over="ignore"):
        for i in range(2 * T):
            if not len(sets):
                break
            h = mix(sets ^ ROUND[i])
            place = ((h >> np.uint64(40)) % np.uint64(T)).astype(np.int64) if i < T else i - T
            value = np.uint64(i << 40) | (h & np.uint64((1 << 40) - 1))
            np.minimum.at(flat, owner * T + place, value)
            going = (out == EMPTY).any(axis=1)[owner]
            sets, owner = sets[going], owner[going]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = np.zeros((len(sketches), BANDS), np.uint64) + BAND
        for j in range(ROWS):
            keys = mix(keys ^ sketches[:, j::ROWS] * np.uint64(2 * j + 3))
    return keys.view(np.int64)


def _identity(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, from two sums over its members."""
    with np.errstate(over="ignore"):
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (sets, mix(sets + BAND[0]))]
        a, b = (s[ends[1:]] - s[ends[:-1]] for s in sums)
        return mix(mix(a) + mix(b ^ BAND[1]) + np.diff(ends).astype(np.uint64)).view(np.int64)


def document_sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cls, bands) per row; cls names the set and is null for the empty one."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                sets, ends = shingle_sets(batch.column(1))
                sizes = np.diff(ends)
                keys = band_keys(sketch(sets, ends))[sizes > 0]
                cuts = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(sizes, pa.int64()), pa.array(_identity(sets, ends), mask=sizes == 0),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(keys.reshape(-1))),
                    ],
                    names=["doc_id", "n", "cls", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, cls long, bands array<long>")


def document_sets(rows: DataFrame) -> DataFrame:
    """(cls, shingles) of each text."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 0):
                sets, ends = shingle_sets(batch.column(0))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_identity(sets, ends)), lists], names=["cls", "shingles"])

    return rows.select("text").mapInArrow(run, "cls long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The (a, b) pairs whose full sets are similar enough."""
    of_a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.join(of_a, "a").join(of_b, "b").where(both * 100 >= either * similarity).select("a", "b")


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many members each set on the left shares with each on the right."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right)]
    rows = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right)]
    shared = np.intersect1d(*flat)
    for start in range(0, len(shared), columns):
        part = shared[start : start + columns]
        sides = []
        for values, row, x in zip(flat, rows, (left, right), strict=True):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            side = np.zeros((len(x), len(part)), np.float32)
            side[row[hit], at[hit]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _group_links(groups: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(a, b) links between the members outside a group's main part and all its members, as stars.

    Rows are (family, cls, part); a group is a family or a large bucket.
    """
    parts = groups.groupBy("family", "part").agg(F.count("*").alias("m"))
    open_ = parts.groupBy("family").agg(
        F.max(F.struct("m", "part")).alias("main"), F.sum("m").alias("all"), F.count("*").alias("parts")
    ).where("parts > 1")
    # tiles grow with the root of the family, between 128 and 4096 members
    tile = F.greatest(F.lit(128.0), F.least(F.lit(4096.0), 4 * F.sqrt("all")))
    open_ = stored(open_.select(
        "family", F.col("main.part").alias("main"),
        F.ceil(F.col("all") / tile).cast("int").alias("tiles"),
        F.ceil((F.col("all") - F.col("main.m")) / tile).cast("int").alias("out_tiles"),
    ), "minhash-groups-open")
    rows = groups.join(open_, "family")
    own, other = F.pmod(F.xxhash64("cls", F.lit(1)), F.col("tiles")), F.pmod(F.xxhash64("cls", F.lit(2)), F.col("out_tiles"))
    left = rows.select("cls", "part", "family", own.alias("i"), F.explode(F.sequence(F.lit(0), F.col("out_tiles") - 1)).alias("j"), F.lit(0).alias("side"))
    right = rows.where("part <> main").select(
        "cls", "part", "family", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"), other.alias("j"), F.lit(1).alias("side")
    )
    tasks = left.withColumn("i", F.col("i").cast("int")).unionByName(right.withColumn("j", F.col("j").cast("int"))).join(sets, "cls")

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        sets_l, sets_r = left["shingles"].tolist(), right["shingles"].tolist()
        both = common_counts(sets_l, sets_r)
        size = np.array([len(x) for x in sets_l])[:, None] + np.array([len(x) for x in sets_r])[None, :]
        linked = both * 100 >= (size - both) * similarity
        linked &= left["part"].to_numpy()[:, None] != right["part"].to_numpy()[None, :]
        i, j = np.nonzero(linked)
        names = np.concatenate([left["cls"].to_numpy(), right["cls"].to_numpy()])
        root = names[parts_of(len(names), i, j + len(left))]
        apart = root != names
        return pd.DataFrame({"a": names[apart], "b": root[apart]})

    return tasks.groupBy("family", "i", "j").applyInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of (doc_id, text)."""
    rows = stored(document_sketches(docs), "minhash-rows")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = stored(classes, "minhash-classes")
    buckets = classes.select("cls", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    members = stored(buckets.join(shared, "bucket"), "minhash-members")

    # the texts of classes that share a bucket
    wanted = classes.join(members.select("cls").distinct(), "cls", "left_semi")
    wanted = wanted.select(F.coalesce("rep", F.lit(LAST)).alias("rep")).distinct()
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rep"), "text")
    sets = document_sets(texts.join(wanted, "rep", "left_semi"))
    sets = stored(sets.dropDuplicates(["cls"]), "minhash-sets")

    score = members.groupBy("cls").agg(F.sum("m").alias("score"))
    scored = members.join(score, "cls")
    centre = scored.groupBy("bucket").agg(F.max(F.struct("score", "cls")).alias("c"))
    votes = members.select("bucket", "cls").join(centre, "bucket").groupBy("cls", "c").agg(F.count("*").alias("votes"))
    best = votes.groupBy("cls").agg(F.max(F.struct("votes", "c")).alias("best"))
    family = stored(best.select("cls", F.col("best.c.cls").alias("family")), "minhash-family")
    stars = confirmed(family.where("cls <> family").select(F.col("cls").alias("a"), F.col("family").alias("b")), sets, similarity)
    same_id = rows.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("cls").alias("a"), F.collect_set("cls").alias("all")
    ).where(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    known = stored(stars.unionByName(same_id), "minhash-stars")

    def with_parts(frame: DataFrame, links: DataFrame, name: str) -> DataFrame:
        labels = components(links, name).withColumnRenamed("node", "cls")
        return frame.join(labels, "cls", "left").withColumn("part", F.coalesce("component", "cls")).drop("component")

    found = _group_links(with_parts(family, known, "minhash-parts"), sets, similarity)
    known = stored(known.unionByName(found), "minhash-known")

    placed = with_parts(members.select("bucket", "cls", "n"), known, "minhash-parts").join(family, "cls")
    parts = placed.groupBy("bucket", "part").agg(F.count("*").alias("m"))
    main = parts.groupBy("bucket").agg(
        F.max(F.struct("m", "part")).alias("main"), F.count("*").alias("parts"), F.sum("m").alias("all")
    )
    main = main.where("parts > 1").select("bucket", F.col("main.part").alias("main"), "all")
    open_ = stored(placed.join(main, "bucket"), "minhash-open")
    large = open_.where(F.col("all") > PAIRED).select(F.col("bucket").alias("family"), "cls", "part")
    met = _group_links(large, sets, similarity)
    open_ = open_.where(F.col("all") <= PAIRED)
    minor = open_.where("part <> main").select(
        "bucket", F.col("cls").alias("x"), F.col("n").alias("n_x"), F.col("part").alias("part_x"), F.col("family").alias("family_x")
    )
    # a pair of different parts has a member outside the bucket's main part
    pairs = minor.join(open_, "bucket").where(
        (F.col("part") != F.col("part_x")) & (F.col("family") != F.col("family_x"))
        & ((F.col("part") == F.col("main")) | (F.col("x") < F.col("cls")))
        & (F.least("n", "n_x") * 100 >= F.greatest("n", "n_x") * similarity)
    )
    pairs = pairs.select(F.greatest("x", "cls").alias("a"), F.least("x", "cls").alias("b")).distinct()
    more = confirmed(pairs, sets, similarity)

    groups = components(known.unionByName(met).unionByName(more), "minhash-groups").withColumnRenamed("node", "cls")
    named = classes.select("cls", "rep").join(groups, "cls")
    named = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = classes.select("cls", "rep").join(groups, "cls", "left").join(named, "component", "left")
    found = found.select(F.col("cls").alias("f_cls"), F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.join(found, F.col("cls") == F.col("f_cls"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The rows whose document stands for its group, with their own columns."""
    verdicts = near_duplicates(docs, similarity).where("NOT kept").select("doc_id").distinct()
    [gone] = fresh(docs, "gone_id")
    return docs.join(verdicts.select(F.col("doc_id").alias(gone)), col("doc_id").cast("long").eqNullSafe(F.col(gone)), "left_anti")
