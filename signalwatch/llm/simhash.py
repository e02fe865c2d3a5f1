"""Document fingerprints by SimHash, in DataFrame operations only.

A text's terms are its pairs of neighbouring words (its word, if it has one); a term weighs as often as it occurs. Each
term's 128-bit hash votes on 128 signed bits: a fingerprint bit is 1 where more weight has it set than not. Texts without
terms have all bits 0. Two counters share a 64-bit sum, which holds for four billion terms.

Fingerprints within a Hamming radius agree in one of radius + 1 blocks of bits: ``near_fingerprints`` keeps a table per block,
keyed by its value, and compares what meets there in full.

``fingerprint_edits`` fingerprints each document and its text with the second half replaced by the beginning of the next
document. The next is the one of the next doc_id (rows that share one: by the text's hash; nulls first; behind the last comes the
first); it is found in ranges of ids, whose first ids are a small table. Rows that agree in doc_id and text are one document
and each get its result. Null texts count as empty; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import stored

BITS = 128
LANES = 0x0000000100000001
SPLIT = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """64-bit hashes of neighbouring words."""
    words = F.filter(F.split(text, SPLIT, -1), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def pairs_of(words: Column) -> Column:
    n = F.size(words) - 1
    both = F.zip_with(F.slice(words, 1, F.greatest(n, F.lit(0))), F.slice(words, 2, F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return F.when(n < 1, words).otherwise(both)


def fingerprints(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    """The keys and f1, f2 (64 bits each); rows that agree in all keys must agree in the text."""
    hashed = rows.select(*keys, terms(F.col(text)).alias("words"))
    spread = hashed.select(*keys, F.explode_outer(pairs_of(F.col("words"))).alias("h1"))
    spread = spread.withColumn("h2", F.when(F.col("h1").isNotNull(), F.xxhash64("h1", F.lit(11))))
    sums = [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(LANES))).alias(f"{h}_{i}") for h in ("h1", "h2") for i in range(32)
    ]
    votes = spread.groupBy(*keys).agg(F.count("h1").alias("n"), *sums)

    def bits(h: str) -> Column:
        out = []
        for i in range(32):
            both = F.coalesce(F.col(f"{h}_{i}"), F.lit(0))
            low, high = both.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(both, 32)
            for count, place in ((low, i), (high, i + 32)):
                one = F.shiftleft(F.lit(1).cast("long"), place)
                out.append(F.when(count * 2 > F.col("n"), one).otherwise(F.lit(0).cast("long")))
        return functools.reduce(lambda a, b: a.bitwiseOR(b), out)

    return votes.select(*keys, bits("h1").alias("f1"), bits("h2").alias("f2"))


def as_hex(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def likeness(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """The share of equal bits."""
    apart = F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))
    return 1 - apart / float(BITS)


def near_fingerprints(found: DataFrame, radius: int = 3, queries: DataFrame | None = None) -> DataFrame:
    """(a1, a2, b1, b2, distance): pairs of distinct (f1, f2) within the radius, once each, and equal ones not at all.

    With ``queries`` the pairs of a query's fingerprint (a) with all others (b); else of all with all, a before b.
    """
    if not 0 <= radius < BITS // 2:
        raise ValueError("the radius must be below half the bits")
    blocks = radius + 1
    cuts = [BITS * i // blocks for i in range(blocks + 1)]

    def keys(f1: Column, f2: Column) -> list[Column]:
        def part(f: Column, low: int, high: int) -> Column:  # bits low to high of one word
            if high <= low:
                return F.lit(0).cast("long")
            mask = (1 << (high - low)) - 1
            return F.shiftrightunsigned(f, low).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("long"))

        return [
            F.struct(part(f1, min(a, 64), min(b, 64)).alias("x"), part(f2, max(a, 64) - 64, max(b, 64) - 64).alias("y"))
            for a, b in zip(cuts, cuts[1:], strict=False)
        ]

    def tables(rows: DataFrame, one: str, two: str) -> DataFrame:
        rows = rows.select(F.col("f1").alias(one), F.col("f2").alias(two)).distinct()
        return rows.select("*", F.posexplode(F.array(*keys(F.col(one), F.col(two)))).alias("block", "key"))

    left = tables(found if queries is None else queries, "a1", "a2")
    right = tables(found, "b1", "b2").withColumnsRenamed({"block": "b_block", "key": "b_key"})
    pairs = left.join(right, (F.col("block") == F.col("b_block")) & (F.col("key") == F.col("b_key")))
    distance = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
    pairs = pairs.withColumn("distance", distance).where((F.col("distance") <= radius) & (F.col("distance") > 0))
    if queries is None:
        pairs = pairs.where((F.col("a1") < F.col("b1")) | ((F.col("a1") == F.col("b1")) & (F.col("a2") < F.col("b2"))))
    # a pair counts in the first block in which it agrees
    own, other = keys(F.col("a1"), F.col("a2")), keys(F.col("b1"), F.col("b2"))
    first = F.array_position(F.array(*[a == b for a, b in zip(own, other, strict=True)]), True) - 1
    return pairs.where(F.col("block") == first).select("a1", "a2", "b1", "b2", "distance")


def _successors(ids: DataFrame) -> DataFrame:
    """(row, next_row, need) of (row, doc_id, n_chars) rows, by doc_id."""
    parts = max(1, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = ids.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "row")
    ordered = stored(ordered.select("row", "doc_id", "n_chars", F.spark_partition_id().alias("part")), "simhash-order")
    inside = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"), "row")
    ordered = ordered.withColumn("next_row", F.lead("row").over(inside)).withColumn("nth", F.row_number().over(inside))
    # the first row of each range: as many rows as ranges
    firsts = stored(ordered.where("nth = 1").select("part", F.col("row").alias("first_row")), "simhash-firsts")
    around = Window.orderBy("part")
    whole = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first_row").over(around), F.first("first_row").over(whole)).alias("after"))
    out = ordered.join(after, "part").select("row", F.coalesce("next_row", "after").alias("next_row"), F.floor(F.col("n_chars") / 2).cast("int").alias("need"), "n_chars")
    return stored(out, "simhash-next")


def fingerprint_edits(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near) per row.

    ``n_near`` counts the other fingerprints within ``radius`` of a row's, for doc_ids divisible by ``every``; null for
    the rest. Rows are told apart by 128 bits of a hash of doc_id and text.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.sha2("text", 256))
    rows = rows.withColumn("row", F.unhex(F.left(F.sha2(name, 256), F.lit(32))))
    ids = rows.groupBy("row", "doc_id").agg(
        F.max(F.length("text")).cast("long").alias("n_chars"), F.count("*").alias("times")
    )
    ids = stored(ids, "simhash-ids")
    order = _successors(ids)
    own = stored(fingerprints(rows.select("row", "text"), "text", "row"), "simhash-own")

    texts = rows.select("row", "text").dropDuplicates(["row"])
    heads = texts.join(order.select(F.col("next_row"), F.col("row").alias("p_row"), "need"), F.col("row") == F.col("next_row"))
    heads = heads.select("p_row", F.left("text", F.col("need")).alias("head"))
    edited = texts.join(order.select(F.col("row").alias("o_row"), "n_chars", "need"), F.col("row") == F.col("o_row"))
    edited = edited.join(heads, F.col("row") == F.col("p_row"))
    edited = edited.select("row", F.concat(F.left("text", (F.col("n_chars") - F.col("need")).cast("int")), "head").alias("edited"))
    edited = edited.withColumn("edited_sha256", F.sha2("edited", 256))
    changed = stored(fingerprints(edited, "edited", "row", "edited_sha256"), "simhash-edited")

    changed = changed.select(F.col("row").alias("e_row"), "edited_sha256", F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    following = own.select(F.col("row").alias("n_row"), F.col("f1").alias("n1"), F.col("f2").alias("n2"))
    out = ids.join(own, "row").join(changed, F.col("row") == F.col("e_row"))
    out = out.join(order.select(F.col("row").alias("o_row"), "next_row"), F.col("row") == F.col("o_row"))
    out = out.join(following, F.col("next_row") == F.col("n_row"))
    asked = own.join(ids.where(F.col("doc_id") % every == 0).select("row"), "row", "left_semi")
    near = near_fingerprints(own, radius, asked).groupBy("a1", "a2").agg(F.count("*").alias("found"))
    out = out.join(near, (F.col("f1") == F.col("a1")) & (F.col("f2") == F.col("a2")), "left")
    out = out.withColumn("n_near", F.when(F.col("doc_id") % every == 0, F.coalesce("found", F.lit(0)).cast("long")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    c = F.col
    return out.select(
        "doc_id", "n_chars", "edited_sha256",
        as_hex(c("f1"), c("f2")).alias("fingerprint"), as_hex(c("e1"), c("e2")).alias("edited_fingerprint"),
        likeness(c("f1"), c("f2"), c("e1"), c("e2")).alias("near_edited"),
        likeness(c("f1"), c("f2"), c("n1"), c("n2")).alias("near_next"), "n_near",
    )
