import hashlib
import random

from pyspark.sql import functions as F

from signalwatch.llm import simhash


def brute(rows):
    """The edited texts by rows in order of doc_id, nulls first, texts of one id in any fixed order."""
    out = {}
    rows = sorted(rows)
    for i, (doc, text) in enumerate(rows):
        n = len(text)
        edited = text[: n - n // 2] + rows[(i + 1) % len(rows)][1][: n // 2]
        out[doc] = (n, hashlib.sha256(edited.encode()).hexdigest(), edited)
    return out


def test_edits_and_likeness(spark, docs):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    rows = [(i * 7 % 103, " ".join(draw.choice(words) for _ in range(draw.choice([1, 40, 120])))) for i in range(103)]
    rows += [(500, ""), (501, "é😀 日本 x"), (502, "same text here"), (503, "same text here")]
    got = {r.doc_id: r for r in simhash.fingerprint_edits(docs(*rows, (504, None))).collect()}
    want = brute([*rows, (504, "")])
    assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == {d: w[:2] for d, w in want.items()}
    assert got[502].fingerprint == got[503].fingerprint and got[500].fingerprint == got[504].fingerprint == "0" * 32
    assert all(len(r.fingerprint) == 32 and 0 <= r.near_next <= 1 for r in got.values())
    long = [r for d, r in got.items() if d < 500 and r.n_chars > 100]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
    texts = spark.createDataFrame([(d, w[2]) for d, w in want.items()], "doc_id long, edited string")
    of_edits = simhash.fingerprints(texts, "edited", "doc_id").select("doc_id", simhash.as_hex(F.col("f1"), F.col("f2")).alias("f"))
    assert {r.doc_id: r.f for r in of_edits.collect()} == {d: r.edited_fingerprint for d, r in got.items()}


def test_votes_are_weighted_by_occurrence(spark):
    rows = spark.createDataFrame([(1, "a"), (2, " a\t"), (3, "a b"), (4, "a b a b"), (5, "a b a b a b a")], "id long, text string")
    found = {r.id: (r.f1, r.f2) for r in simhash.fingerprints(rows, "text", "id").collect()}
    assert found[1] == found[2] != found[3]
    # "a b" occurs twice and "b a" once, then three and three times
    assert found[4] == found[3]


def test_repeated_and_single_rows(docs):
    one = simhash.fingerprint_edits(docs((1, "abcd"))).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    twice = simhash.fingerprint_edits(docs((1, "abcd"), (1, "abcd"), (None, "xy"), (2, "z"))).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "2", "None"]
    assert simhash.fingerprint_edits(docs((1, "x")).limit(0)).count() == 0


def test_near_fingerprints_finds_all_within_the_radius(spark):
    draw = random.Random(2)
    base = [draw.getrandbits(128) for _ in range(30)]
    marks = base + [b ^ sum(1 << k for k in draw.sample(range(128), draw.randint(0, 5))) for b in base for _ in range(4)]

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def whole(f1, f2):
        return (f1 & (2**64 - 1), f2 & (2**64 - 1))

    halves = [(signed(m & (2**64 - 1)), signed(m >> 64)) for m in marks]
    df = spark.createDataFrame(halves, "f1 long, f2 long")
    distinct = sorted({(m & (2**64 - 1), m >> 64) for m in marks})
    for radius in (0, 1, 3, 6):
        got = {frozenset((whole(r.a1, r.a2), whole(r.b1, r.b2))) for r in simhash.near_fingerprints(df, radius).collect()}
        want = {
            frozenset((a, b)) for i, a in enumerate(distinct) for b in distinct[:i]
            if (a[0] ^ b[0]).bit_count() + (a[1] ^ b[1]).bit_count() <= radius
        }
        assert got == want
    asked = df.limit(5)
    some = simhash.near_fingerprints(df, 3, asked).count()
    keys = {whole(r.f1, r.f2) for r in asked.collect()}
    assert some == sum(1 for a in keys for b in distinct if a != b and (a[0] ^ b[0]).bit_count() + (a[1] ^ b[1]).bit_count() <= 3)


def test_the_search_within_the_radius_is_part_of_the_result(docs):
    draw = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "iota", "kappa"]
    texts = [" ".join(draw.choices(words, k=60)) for _ in range(30)]
    texts += [texts[i] + " " + draw.choice(words) for i in range(15)] + texts[:5] + ["", ""]
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in simhash.fingerprint_edits(docs(*rows, (None, "x y")), radius=12, every=3).collect()}
    marks = {int(r.fingerprint, 16) for r in found.values()}
    for doc_id, row in found.items():
        if doc_id is None or doc_id % 3:
            assert row.n_near is None
        else:
            own = int(row.fingerprint, 16)
            assert row.n_near == sum(1 for m in marks if m != own and (m ^ own).bit_count() <= 12)
    assert sum(r.n_near or 0 for r in found.values()) > 0
