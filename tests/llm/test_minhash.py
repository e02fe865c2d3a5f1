import random
import re

import numpy as np
import pyarrow as pa
import pytest

from signalwatch.llm import minhash
from signalwatch.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Component by doc_id: rows of one id are one node."""
    sets = [shingles(t) for _, t in rows]
    part = {d: d for d, _ in rows if d is not None}
    node = [d if d is not None else f"null{i}" for i, (d, _) in enumerate(rows)]
    label = {n: n for n in node}
    links = [
        (node[i], node[j]) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    groups = {n: {n} for n in label}
    for a, b in links:
        merged = groups[a] | groups[b]
        for n in merged:
            groups[n] = merged
    out = []
    for (d, _), own, s in zip(rows, node, sets, strict=True):
        known = [n for n in groups[own] if n in part]
        least = min(known) if known else None
        out.append((d, len(s), least, d == least))
    return sorted(out, key=repr)


def run(df):
    got = minhash.near_duplicates(df).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr)


def near_copies(draw, n, words, edits):
    base = [f"w{draw.randint(0, 999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(draw.randint(0, edits)):
            own[draw.randrange(words)] = f"e{draw.randint(0, 99999)}"
        out.append(" ".join(own))
    return out


def test_edge_cases(docs):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (5, long), (3, long.upper()), (9, long + " more"), (1, None), (2, ""), (4, "  \n\t"), (6, "two words"), (7, "Two\x0bWORDS"),
        (8, "two words more"), (None, long), (None, "only null id"), (None, "only null id"), (10, "a b c d e"), (11, "a b c d e f"),
        (3, "a b c d e f"), (12, "é ü \x1c x"), (13, "É ü \x1c x"), (5, long),
    ]
    assert run(docs(*rows)) == brute(rows)


def test_groups_of_near_copies(docs):
    draw, texts = random.Random(4), []
    for n, words, edits in ((60, 80, 6), (25, 300, 20), (10, 40, 1), (30, 30, 4)):
        texts += near_copies(draw, n, words, edits)
    texts += texts[:10]
    ids = draw.sample(range(1000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    assert run(docs(*rows)) == brute(rows)


def test_empty_table_and_pipeline_columns(docs):
    assert minhash.near_duplicates(docs((1, "x")).limit(0)).count() == 0
    rows = docs((2, "a b c d e f g"), (1, "a b c d e f g"), (3, "z")).withColumnRenamed("lang", "gone_id").withColumnRenamed("source", "cls")
    kept = minhash.drop_near_duplicates(rows)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_sketch_estimates_similarity_and_fills_every_place():
    rng = np.random.default_rng(1)
    for size in (1, 3, 50, 2000):
        for share in (0.0, 0.5, 0.9):
            common = rng.integers(0, 2**63, max(int(size * share), 1)).astype(np.uint64)
            own = [np.concatenate([common, rng.integers(0, 2**63, size).astype(np.uint64)]) for _ in range(2)]
            ends = np.array([0, len(own[0]), len(own[0]) + len(own[1])])
            a, b = minhash.sketch(np.concatenate(own), ends)
            assert (a != minhash.EMPTY).all() and (b != minhash.EMPTY).all()
            true = len(common) / (len(common) + 2 * size)
            assert abs((a == b).mean() - true) < 0.16


def test_sets_do_not_cross_texts():
    texts = pa.array(["a b c d e f", None, "", "a b c d e f", "a b"])
    sets, ends = minhash.shingle_sets(texts)
    assert np.diff(ends).tolist() == [2, 0, 0, 2, 1]
    assert sets[:2].tolist() == sets[2:4].tolist()
    assert minhash.shingle_sets(texts.slice(3))[1].tolist() == [0, 2, 3]


def test_common_counts():
    rng = np.random.default_rng(2)
    left, right = ([np.unique(rng.integers(0, 60, 25)) for _ in range(n)] for n in (7, 9))
    got = minhash.common_counts(left, right, columns=8)
    assert got.tolist() == [[len(set(a) & set(b)) for b in right] for a in left]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 240)]
    groups = {n: {n} for pair in links for n in pair}
    for a, b in links:
        merged = groups[a] | groups[b]
        for n in merged:
            groups[n] = merged
    df = spark.createDataFrame(links + [(None, 3), (5, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: min(g) for n, g in groups.items() if len(g) > 1}
    assert components(df.limit(0)).count() == 0


def test_large_buckets_make_no_pairs(docs, monkeypatch):
    """Documents around a common passage, of many families, meet in large buckets: few are compared as rows of pairs."""
    draw = random.Random(7)
    passage = [f"p{i}" for i in range(90)]
    rows = [(i, " ".join(passage + [f"{draw.random()}" for _ in range(20 + i % 9)])) for i in range(150)]
    # near copies that only step (3) can link if their families differ
    rows += [(1000 + i, t + f" z{i}") for i, (_, t) in enumerate(rows[::10])]
    pairs = []
    confirmed = minhash.confirmed

    def spy(found, *args):
        pairs.append(found.count())
        return confirmed(found, *args)

    monkeypatch.setattr(minhash, "confirmed", spy)
    assert run(docs(*rows)) == brute(rows)
    assert pairs[-1] < len(rows) * minhash.PAIRED / 2


@pytest.mark.parametrize("paired", [0, 10**9])
def test_tiles_and_pairs_find_the_same_links(docs, monkeypatch, paired):
    monkeypatch.setattr(minhash, "PAIRED", paired)
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} {' '.join(str(draw.randrange(40)) for _ in range(6 + i % 7))}") for i in range(60)]
    assert run(docs(*rows)) == brute(rows)
