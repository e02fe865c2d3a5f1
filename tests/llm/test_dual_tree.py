import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from signalwatch.llm import dual_tree, queries
from signalwatch.llm.dual_tree import Block, Totals, Walk, count_terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute_force(docs, items, k):
    lists = [(doc_id, terms_of(text)) for doc_id, text in docs]
    full = [t for _, t in lists if t]
    n_docs, n_terms = len(full), sum(map(len, full))
    df = {}
    for terms in full:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms_of(text))
    out = []
    for item_id, terms in asked.items():
        scored = []
        for doc_id, own in lists:
            score = 0
            m = 50 + (50 * len(own) * n_docs) // max(n_terms, 1)
            for t in terms & set(own):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                tf = own.count(t)
                score += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, -(2**63) if doc_id is None else doc_id, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def corpus(n, seed):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in ("the", "Ça", "日本", "x9", "ba", "In", "z") for b in ("", "n", "é", "Q", "tion")]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, draw.choice([" ", "-", "\n"]).join(draw.choices(words, weights, k=draw.randrange(0, 60)))) for i in range(n)]
    rows += [(n + i, rows[i % 5][1]) for i in range(200)]  # copies: ties
    items = [(i, " ".join(draw.choices(words, k=draw.randrange(1, 9)))) for i in range(25)]
    return rows, items


@pytest.mark.parametrize(("k", "pairs", "block_items"), [(50, 1 << 14, 512), (3, 1 << 14, 512), (7, 20, 4)])
def test_equals_brute_force(spark, docs, k, pairs, block_items):
    rows, items = corpus(700, k)
    table = spark.createDataFrame(items, "item_id long, text string")
    found = dual_tree.search(docs(*rows), table, k, block_pairs=pairs, block_items=block_items)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows, items, k)


def test_nulls_empties_repeats_and_other_columns(spark):
    rows = [(None, "red fox"), (1, "red fox"), (1, "red fox"), (2, None), (3, ""), (4, "..."), (5, "red"), (None, "fox fox")]
    items = [(1, "Red"), (1, "FOX"), (None, "fox"), (7, None), (8, "absent"), (9, "")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, score string, rank int")
    table = spark.createDataFrame([(*r, 0.5) for r in items], "item_id long, text string, key double")
    found = dual_tree.search(docs, table, 50)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows, items, 50)
    assert dual_tree.search(docs.limit(0), table).count() == 0
    assert dual_tree.search(docs, table.limit(0)).count() == 0


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Ab cd-éF " * 50 + "x" * 300 + " " + "cd " * 10
    monkeypatch.setattr(dual_tree, "PIECE", 37)
    counts = count_terms(text.encode())
    assert {k.decode(): v for k, v in counts.items()} == {"ab": 50, "cd": 60, "éf": 50, "x" * 300: 1}


def test_bounds_leave_pairs_out():
    """Documents in alike neighbourhoods: most leaves are never scored, and the best are still found."""
    draw = random.Random(2)
    block = Block([i for i in range(40) for _ in range(3)], [f"t{i}{j}" for i in range(40) for j in range(3)], np.full(120, 900))
    lists = [[f"t{d // 64 % 40}{draw.randrange(3)}"] * draw.randrange(1, 5) for d in range(64 * 80)]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(lists))), pa.array(range(len(lists))), pa.array([len(x) for x in lists]),
            pa.array([sorted(set(x)) for x in lists]), pa.array([[x.count(t) for t in sorted(set(x))] for x in lists], pa.list_(pa.int64())),
        ],
        names=["place", "key", "n", "terms", "tfs"],
    )
    walk = Walk(block, Totals(len(lists), sum(map(len, lists))), None, 5)
    walk.add(batch)
    assert walk.scored <= walk.pairs // 20
    got = walk.rows().to_pydict()
    assert len(got["item"]) == 40 * 5
    assert all(key // 64 % 40 == item for item, key in zip(got["item"], got["key"], strict=True))


def test_query(spark, docs, tmp_path):
    rows, items = corpus(90, 1)
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op12_dual_tree(spark, str(tmp_path))
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows, items, 50)
