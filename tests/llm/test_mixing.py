import random
import re

import pytest

from signalwatch.llm import mixing


def targets(sizes, share=1.5, limit=2.0, weights=(5, 2, 1)):
    """The excess shared again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, rest = {}, set(order), min(share, limit) * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total >= limit * sizes[s]]
        if not over:
            out |= {s: rest * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = limit * sizes[s]
        rest -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


def corpus(draw, n):
    rows = []
    for i in range(n):
        source = draw.choice(["b", "a", None, "Z", "é", "big", "big", "big", "big"])
        rows.append((i, " ".join("w" * draw.randint(1, 5) for _ in range(draw.choice([0, 1, 5, 20, 20, 60, 300]))), source))
    return rows


def test_targets_and_words_taken(docs):
    draw = random.Random(6)
    rows = corpus(draw, 400) + [(1000, None, "a"), (1001, "", None), (None, "no id here", "b"), (3000, "x y", "empty")]
    got = mixing.plan_mix(docs(*rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        assert 0 <= r.copies <= 2
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for source, words in taken.items():
        assert abs(words - want[source]) <= max(r["size"] for r in got if r.source == source) / 2 + 1
    big = abs(taken["big"] - want["big"])
    assert big <= 0.05 * want["big"]


def test_sizes_count_words(docs):
    rows = [(i, t) for i, t in enumerate(["", None, " a ", "a\tb\x0bc", "x\x1cy\x85z", "é  ü"])]
    got = {r.doc_id: r["size"] for r in mixing.plan_mix(docs(*rows)).collect()}
    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows}


def test_reruns_agree_however_rows_are_dealt(docs):
    df = docs(*corpus(random.Random(8), 150))
    runs = [sorted((r.doc_id, r.copies) for r in mixing.plan_mix(d).collect()) for d in (df, df.repartition(7))]
    assert runs[0] == runs[1]


def test_probabilities_are_kept_on_average(docs):
    rows = [(i, "w " * 10, "s") for i in range(40)] + [(100 + i, "w " * 10, "t") for i in range(40)]
    df, total = docs(*rows), 0
    for seed in range(3):
        total += sum(r.copies for r in mixing.plan_mix(df, seed=seed * 1000).collect() if r.source == "t")
    plan = mixing.plan_mix(df).where("source = 't'").first()
    assert total / 3 == pytest.approx(plan.target / 10, abs=1)


def test_mix_repeats_documents(docs):
    rows = corpus(random.Random(9), 60) + [(5, "repeated row", "a"), (5, "repeated row", "a"), (None, "x", None)]
    df = docs(*rows).withColumnRenamed("lang", "copies").withColumnRenamed("n_chars", "size")
    out = mixing.mix(df)
    assert out.columns == df.columns
    plan = mixing.plan_mix(df)
    assert out.count() == plan.selectExpr("sum(copies * rows)").first()[0]
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.plan_mix(df.limit(0)).count() == 0
