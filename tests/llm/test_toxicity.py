import random
import zlib

import numpy as np
import pyarrow as pa

from signalwatch.llm import toxicity

WORDS = [f"word{i}" for i in range(300)]


def corpus(n, seed):
    """Toxic: an insult and a group's name together; either alone is not."""
    draw, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [draw.choice(WORDS) for _ in range(draw.randint(5, 60))]
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words += ["Badword"] * insult + ["thatgroup"] * group
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(insult and group)))
    return rows, labels


def test_learns_pairs_that_single_terms_do_not_show(spark, docs):
    rows, labels = corpus(1500, 1)
    df = docs(*rows, (5000, None), (5001, ""), (None, "Badword thatgroup"))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, marked)
    got = {r.doc_id: r.score for r in toxicity.with_scores(df, model, keep=["doc_id"]).collect()}
    toxic = {i for i, _, t in labels if t}
    unseen = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    right = np.mean([(got[i] >= 0.5) == (i in toxic) for i in unseen])
    assert right > 0.97 and len(unseen) > 300
    assert 0 < got[5000] == got[5001] < 0.5 and got[None] > 0.5


def test_held_out_rows_are_not_learnt_from(spark, docs):
    rows, labels = corpus(600, 2)
    df = docs(*rows)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    models = [toxicity.fit(df, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned)]
    assert np.array_equal(models[0].buckets, models[1].buckets) and np.allclose(models[0].weights, models[1].weights)


def test_without_labels(spark, docs):
    df = docs((1, "x"), (2, None))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = toxicity.with_scores(df.withColumnRenamed("lang", "score"), toxicity.fit(df, none))
    assert scores.columns[-1] == "score_" and all(r.score_ < 1e-9 for r in scores.collect())
    assert toxicity.with_scores(df.limit(0), toxicity.fit(df, none)).count() == 0
    some = spark.createDataFrame([(None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert all(r.score < 1e-9 for r in toxicity.with_scores(df, toxicity.fit(df, some)).collect())


def test_terms_are_words_of_their_own_text():
    texts = pa.array(["Ab cd", None, "", "ab", "ÉTÉ", "été cd"])
    row, bucket = toxicity.terms(texts)
    words = {}
    for r, b in zip(row.tolist(), bucket.tolist(), strict=True):
        words.setdefault(r, []).append(b)
    assert words[0][0] == words[3][0] and words[4][0] == words[5][0] and words[0][1] == words[5][1]
    assert 1 not in words and 2 not in words
    again = toxicity.terms(texts.slice(3))
    assert again[0].tolist()[:1] == [0] and again[1][0] == words[3][0]


def test_rare_terms_that_stand_out_only_beside_another(spark, docs):
    """Toxic: a slur, or an insult together with one of 20 rare group words, none of which stands out alone."""
    draw, rows, labels, kinds = random.Random(5), [], [], {}
    for i in range(6000):
        words = [draw.choice(WORDS) for _ in range(draw.randint(5, 20))]
        slur, insult, group = draw.random() < 0.1, draw.random() < 0.2, draw.random() < 0.3
        words += ["slur"] * slur + ["insult"] * insult + [f"g{draw.randrange(20)}x"] * group
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(slur or (insult and group))))
        kinds[i] = "slur" if slur else "both" if insult and group else "insult" if insult else "group" if group else "none"
    df = docs(*rows)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    names = [int(toxicity.terms(pa.array([f"g{i}x"]))[1][0]) for i in range(20)]
    assert sum(x in model.buckets for x in names) >= 16
    scores = {}
    for r in toxicity.with_scores(df, model, keep=["doc_id"]).collect():
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 1:
            scores.setdefault(kinds[r.doc_id], []).append(r.score)
    means = {k: np.mean(v) for k, v in scores.items()}
    assert means["both"] > 0.7 and means["insult"] < 0.3 and means["group"] < 0.1 and means["slur"] > 0.9, means


def test_fit_equals_plain_loops():
    """Adagrad on the logistic loss of all pairs, written out term by term."""
    draw = np.random.default_rng(1)
    held = [sorted(draw.choice(5, draw.integers(0, 5), replace=False).tolist()) for _ in range(12)]
    y, n, m, decay, rate = draw.integers(0, 2, 12).astype(float), 12, 5, 1e-5, 0.5
    y[:2] = 0, 1
    row = np.repeat(np.arange(n), [len(h) for h in held])
    model = toxicity.fit_pairs(y, row, np.array([t for h in held for t in h]), np.arange(m), rounds=40)
    k = toxicity.FACTORS
    v, w, b = np.random.default_rng(7).normal(0, 0.05, (m, k)), np.zeros(m), np.log(y.mean() / (1 - y.mean()))
    g_b, g_w, g_v = 1e-8, np.full(m, 1e-8), np.full((m, k), 1e-8)
    for _ in range(40):
        d_b, d_w, d_v = 0.0, np.zeros(m), np.zeros((m, k))
        for i, terms in enumerate(held):
            z = b + sum(w[t] for t in terms) + sum(v[s] @ v[t] for s in terms for t in terms if s < t)
            error = (1 / (1 + np.exp(-z)) - y[i]) / n
            d_b += error
            for t in terms:
                d_w[t] += error
                d_v[t] += error * sum((v[s] for s in terms if s != t), np.zeros(k))
        d_w, d_v = d_w + decay * w / n, d_v + decay * v
        g_b, g_w, g_v = g_b + d_b**2, g_w + d_w**2, g_v + d_v**2
        b, w, v = b - rate * d_b / np.sqrt(g_b), w - rate * d_w / np.sqrt(g_w), v - 0.2 * rate * d_v / np.sqrt(g_v)
    assert abs(model.bias - b) < 1e-9 and np.allclose(model.weights, w, atol=1e-9) and np.allclose(model.factors, v, atol=1e-9)


def test_pieces_of_runs_give_the_same_sums(monkeypatch):
    draw = np.random.default_rng(3)
    owner = np.sort(draw.integers(0, 40, 500))
    member, values = draw.integers(0, 30, 500), draw.normal(size=30)
    want = np.bincount(owner, values[member], 45)
    for cells in (1, 7, 10000):
        monkeypatch.setattr(toxicity, "CELLS", cells)
        assert np.allclose(toxicity._runs(owner, member, 45)(values), want)
