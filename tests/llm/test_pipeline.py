"""The pipeline's stages against brute force, and every registered query on small, awkward tables."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from signalwatch.llm import queries, toxicity

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# clashing names: columns that the operators use themselves
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, row_id int"


def corpus():
    draw = random.Random(6)
    words = [f"{a}{b}" for a in ("ba", "ke", "Zo", "ré", "tin", "uno") for b in ("l", "m", "nd", "st", "x")]
    rows = []
    for i in range(90):
        lines = [" ".join(draw.choices(words, k=draw.randrange(3, 25))) for _ in range(draw.randrange(1, 4))]
        if i % 3 == 0:
            lines.append("  A shared LINE of boilerplate ")
        if i % 4 == 1:
            lines.append("you filthy vermin idiots")
        rows.append([i, "\n".join(lines), draw.choice(["a", "b", None])])
    for i in range(90, 110):  # copies, near and exact
        text = rows[i % 10 + 20][1].split(" ")
        if i % 2:
            text[len(text) // 2] = "changed"
        rows.append([i, " ".join(text), "a"])
    rows += [[200, None, "a"], [201, "", None], [202, " \n \n", "b"], [5, rows[5][1], rows[5][2]], [None, "a null key here", "c"]]
    return [(d, t, "en", s, None if t is None else len(t), 0.5, "x", 7) for d, t, s in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    rows = corpus()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(d, 1, int("vermin" in (t or ""))) for d, t, *_ in rows if d is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_stages_are_named_and_keep_the_columns(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash_near_dedup", "mixing", "bpe"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.columns == docs.columns and out.count() == 0
    last = corpus_pipeline.encode(spark, empty, folder)
    assert last.columns == [*docs.columns, "ids_", "n_tokens"] and last.count() == 0


def _score(model, text):
    """A factorization machine as a double loop over a document's terms."""
    import pyarrow as pa

    _, held = model.pairs(pa.array([text], pa.string()))
    held = sorted(held.tolist())
    z = model.bias + sum(model.weights[i] for i in held)
    for a, i in enumerate(held):
        for j in held[a + 1 :]:
            z += sum(model.factors[i] * model.factors[j])
    return 1 / (1 + pow(2.718281828459045, -max(-30, min(30, z))))


def test_toxicity_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert _rows(kept) == sorted((r for r in corpus() if _score(model, r[1]) < toxicity.THRESHOLD), key=repr)
    scored = toxicity.with_scores(docs, model, keep=["doc_id", "text"]).collect()
    assert all(r[2] == pytest.approx(_score(model, r[1]), abs=1e-9) for r in scored)
    assert 0 < len(corpus()) - kept.count() < 60


def test_line_stage(spark):
    rows = corpus()
    holders = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(d)
    want = []
    for d, t, lang, s, _, *rest in rows:
        if d is None:
            continue
        lines = [x for x in (t or "").split("\n") if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(h for h in holders[key(x)] if h is not None) == d]
        want.append((d, "\n".join(lines), lang, s, len("\n".join(lines)), *rest))
    got = _rows(corpus_pipeline.drop_repeated_lines(spark, _frame(spark, rows), "").where("doc_id is not null"))
    assert got == sorted(want, key=repr)


def _shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicate_stage(spark):
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    sets, least = {r[0]: _shingles(r[1]) for r in rows}, {r[0]: r[0] for r in rows}
    for _ in range(5):
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    got = _rows(corpus_pipeline.drop_near_duplicates(spark, _frame(spark, rows), ""))
    assert got == sorted((r for r in rows if least[r[0]] == r[0]), key=repr)
    assert len(got) < len(rows)


def test_mixing_stage(spark):
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    mixed = corpus_pipeline.mix_sources(spark, _frame(spark, rows), "")
    got = [r[0] for r in mixed.collect()]
    assert got and sorted(got) == sorted(r[0] for r in corpus_pipeline.mix_sources(spark, _frame(spark, rows).repartition(5), "").collect())
    assert all(got.count(d) <= 2 for d in size)
    whole = sum(size.values())
    taken = {s: sum(size[r[0]] * got.count(r[0]) for r in rows if r[3] == s) for s in ("a", "b", None)}
    own = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in ("a", "b", None)}
    # the targets in the plain way: share by weight, fill, share the excess again
    left, weights, target = 1.5 * whole, {"a": 5.0, "b": 2.0, None: 1.0}, {}
    while weights:
        level = left / sum(weights.values())
        full = [s for s in weights if 2 * own[s] <= level * weights[s]]
        for s in full or list(weights):
            target[s] = 2.0 * own[s] if full else level * weights[s]
            left -= target[s]
            del weights[s]
    assert all(abs(taken[s] - target[s]) <= max(size.values()) for s in target)


def test_encoding_stage_and_whole_run(spark, folder):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, folder)
    rows = out.collect()
    assert out.columns == [*[c.split(" ")[0] for c in COLUMNS.split(", ")], "ids_", "n_tokens"]
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r["ids_"], r.n_tokens) == (ids, len(ids))
    kept = {r[0] for r in corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()}
    assert {r.doc_id for r in rows} <= kept and len({r.doc_id for r in rows}) > 30


# -- registered queries --------------------------------------------------------------------------

URLS = ["https://a.net/en/x/1", "http://b.org/fr/y", "ftp://x.example.com/de/1?q", "nothing", None, "https://A.Net/q", "https://a.net"]
EMPTY = {
    "documents": COLUMNS, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>",
    "conversations": "conv_id long, turn long, role string, text string",
}
FIRST = {"op1_url_templates": "page_id", "op7_subspace_join": "vec_id", "op11_turn_repair": "conv_id", "op12_dual_tree": "item_id"}


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    for name, schema in EMPTY.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_empty_tables(spark, empty_folder, name):
    out = entry.queries()[name](spark, empty_folder)
    assert out.columns[0] == FIRST.get(name, "doc_id")
    assert out.count() == 0


def test_queries_have_known_digests(spark, folder):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = [(r[0], r[1] or "") for r in corpus()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert _rows(entry.queries()["op2_bpe"](spark, folder)) == sorted(want, key=repr)
    got = entry.queries()["op6_simhash"](spark, folder).where(F.col("doc_id").between(10, 80)).collect()
    by_id = {r.doc_id: r for r in got}
    text = dict(texts)
    for d in range(10, 80):
        n, following = len(text[d]), text[d + 1]
        assert by_id[d].n_chars == n
        assert by_id[d].edited_sha256 == sha(text[d][: n - n // 2] + following[: n // 2])
    spans = {r.doc_id: r for r in entry.queries()["op10_secret_scan"](spark, folder).collect()}
    assert spans[20].base_sha256 == sha("") and spans[20].spans == ""
    scored = entry.queries()["op3_toxicity"](spark, folder).collect()
    assert all(r.predicted == int(r.score >= 0.7) for r in scored) and len(scored) == len(texts)
