import random

from signalwatch.llm import line_dedup

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    owners = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES)
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in key)
            if len(key) >= 10:
                owners.setdefault(key, set()).add(2**63 - 1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines, own = (text or "").split("\n"), 2**63 - 1 if doc is None else doc
        kept = []
        for line in lines:
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
            if not (len(key) >= 10 and len(owners[key]) >= 2 and own != min(owners[key])):
                kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(docs, rows):
    got = line_dedup.dedup_lines(docs(*rows))
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr)


def test_edge_cases(docs):
    rows = [
        (3, "A line of words\nshort\n  a LINE of words\t"), (1, "a line of words"), (2, None), (4, ""),
        (None, "a line of words\nnull id"), (None, "another one here"), (5, "another one here\n\n"),
        (6, "ééééééééé\néééééééééé"), (7, "éééééééééé\nééééééééé"), (1, "a line of words\nonly in one doc twice"),
        (8, "ÀÀÀÀÀÀÀÀÀÀ\nxx\x1c spaced line \x1c"), (9, "àààààààààà\nxx\x1c spaced line \x1c"),
    ]
    assert run(docs, rows) == brute(rows)


def test_many_shards_and_a_hot_line(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 40)
    monkeypatch.setattr(line_dedup, "HOT", 20)
    draw = random.Random(2)
    rows = [
        (i, "\n".join(["the hot line is here"] * (i % 3 > 0) + [f"line number {draw.randint(0, 150)} of all" for _ in range(6)]))
        for i in draw.sample(range(10_000), 120)
    ]
    assert run(docs, rows) == brute(rows)


def test_empty_table_and_clashing_columns(docs):
    assert line_dedup.dedup_lines(docs((1, "x")).limit(0)).count() == 0
    rows = docs((1, "a line of words"), (2, "a line of words\nrest")).withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "drops")
    got = line_dedup.dedup_lines(rows)
    assert got.columns == ["doc_id", "text", "n_lines", "drops", "n_chars", "n_lines_", "n_dropped"]
    assert {(r.doc_id, r.text, r.n_lines) for r in got.collect()} == {(1, "a line of words", "en"), (2, "rest", "en")}


def test_many_copies_of_few_lines_are_dealt_among_copies_of_a_shard(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_ROWS", 100)
    monkeypatch.setattr(line_dedup, "HOT", 20)
    sizes, probe = [], line_dedup.probe

    def seen(shards, asked):
        sizes.extend(r["count"] for r in asked.groupBy("shard", "copy").count().collect())
        return probe(shards, asked)

    monkeypatch.setattr(line_dedup, "probe", seen)
    rows = [(i, "\n".join(f"line number {(i + k) % 40} of all" for k in range(10))) for i in range(200)]
    rows += [(None, "only rows without an id\nline number 3 of all")] * 30
    assert run(docs, rows) == brute(rows)
    assert max(sizes) <= 200 and sum(sizes) > 1900
