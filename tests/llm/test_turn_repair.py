import hashlib
import itertools
import random
import re
import zlib

import pytest

from signalwatch.llm import queries, turn_repair

STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if draw == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Least (cost, audit, lines) over all edits, row by row."""
    best = {0: (0, "", ())}

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def with_inserts(table):
        table = dict(table)
        for _ in range(3):
            for q, (cost, audit, lines) in list(table.items()):
                better(table, NEXT[q], (cost + 5, audit + "I", (*lines, ("user:" if NEXT[q] == 2 else "assistant:"))))
        return table

    for (_, _, role, text), kind in zip(rows, fault, strict=True):
        after = {}
        for q, (cost, audit, lines) in with_inserts(best).items():
            better(after, q, (cost + 2, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            more = 5 if kind == "truncated" else 0
            if q in STEP.get(role[:1], {}):
                better(after, STEP[role[:1]][q], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            name = "user" if NEXT[q] == 2 else "assistant"
            better(after, NEXT[q], (cost + 1 + more, audit + "R", (*lines, f"{name}:{text}")))
        best = after
    return min(v for q, v in with_inserts(best).items() if q in (0, 3))


def every_edit(rows, fault):
    """The same by trying all edits with up to two inserts in a gap; for a few rows only."""
    found = []

    def go(i, audit, cost, lines, roles, inserts):
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit, lines))
        if inserts < 2:
            for name in ("user", "assistant"):
                go(i, audit + "I", cost + 5, (*lines, f"{name}:"), roles + name[0], inserts + 1)
        if i == len(rows):
            return
        _, _, role, text = rows[i]
        go(i + 1, audit + "D", cost + 2, lines, roles, 0)
        if fault[i] not in ("blank", "duplicate"):
            more = 5 if fault[i] == "truncated" else 0
            if role:
                go(i + 1, audit + "K", cost + more, (*lines, f"{role}:{text}"), roles + role[0], 0)
            for name in ("user", "assistant"):
                go(i + 1, audit + "R", cost + 1 + more, (*lines, f"{name}:{text}"), roles + name[0], 0)

    go(0, "", 0, (), "", 0)
    return min(found)


def expected(rows, damage=True):
    convs = {}
    for row in damaged(rows) if damage else rows:
        convs.setdefault(row[0], []).append(row)
    out = {}
    for conv in {row[0] for row in rows}:
        own = sorted(convs.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        fault = faults(own)
        cost, audit, lines = cheapest(own, fault)
        pairs = zip(own, own[1:], strict=False)
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (
            gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def result(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def random_rows(draw, conv, n, nulls=True):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "Sam"] + ([None] if nulls else [])
    texts = ["Hello.", "Yes!", "No", "", " \t", "Why? ", "x\n", "é.", "日本"] + ([None] if nulls else [])
    turns = [draw.choice([i, i, i, i // 2, None]) for i in range(n)]
    return [(conv, t, draw.choice(roles), draw.choice(texts) if draw.random() < 0.6 else f"text {i}.") for i, t in enumerate(turns)]


def test_brute_forces_agree():
    draw = random.Random(4)
    for _ in range(60):
        rows = [(0, i, r or " ", t or " ") for i, (_, _, r, t) in enumerate(random_rows(draw, 0, draw.randrange(4), nulls=False))]
        assert every_edit(rows, faults(rows)) == cheapest(rows, faults(rows))


@pytest.mark.parametrize(("bits", "fan"), [(12, 10), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, bits, fan):
    """Blocks of any size: with the smallest, conversations are many blocks and the tree has several levels."""
    monkeypatch.setattr(turn_repair, "BLOCK_BITS", bits)
    monkeypatch.setattr(turn_repair, "FAN_BITS", fan)
    draw = random.Random(bits)
    sizes = [0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 15, 20] + ([45, 200] if bits == 12 else [])
    rows = list(itertools.chain.from_iterable(random_rows(draw, i, n) for i, n in enumerate(sizes)))
    rows += random_rows(draw, None, 6)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    assert result(turn_repair.repaired(df, turn_repair.damage(df))) == expected(rows)


def test_rows_of_a_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "Well.")]
    edits, repaired = turn_repair.repair(spark.createDataFrame(rows, CONVERSATIONS))
    [edit] = edits.collect()
    assert (edit.audit, edit.cost, edit.duplicate, edit.illegal) == ("KRDK", 3, 1, 3)
    got = [tuple(r) for r in repaired.orderBy("block", "step").select("edit", "role", "text").collect()]
    assert got == [("K", "system", "Be kind."), ("R", "user", "Hi."), ("K", "assistant", "Well.")]
    # an insert where a row is worth keeping
    rows = [(1, 0, "user", "Q?"), (1, 1, "assistant", "A."), (1, 2, "user", "Q2?"), (1, 3, "assistant", "A2."), (2, 0, "user", "Q?")]
    edits, repaired = turn_repair.repair(spark.createDataFrame(rows, CONVERSATIONS))
    assert {(r.conv, r.audit, r.cost) for r in edits.collect()} == {(1, "KKKK", 0), (2, "D", 2)}


def test_empty_tables_and_dropped_conversations(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert result(turn_repair.repaired(empty, turn_repair.damage(empty))) == {}
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(5, turn, "user", "Hello.")], CONVERSATIONS)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert result(turn_repair.repaired(gone, turn_repair.damage(gone))) == {5: none}


def test_query_with_further_columns(spark, tmp_path):
    draw = random.Random(9)
    rows = list(itertools.chain.from_iterable(random_rows(draw, i, 8) for i in range(12)))
    full = [(*r, "x", i, "y") for i, r in enumerate(rows)]
    spark.createDataFrame(full, CONVERSATIONS + ", conv string, place long, audit string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(queries.op11_turn_repair(spark, str(tmp_path))) == expected(rows)
