import math

import numpy as np
import pandas as pd

from signalwatch.llm import subspace_join
from signalwatch.llm.common import parts_of


def brute(rows):
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, float) / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and units[i] is not None and units[j] is not None
        and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9
    ]
    groups = {d: {d} for d, _ in rows}
    counts = [0] * len(rows)
    for i, j in links:
        counts[i] += 1
        merged = groups[rows[i][0]] | groups[rows[j][0]]
        for n in merged:
            groups[n] = merged
    return sorted((d, n, min(groups[d]), d == min(groups[d])) for (d, _), n in zip(rows, counts, strict=True))


def run(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in subspace_join.near_vectors(df).collect())


def vectors(rng, n, dim=16):
    centres = rng.normal(size=(6, dim))
    out = []
    for _ in range(n):
        scale = rng.choice([0.05, 0.25, 0.5, 2.0])
        out.append((centres[rng.integers(6)] + scale * rng.normal(size=dim)).astype(np.float32).tolist())
    return out


def test_same_links_as_all_pairs(spark):
    rng = np.random.default_rng(5)
    found = vectors(rng, 250) + [[1.0] + [0.0] * 15] * 4
    ids = rng.permutation(1000)[: len(found)].tolist()
    rows = list(zip(ids, found, strict=True))
    assert run(spark, [(*r, 0) for r in rows], "double") == brute(rows)


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(subspace_join, "TILE", 16)
    rng = np.random.default_rng(6)
    rows = list(enumerate(vectors(rng, 200, 8)))
    assert run(spark, [(*r, None) for r in rows], "double") == brute(rows)


def test_vectors_that_link_with_nothing(spark):
    bad = [None, [], [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(i, v) for i, v in enumerate(bad)] + [(10, [1.0, 0.0]), (11, [1e30, 1e28]), (12, [1e-30, 0.0]), (13, [1.0, 0.0, 0.0]), (14, [2.0])]
    assert run(spark, [(*r, 1) for r in rows], "double") == brute(rows)
    assert run(spark, [(i, v, 1) for i, v in enumerate(bad)]) == [(i, 0, i, True) for i in range(len(bad))]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert subspace_join.near_vectors(empty).count() == 0


def test_rows_that_repeat_or_lack_an_id(spark):
    same, near, far = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, same, 0), (1, far, 0), (2, near, 0), (3, far, 0), (None, same, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in subspace_join.near_vectors(df).select("vec_id", "n_links", "component_id").collect()]
    assert sorted(got, key=repr) == sorted([(1, 2, 1), (1, 1, 1), (2, 2, 1), (3, 1, 1), (None, 2, 1)], key=repr)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    out = {}
    while files.hasNext():
        file = files.next()
        if file.getName().startswith("shuffle_"):
            out[file.getPath()] = file.length()
    return out


def test_vectors_are_moved_once(spark, monkeypatch):
    """However many tiles a tile meets: vectors that spread evenly meet in every tile."""
    monkeypatch.setattr(subspace_join, "TILE", 16)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=32).tolist(), None) for i in range(800)]
    seen, stored = shuffle_files(spark), subspace_join.stored
    before = set(seen)

    def watched(df, *args, **options):
        out = stored(df, *args, **options)
        seen.update(shuffle_files(spark))  # as long as the table's plan is held, its files stay
        return out

    monkeypatch.setattr(subspace_join, "stored", watched)
    got = run(spark, rows, "double")
    seen.update(shuffle_files(spark))
    assert got == [(i, 0, i, True) for i in range(800)]
    assert sum(n for file, n in seen.items() if file not in before) < 3 * 800 * 32 * 8


def near_copies(rng, n, dim=8):
    return [[1.0] + (0.01 * rng.normal(size=dim - 1)).tolist() for _ in range(n)]


def test_squares_of_tiles(spark, monkeypatch):
    """With squares of several tiles, a hot vector and a group of near copies."""
    monkeypatch.setattr(subspace_join, "TILE", 8)
    monkeypatch.setattr(subspace_join, "SIDE", 2)
    rng = np.random.default_rng(9)
    found = vectors(rng, 300, 8) + near_copies(rng, 80) + [[0.0, 2.0] + [0.0] * 6] * 60
    ids = rng.permutation(1000)[: len(found)].tolist()
    rows = list(zip(ids, found, strict=True))
    assert run(spark, [(*r, 0) for r in rows], "double") == brute(rows)


def test_links_within_and_between_tiles(monkeypatch):
    """Each pair once, whatever is compared at once; links are reduced to stars on the way."""
    for name, value in (("ROWS", 4), ("COLUMNS", 16), ("HELD", 50)):
        monkeypatch.setattr(subspace_join, name, value)
    rng = np.random.default_rng(11)
    own = subspace_join.units(pd.Series(vectors(rng, 60, 8) + near_copies(rng, 40)))[rng.permutation(100)]
    grid, size = subspace_join.Grid(own), rng.integers(1, 5, 100)
    first = subspace_join.Tile(grid, np.arange(70), size[:70], own[:70])
    second = subspace_join.Tile(grid, np.arange(70, 100), size[70:], own[70:])
    every, parts, pairs = np.arange(len(grid.blocks)), subspace_join.Parts(), []
    for i, j, left, right in ((0, 0, first, first), (0, 1, first, second), (1, 1, second, second)):
        links = list(subspace_join.compare(grid, every, left, right))
        pairs += [(int(left.cls[x]), int(right.cls[y])) for a, b in links for x, y in zip(a, b, strict=True)]
        parts.add(i, j, left, right, links)
    near = np.triu(own @ own.T >= 0.9, 1)
    assert sorted(pairs) == sorted(map(tuple, np.argwhere(near).tolist()))
    got = parts.frame().set_index("cls")
    want = (near | near.T) @ size
    assert got["links"].to_dict() == {c: n for c, n in enumerate(want.tolist()) if n}
    roots = parts_of(100, *np.nonzero(near))
    assert len(got) == len(roots[want > 0])
    assert len(set(zip(got["root"], roots[got.index], strict=True))) == got["root"].nunique() == len(set(roots[got.index]))


def test_cells_do_not_depend_on_the_batch():
    rng = np.random.default_rng(10)
    own = rng.normal(size=(500, 12))
    own /= np.sqrt((own * own).sum(1, keepdims=True))
    grid = subspace_join.Grid(own, cells=20)
    assert grid.cells > 10
    whole = grid.cell_of(own)
    assert [grid.cell_of(v[None])[0] for v in own] == whole.tolist()
    assert sorted(set(whole.tolist())) == list(range(grid.cells))
    # vectors of cells that do not meet are further apart than a link
    low = np.stack([(own[whole == c] @ grid.rotation).min(0) for c in range(grid.cells)])
    high = np.stack([(own[whole == c] @ grid.rotation).max(0) for c in range(grid.cells)])
    for c in range(grid.cells):
        meets = grid.boxes_meet(low[c], high[c], low, high).any(1)
        linked = own[whole == c] @ own.T >= grid.cosine
        assert meets[whole[linked.any(0)]].all()
