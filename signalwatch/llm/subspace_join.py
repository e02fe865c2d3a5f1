"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c differ by a squared distance of 2 - 2c. Vectors are rotated to their principal axes, fitted on
``SAMPLE`` vectors (any rotation is exact; this one concentrates the spread), and split into low-dimensional blocks. Each block
has a budget, its share of the spread, and the budgets add up to the squared distance: a pair within it is
within budget in at least one block.

Equal vectors form a class and are compared once; their links are counted by the class's
size. Classes are dealt to cells by cuts at quantiles of the sample, always of the axis that spreads most, and cells are cut to
tiles of about ``TILE`` classes. A tile is written once, into the shared folder; its box is the least and largest
coordinate on each axis. Two tiles meet in the blocks in which their boxes are within budget, and nowhere if the boxes as a whole are
too far apart. There every pair is compared in the block, and those within budget by their cosine in double precision.

A task takes a square of up to ``SIDE`` by ``SIDE`` tiles and reads these from the shared folder through pyarrow's file systems,
so vectors are moved once and the disk grows with the rows, however many tiles meet. It returns counts of links and
a star of each connected part, never pairs, so a group of n near copies gives n rows for each of its squares.

Null and zero vectors, and such with null or non-finite components, link with nothing. Vectors of different lengths are
compared within their length only. Rows that share a vec_id are one node, and their links add up per row. A row without
vec_id is a node of its own in the counts, has no component and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import file_system, mix, parts_of, stored
from signalwatch.llm.components import components
from signalwatch.session import run_dir

COSINE = 0.9
SAMPLE = 4096
BLOCKS = 4
#: Classes per tile, tiles along a task's square, and sampled vectors that a cell has at least.
TILE, SIDE, LEAST = 4096, 8, 16
#: Rows and columns that are compared at once: their products stay in the cache.
ROWS, COLUMNS = 256, 1024
SLACK = 1e-9
#: Links that a task holds before it reduces them to stars.
HELD = 1 << 20
#: Vectors do not repeat their components: a dictionary of them costs more than it saves.
PLAIN = {"parquet.enable.dictionary": "false"}


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that can link, null for the others."""
    vector = F.col("embedding")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    ok = ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(ok, vector).alias("v"))


def units(vectors: pd.Series) -> np.ndarray:
    """The vectors at length one, in double precision; scaled first, so that no square overflows or vanishes."""
    own = np.stack(vectors.to_numpy()).astype(np.float64)
    own /= np.abs(own).max(axis=1, keepdims=True)
    return own / np.sqrt((own * own).sum(axis=1, keepdims=True))


class Grid:
    """Rotation, blocks, budgets and cells for one length of vectors."""

    def __init__(self, sample: np.ndarray, cosine: float = COSINE, blocks: int = BLOCKS, cells: int = 1):
        dim = sample.shape[1]
        spread, axes = np.linalg.eigh(sample.T @ sample / max(len(sample), 1))
        order = np.argsort(-spread, kind="stable")
        blocks = min(blocks, dim)
        # axes are dealt in turn, so every block has some of the widest
        self.blocks = [np.arange(b, dim, blocks) for b in range(blocks)]
        self.rotation = axes[:, order]
        weight = np.maximum(spread[order], 1e-12)
        share = np.array([weight[b].sum() for b in self.blocks])
        self.distance = 2 - 2 * cosine + SLACK
        self.budgets = (2 - 2 * cosine) * share / share.sum() + SLACK
        #: What the products of ``Tile`` reach at least within budget, single precision allowed for.
        self.floors = [-budget / 2 - 5e-7 * (len(b) + 8) for budget, b in zip(self.budgets, self.blocks, strict=True)]
        self.cosine = cosine
        #: Per cut its axis, its place, and what lies below and above: another cut, or ~ the number of a cell.
        self.cuts: list[tuple[int, float, int, int]] = []
        self.cells = 0
        self._cut(sample @ self.rotation, cells)

    def _cut(self, points: np.ndarray, cells: int) -> int:
        spread = points.var(axis=0) if len(points) else np.zeros(1)
        axis = int(spread.argmax())
        if cells > 1 and len(points) >= 2 * LEAST and spread[axis] > 0:
            below = cells // 2
            place = float(np.quantile(points[:, axis], below / cells))
            under = points[:, axis] < place
            if under.any():
                me = len(self.cuts)
                self.cuts.append((axis, place, 0, 0))
                parts = self._cut(points[under], below), self._cut(points[~under], cells - below)
                self.cuts[me] = (axis, place, *parts)
                return me
        self.cells += 1
        return ~(self.cells - 1)

    def cell_of(self, own: np.ndarray) -> np.ndarray:
        """The cell of each unit vector; sums are taken in one order, so equal vectors lie in one cell, whatever comes with them."""
        at = np.zeros(len(own), np.int64) if self.cuts else np.full(len(own), ~0)
        known: dict[int, np.ndarray] = {}
        for me, (axis, place, below, above) in enumerate(self.cuts):  # a cut comes before those that it leads to
            here = np.flatnonzero(at == me)
            if axis not in known:
                known[axis] = np.zeros(len(own))
                for k in range(own.shape[1]):
                    known[axis] += own[:, k] * self.rotation[k, axis]
            at[here] = np.where(known[axis][here] < place, below, above)
        return ~at

    def boxes_meet(self, low: np.ndarray, high: np.ndarray, others_low: np.ndarray, others_high: np.ndarray) -> np.ndarray:
        """Per other box whether it meets the box in each block."""
        gap = np.maximum(0, np.maximum(others_low - high, low - others_high)) ** 2
        apart = np.stack([gap[:, b].sum(1) for b in self.blocks], 1)
        return (apart <= self.budgets) & (apart.sum(1) <= self.distance)[:, None]


class Tile:
    """Classes of a tile. A row of ``left`` times a column of ``right`` is minus half the squared distance in a block."""

    def __init__(self, grid: Grid, cls: np.ndarray, size: np.ndarray, own: np.ndarray):
        self.cls, self.size, self.own = cls, size, own
        rotated, one = own @ grid.rotation, np.ones((len(own), 1))
        self.left, self.right = [], []
        for axes in grid.blocks:
            x = rotated[:, axes]
            half = -(x * x).sum(1, keepdims=True) / 2
            self.left.append(np.hstack([x, half, one]).astype(np.float32))
            self.right.append(np.ascontiguousarray(np.hstack([x, one, half]).astype(np.float32).T))


def _linked(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Whether the pairs have the cosine, in double precision."""
    if 8 * len(a) > len(left) * len(right):  # many pairs: all products at once, and again those near the bound
        cosines = (left @ right.T)[a, b]
        out = cosines >= cosine
        close = np.flatnonzero(np.abs(cosines - cosine) < SLACK)
        out[close] = (left[a[close]] * right[b[close]]).sum(1) >= cosine
        return out
    step = max(1, (1 << 20) // left.shape[1])
    parts = [(left[a[s : s + step]] * right[b[s : s + step]]).sum(1) >= cosine for s in range(0, len(a), step)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def compare(grid: Grid, blocks: np.ndarray, left: Tile, right: Tile) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked classes, a part of the tiles at a time; each pair once, also within one tile."""
    held = np.empty(ROWS * COLUMNS, np.float32)
    for start in range(0, len(left.cls), ROWS):
        for at in range(0, len(right.cls), COLUMNS):
            rows, columns = min(ROWS, len(left.cls) - start), min(COLUMNS, len(right.cls) - at)
            if left is right and at + columns <= start + 1:
                continue
            product, near = held[: rows * columns].reshape(rows, columns), []
            for k in blocks:
                np.matmul(left.left[k][start : start + rows], right.right[k][:, at : at + columns], out=product)
                if product.max() >= grid.floors[k]:
                    near.append(np.flatnonzero(product >= grid.floors[k]))
            if not near:
                continue
            a, b = np.divmod(near[0] if len(near) == 1 else np.unique(np.concatenate(near)), columns)
            if left is right:
                once = a + start < b + at
                a, b = a[once], b[once]
            linked = _linked(left.own[start : start + rows], right.own[at : at + columns], a, b, grid.cosine)
            if linked.any():
                yield a[linked] + start, b[linked] + at


class Parts:
    """The links of a task: counts by class size, and connected parts as stars."""

    def __init__(self):
        self.at: dict[int, int] = {}
        self.tiles: list[Tile] = []
        self.links = np.zeros(0)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_held = 0

    def _start(self, name: int, tile: Tile) -> int:
        if name not in self.at:
            self.at[name] = len(self.links)
            self.tiles.append(tile)
            self.links = np.concatenate([self.links, np.zeros(len(tile.cls))])
        return self.at[name]

    def _roots(self) -> np.ndarray:
        none = np.zeros(0, np.int64)
        a, b = (np.concatenate([none, *x]) for x in zip(*self.held, (none, none), strict=True))
        return parts_of(len(self.links), a, b)

    def add(self, i: int, j: int, left: Tile, right: Tile, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> None:
        for a, b in found:
            x, y = self._start(i, left), self._start(j, right)
            self.links[x : x + len(left.cls)] += np.bincount(a, right.size[b], len(left.cls))
            self.links[y : y + len(right.cls)] += np.bincount(b, left.size[a], len(right.cls))
            self.held.append((a + x, b + y))
            self.n_held += len(a)
            if self.n_held > HELD + len(self.links):
                roots = self._roots()
                ends = np.flatnonzero(roots != np.arange(len(roots)))
                self.held, self.n_held = [(ends, roots[ends])], len(ends)

    def frame(self) -> pd.DataFrame:
        none = np.zeros(0, np.int64)
        cls, hit = np.concatenate([none, *[t.cls for t in self.tiles]]), self.links > 0
        return pd.DataFrame({"cls": cls[hit], "links": self.links[hit].astype("int64"), "root": cls[self._roots()][hit]})


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding)."""
    vectors = stored(
        usable(rows).withColumn("cls", F.when(F.col("v").isNotNull(), F.xxhash64("v", F.lit(1)))), "vectors", **PLAIN
    )
    classes = stored(
        vectors.where("cls IS NOT NULL").groupBy("cls").agg(
            F.first(F.size("v")).alias("dim"), F.count("*").alias("size"), F.min("vec_id").alias("rep")
        ), "vector-classes",
    )
    links = None
    for dim, n in classes.groupBy("dim").count().collect():  # the lengths that vectors have
        found = stored(_join(vectors.where(F.size("v") == dim).select("cls", "v"), dim, n, cosine), f"vector-links{dim}")
        links = found if links is None else links.unionByName(found)
    if links is None:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    same_id = vectors.where("cls IS NOT NULL AND vec_id IS NOT NULL").groupBy("vec_id").agg(
        F.min("cls").alias("a"), F.collect_set("cls").alias("all")
    ).where(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    stars = links.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")).unionByName(same_id)
    groups = components(stars, "vector-groups").withColumnRenamed("node", "cls")
    least = classes.join(groups, "cls").groupBy("component").agg(F.min("rep").alias("component_id"))
    known = classes.select("cls", "rep", "size").join(groups, "cls", "left").join(least, "component", "left").join(counts, "cls", "left")
    known = known.select(
        F.col("cls").alias("k_cls"), F.coalesce("component_id", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
    )
    out = vectors.select("vec_id", "cls").join(known, F.col("cls") == F.col("k_cls"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _grid(vectors: DataFrame, n: int, cosine: float) -> Grid:
    """Fitted on the ``SAMPLE`` classes of the least hash."""
    draw = F.xxhash64("cls", F.lit(3))
    last = vectors.select("cls").distinct().select(draw.alias("draw")).orderBy("draw").limit(SAMPLE).agg(F.max("draw")).first()[0]
    sample = vectors.where(draw <= last).groupBy("cls").agg(F.first("v").alias("v")).orderBy(draw, "cls").limit(SAMPLE).collect()
    return Grid(units(pd.Series([r.v for r in sample])), cosine, cells=-(-4 * n // (3 * TILE)))


def _join(vectors: DataFrame, dim: int, n: int, cosine: float) -> DataFrame:
    """(cls, links, root): links to other classes by their size, and stars over the linked parts of a task.

    For rows (cls, v) of ``n`` classes with vectors of length ``dim``."""
    spark = vectors.sparkSession
    grid = spark.sparkContext.broadcast(_grid(vectors, n, cosine))

    def place(frames):
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"cls": frame["cls"], "cell": grid.value.cell_of(units(frame["v"]))})

    # a cell's tiles, by its count
    counts = dict(
        vectors.mapInPandas(place, "cls long, cell long").groupBy("cell").agg(F.approx_count_distinct("cls")).collect()
    )
    tiles = np.array([max(1, -(-counts.get(c, 0) // TILE)) for c in range(grid.value.cells)])
    first, n_tiles = np.cumsum(tiles) - tiles, int(tiles.sum())

    def deal(frames):
        seen = set()
        for frame in frames:
            if not len(frame):
                continue
            # a class once per batch, and its vector once per task
            cls, at, size = np.unique(frame["cls"].to_numpy(), return_index=True, return_counts=True)
            vector = frame["v"].iloc[at]
            cell = grid.value.cell_of(units(vector))
            tile = first[cell] + (mix(cls.view(np.uint64)) % tiles[cell].astype(np.uint64)).astype(np.int64)
            new = [None if c in seen else v for c, v in zip(cls.tolist(), vector, strict=True)]
            seen.update(cls.tolist())
            yield pd.DataFrame({"tile": tile, "cls": cls, "size": size, "v": new})

    root = run_dir(spark, f"vector-tiles{dim}")
    dealt = vectors.mapInPandas(deal, f"tile long, cls long, size long, v {vectors.schema['v'].dataType.simpleString()}")
    dealt = dealt.repartition("tile").groupBy("tile", "cls").agg(
        F.sum("size").alias("size"), F.first("v", ignorenulls=True).alias("v")
    )
    dealt.write.options(**PLAIN).partitionBy("tile").parquet(root)

    def read(tile: int) -> Tile | None:
        import pyarrow.parquet as pq
        from pyarrow import fs

        disk, folder = file_system(root)
        found = disk.get_file_info(fs.FileSelector(f"{folder}/tile={tile}", allow_not_found=True))
        names = sorted(f.path for f in found if f.path.endswith(".parquet"))
        if not names:
            return None
        frames = []
        for name in names:
            with disk.open_input_file(name) as file:
                frames.append(pq.ParquetFile(file).read(use_threads=False).to_pandas())
        frame = pd.concat(frames).sort_values("cls")
        return Tile(grid.value, frame["cls"].to_numpy(), frame["size"].to_numpy(), units(frame["v"]))

    def box(frames):
        for frame in frames:
            for tile in frame["id"].tolist():
                if (held := read(tile)) is not None:
                    at = held.own @ grid.value.rotation
                    yield pd.DataFrame({"tile": [tile], "low": [at.min(0)], "high": [at.max(0)]})

    slots = max(1, spark.sparkContext.defaultParallelism)
    some = spark.range(0, n_tiles, 1, min(n_tiles, 4 * slots))
    found = stored(some.mapInPandas(box, "tile long, low array<double>, high array<double>"), f"vector-boxes{dim}")
    low, high = np.full((n_tiles, dim), np.inf), np.full((n_tiles, dim), -np.inf)
    for tile, least, most in found.collect():
        low[tile], high[tile] = least, most
    # squares of tiles; as many as keep all cores busy, and few enough vectors for a task
    side = max(1, min(SIDE, n_tiles // 24, 512 // dim))
    starts = np.arange(0, n_tiles, side)
    wide_low, wide_high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
    squares = [
        (s, t) for s in range(len(starts))
        for t in s + np.flatnonzero(grid.value.boxes_meet(wide_low[s], wide_high[s], wide_low[s:], wide_high[s:]).any(1))
    ]
    squares = np.random.default_rng(0).permutation(np.array(squares, np.int64).reshape(-1, 2))
    shared = spark.sparkContext.broadcast((low, high, squares))

    def meet(frames):
        low, high, squares = shared.value
        for frame in frames:
            for s, t in squares[frame["id"].to_numpy()].tolist():
                lefts = {i: read(i) for i in range(s * side, min((s + 1) * side, n_tiles))}
                parts = Parts()
                for j in range(t * side, min((t + 1) * side, n_tiles)):
                    right = lefts[j] if s == t else read(j)
                    if right is None:
                        continue
                    for i, left in lefts.items():
                        if left is None or i > j:
                            continue
                        [blocks] = grid.value.boxes_meet(low[i], high[i], low[j : j + 1], high[j : j + 1])
                        if blocks.any():
                            parts.add(i, j, left, right, compare(grid.value, np.flatnonzero(blocks), left, right))
                yield parts.frame()

    some = spark.range(0, len(squares), 1, max(1, min(len(squares), max(16 * slots, len(squares) // 8))))
    return some.mapInPandas(meet, "cls long, links long, root long")
