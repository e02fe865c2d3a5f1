"""Repair of conversations by the cheapest edits, the least of them by prefix-doubling ranks.

A conversation is read in order of turn (nulls first), role and text (texts that agree in 256 characters: by a hash). A row's first fault counts: blank, a duplicate of
an earlier row, or truncated. The edits are to keep a row, to give it another role, to delete it, and to insert an empty
one; the roles that remain must be an optional system row and pairs of user and assistant. What may
come next depends on four states only (nothing yet, after system, after user, after assistant).

1. Rows are dealt by ranges of (conversation, turn, role, text) and numbered there; 4,096 consecutive places
   of one conversation at most are a block, so a conversation of any length is many blocks.
2. The costs of a block, from each state before it to each behind it, are a small matrix in the (min, +) sense. Matrices of
   consecutive blocks multiply, up and down a tree, so every block learns the cheapest cost of all that follows it.
3. Each block works out the cheapest cost from every (row, state), and keeps the arcs that attain it. From a node no two
   arcs have the same letter, so the audit of an optimal path names it. Nodes are ranked by their least audits of 1, 2, 4, ...
   letters, each length by the pair (rank, rank of the node so many letters on) of the half length; the pointers double with it.
   At each node the arc with the least (letter, rank of its head) is taken, and the doubled pointers read off the path.
4. Each block's path leads from a state before it to one behind it. These maps multiply along the tree as well and give
   every block the state in which it begins, and so its edits.

Conversations of one block, nearly all, skip the tree. Nulls: a null role or text is one space; rows with a null
conv_id are one conversation; null turns come first. Rows that repeat are rows, and all but the first are duplicates.
An empty role fits nowhere and cannot be kept. Conversations without rows have no edits. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import SPACES, col, stored

#: Rows of a block and blocks that one step of the tree multiplies, as powers of two.
BLOCK_BITS, FAN_BITS = 12, 10
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant; the state that an insert or another role leads to.
NEXT = np.array([2, 2, 3, 2])
#: The state that keeping an initial (s, u, a, other) leads to, from each state; -1: it doesn't fit.
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: What it costs to end in each state.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])
FAR = 1 << 40
#: Faults, and letters in ASCII order.
NORMAL, CUT, BLANK, TWICE = range(4)
LETTERS = "DIKR"
#: Adjacent initials that are no fault, as 4 * first + second.
LEGAL = np.array([0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn; nulls become one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    tidy = rows.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), draw.alias("draw"))
    changed = tidy.where("draw <> 0").select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return changed.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


# -- order and faults ----------------------------------------------------------------------------


def _initial(role: Column) -> Column:
    """0 to 3: s, u, a, other."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def ordered(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, place, code, key): a conversation's rows in order of place.

    ``code`` is the initial and the fault that a row has by itself, ``key`` names the text. Rows that agree in
    all columns are alike; they are dealt by their place in the input, so that many of them are no single range.
    """
    strip = F.lit(SPACES.decode())
    text = F.coalesce(col("text").cast("string"), F.lit(" "))
    tidy = rows.select(
        col("conv_id").alias("conv"), col("turn").alias("turn"), F.coalesce(col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"), F.monotonically_increasing_id().alias("dealt"),
    )
    last = F.right(F.rtrim("text", strip), F.lit(1))
    fault = F.when(F.rtrim("text", strip) == "", BLANK).when(last.isin(".", "!", "?"), NORMAL).otherwise(CUT)
    # sampled ranges carry no long texts
    ranges = ["conv", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 256), F.xxhash64("text")]
    placed = (
        tidy.repartitionByRange(*ranges, "dealt").sortWithinPartitions(*ranges, "text", "dealt")
        .select(
            "conv", "turn", "role", "text", F.monotonically_increasing_id().alias("place"),
            (_initial(F.col("role")) * 4 + fault).alias("code"), F.unhex(F.sha2("text", 256)).alias("key"),
        )
    )
    return stored(placed, "turns-ordered")


def _with_duplicates(placed: DataFrame) -> DataFrame:
    """(conv, place, code) with the fault of rows whose role and text came earlier."""
    light = placed.select("conv", "role", "key", "place", "code")
    first = (
        light.groupBy("conv", "role", "key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "first")
    )
    same = [F.col("conv").eqNullSafe(F.col("c")), F.col("role") == F.col("r"), F.col("key") == F.col("k")]
    fault = F.col("code") % 4
    again = (F.col("place") > F.col("first")) & (fault != BLANK)
    code = F.when(again, F.col("code") - fault + TWICE).otherwise(F.col("code"))
    return light.join(first, same, "left").select("conv", "place", code.alias("code"))


def blocks_of(placed: DataFrame) -> DataFrame:
    """(conv, block, places, codes): at most 4,096 consecutive rows of a conversation each."""
    entry = F.struct("place", "code")
    grouped = (
        _with_duplicates(placed).groupBy("conv", F.shiftright("place", BLOCK_BITS).alias("block"))
        .agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    )
    # partition ids are in the upper bits; close them up so that the tree is low
    most = F.lit((1 << (33 - BLOCK_BITS)) - 1)
    width = grouped.agg(F.max(F.col("block").bitwiseAND(most)) + 1).first()[0] or 1
    number = F.shiftright("block", 33 - BLOCK_BITS) * F.lit(width) + F.col("block").bitwiseAND(most)
    return grouped.select(
        "conv", number.alias("block"), F.transform("rows", lambda x: x.place).alias("places"),
        F.transform("rows", lambda x: x.code.cast("byte")).alias("codes"),
    )


# -- the cost of blocks --------------------------------------------------------------------------


class Nodes:
    """The (row, state) nodes of several blocks: layer i of a block comes before its row i."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        self.codes, self.starts, self.sizes = codes.astype(np.int64), ends[:-1], np.diff(ends)
        self.layers = self.starts + np.arange(len(self.sizes))  # the first layer of each block
        self.count = 4 * int(len(codes) + len(self.sizes))

    def costs(self, behind: np.ndarray) -> np.ndarray:
        """The cheapest cost from each node, given those behind the blocks: [..., block, 4] to [..., node]."""
        out = np.empty((*behind.shape[:-2], self.count // 4, 4), np.int64)
        last = self.layers + self.sizes
        out[..., last, :] = behind
        order = np.argsort(-self.sizes, kind="stable")
        sizes = self.sizes[order]
        for step in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            at = order[: np.searchsorted(-sizes, -step, side="right")]  # blocks with so many rows
            code = self.codes[self.starts[at] + self.sizes[at] - step]
            out[..., last[at] - step, :] = _before(code, out[..., last[at] - step + 1, :])
        return out.reshape(*behind.shape[:-2], self.count)


def _row_arcs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs and states of the row arcs (D, K, R) from the four states: two arrays [row, 4, 3]."""
    initial, fault = code // 4, code % 4
    n = len(code)
    states = np.empty((n, 4, 3), np.int64)
    states[:, :, 0] = np.arange(4)
    states[:, :, 1] = KEPT[:, initial].T
    states[:, :, 2] = NEXT
    costs = np.empty((n, 4, 3), np.int64)
    stays = np.where(fault >= BLANK, FAR, np.where(fault == CUT, TRUNCATED, 0))[:, None]
    costs[:, :, 0] = DELETE
    costs[:, :, 1] = np.where(states[:, :, 1] < 0, FAR, KEEP + stays)
    costs[:, :, 2] = REROLE + stays
    return costs, np.maximum(states, 0)


def _before(code: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """The cheapest costs before a row from those behind it: inserts first, then one of the row's arcs."""
    costs, states = _row_arcs(code)
    rows = np.arange(len(code))[:, None, None]
    row = (costs + behind[..., rows, states]).min(axis=-1)
    once = INSERT + row[..., NEXT]
    return np.minimum(np.minimum(row, once), INSERT + once[..., NEXT])


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and where each list begins and ends."""
    column = batch.column(batch.schema.get_field_index(name))
    ends = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(), ends - ends[0]


def matrices(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The cost of each block from each state before it to each behind it."""
    nodes = Nodes(codes, ends)
    behind = np.where(np.eye(4, dtype=bool), 0, FAR)[:, None, :].repeat(len(nodes.sizes), axis=1)
    first = nodes.costs(behind).reshape(4, -1, 4)[:, nodes.layers, :]
    return np.minimum(first.transpose(1, 2, 0), FAR)


# -- products along the blocks of a conversation ---------------------------------------------------


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _one(n: int) -> np.ndarray:
    return np.where(np.eye(4, dtype=np.int64) == 1, 0, FAR)[None].repeat(n, axis=0)


def products_before(blocks: DataFrame) -> DataFrame:
    """(conv, block, before) from (conv, block, m): the product of the matrices of a conversation's earlier blocks.

    ``m`` holds one or more 4 x 4 matrices, flat. A step multiplies runs of up to 1,024 blocks, the next one their
    products; the way back hands the products down.
    """
    levels, now, shift = [], blocks, 0
    run = lambda c: F.floor(F.col(c) / (1 << FAN_BITS))
    while True:
        # a run has 1,024 blocks at most
        gathered = now.groupBy("conv", run("block").alias("run")).agg(F.array_sort(F.collect_list(F.struct("block", "m"))).alias("own"))
        gathered = stored(
            gathered.select("conv", "run", F.transform("own", lambda x: x.block).alias("blocks"), F.flatten(F.transform("own", lambda x: x.m)).alias("ms"))
            .mapInArrow(_multiplied, f"conv {_kind(blocks)}, run long, blocks array<long>, befores array<array<long>>, m array<long>"),
            f"turns-level-{shift}",
        )
        levels.append(gathered)
        shift += 1
        now = gathered.select("conv", F.col("run").alias("block"), "m")
        if now.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            break
    above = None
    for level in reversed(levels):
        own = level.select("conv", "run", F.explode(F.arrays_zip("blocks", "befores")).alias("x")).select(
            "conv", "run", F.col("x.blocks").alias("block"), F.col("x.befores").alias("before")
        )
        if above is not None:
            up = above.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.col("before").alias("up"))
            joined = own.join(up, F.col("conv").eqNullSafe(F.col("c")) & (F.col("run") == F.col("b")))
            own = joined.select("conv", "block", "up", "before").mapInArrow(_handed_down, f"conv {_kind(blocks)}, block long, before array<long>")
        above = own.select("conv", "block", "before")
    return above


def _kind(blocks: DataFrame) -> str:
    return blocks.schema["conv"].dataType.simpleString()


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in filter(len, batches):
        sizes = batch.column(2).value_lengths().to_numpy()
        ms, ends = _flat(batch, "ms")
        befores, wholes = [], []
        for n, start, end in zip(sizes, ends, ends[1:], strict=False):
            own = ms[start:end].reshape(n, -1, 4, 4)
            product = _one(own.shape[1])
            rows = []
            for m in own:
                rows.append(product.reshape(-1).tolist())
                product = _times(product, m)
            befores.append(rows)
            wholes.append(product.reshape(-1).tolist())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(befores, pa.list_(pa.list_(pa.int64()))), pa.array(wholes, pa.list_(pa.int64()))],
            names=["conv", "run", "blocks", "befores", "m"],
        )


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in filter(len, batches):
        (up, ends), (before, _) = _flat(batch, "up"), _flat(batch, "before")
        k = int(ends[1])
        both = _times(up.reshape(-1, k // 16, 4, 4), before.reshape(-1, k // 16, 4, 4)).reshape(-1, k)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(both) + 1) * k, pa.int32()), pa.array(both.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], lists], names=["conv", "block", "before"])


# -- the least audit -----------------------------------------------------------------------------


class Paths:
    """The least of the cheapest paths from every node, by ranks of audits of 1, 2, 4, ... letters."""

    def __init__(self, nodes: Nodes, costs: np.ndarray, final: np.ndarray):
        """``final`` tells the blocks behind which nothing follows: there may be inserts behind their rows."""
        self.nodes = nodes
        n = nodes.count
        node = np.arange(n).reshape(-1, 4)
        ends = np.zeros(n // 4, bool)
        ends[nodes.layers + nodes.sizes] = True
        layer = np.flatnonzero(~ends)
        # arcs in order of letters D, I, K, R; a head of -1 is none
        head = np.full((n, 4), -1, np.int64)
        arc, states = _row_arcs(nodes.codes)
        below = node[layer + 1]
        for letter, kind in ((0, 0), (2, 1), (3, 2)):
            to = np.take_along_axis(below, states[:, :, kind], axis=1)
            head[node[layer], letter] = np.where(arc[:, :, kind] + costs[to] == costs[node[layer]], to, -1)
        inserting = np.concatenate([layer, (nodes.layers + nodes.sizes)[final]])
        aside = node[inserting][:, NEXT]
        head[node[inserting], 1] = np.where(INSERT + costs[aside] == costs[node[inserting]], aside, -1)
        is_arc = head >= 0
        self.last = ~is_arc.any(axis=1)
        # least audits of one letter; nodes where a path ends stay where they are
        first = np.where(self.last, 0, is_arc.argmax(axis=1))
        rank = np.where(self.last, 0, first + 1)
        pointer = np.where(self.last, np.arange(n), head[np.arange(n), first])
        self.pointers, self.lengths = [pointer], [(~self.last).astype(np.int64)]
        while not self.last[pointer].all():
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
            self.lengths.append(self.lengths[-1] + self.lengths[-1][pointer])
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        # the least (letter, rank of the rest) of a node's arcs
        choice = np.where(is_arc, np.arange(4) * (int(rank.max(initial=0)) + 1) + np.where(is_arc, rank[head], 0), FAR)
        self.letter = choice.argmin(axis=1)
        self.length, self.end = self.lengths[-1], pointer

    def read(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes on the paths from some nodes, one after the other, and how many each has."""
        lengths = self.length[start]
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(start, lengths)
        for k, pointer in enumerate(self.pointers):
            at = np.where(step >> k & 1, pointer[at], at)
        return at, lengths


def _solved(batch: pa.RecordBatch) -> tuple[Nodes, np.ndarray, Paths, np.ndarray]:
    codes, ends = _flat(batch, "codes")
    behind, _ = _flat(batch, "behind")
    nodes = Nodes(codes, ends)
    costs = nodes.costs(behind.reshape(-1, 4))
    final = batch.column(batch.schema.get_field_index("final")).to_numpy(zero_copy_only=False)
    return nodes, costs, Paths(nodes, costs, final), codes


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: the state behind it by the state before it, and its last initial whatever came before, as matrices."""
    for batch in filter(len, batches):
        nodes, _, paths, codes = _solved(batch)
        out = np.full((batch.num_rows, 2, 4, 4), FAR, np.int64)
        start = 4 * nodes.layers[:, None] + np.arange(4)
        rows = np.arange(batch.num_rows)[:, None]
        out[rows, 0, np.arange(4), paths.end[start] % 4] = 0
        last = codes[nodes.starts + nodes.sizes - 1] // 4
        out[rows, 1, np.arange(4), last[:, None]] = 0
        ms = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * 32, pa.int32()), pa.array(out.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], ms], names=["conv", "block", "m"])


EDITS = "conv {}, block long, cost long, blank long, duplicate long, truncated long, illegal long, audit string, places array<long>, edits array<string>"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: faults, edits in order and the place of the row that each edits (of inserts: none)."""
    for batch in filter(len, batches):
        nodes, costs, paths, codes = _solved(batch)
        places, _ = _flat(batch, "places")
        state = batch.column(batch.schema.get_field_index("state")).to_numpy(zero_copy_only=False)
        before = batch.column(batch.schema.get_field_index("initial")).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), nodes.sizes)
        count = lambda rows: pa.array(np.bincount(owner[rows], minlength=batch.num_rows))
        fault, initial = codes % 4, codes.astype(np.int64) // 4
        earlier = np.r_[-1, initial[:-1]] if len(initial) else initial
        earlier[nodes.starts] = before
        illegal = (earlier >= 0) & ~np.isin(4 * earlier + initial, LEGAL)
        start = 4 * nodes.layers + state
        at, lengths = paths.read(start)
        letter = paths.letter[at]
        block = np.repeat(np.arange(batch.num_rows), lengths)
        row = at // 4 - block  # a block has a layer more than rows
        # another role and an insert lead to user or assistant
        to_user = NEXT[at % 4] == 2
        kinds = np.array(["D", "I-user", "I-assistant", "K", "R-user", "R-assistant"])
        kind = np.select([letter == 0, letter == 1, letter == 2], [0, np.where(to_user, 1, 2), 3], np.where(to_user, 4, 5))
        ends = np.r_[0, np.cumsum(lengths)]
        text = np.frombuffer(LETTERS.encode(), np.uint8)[letter].tobytes().decode()
        audits = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        own = pa.array(places[np.minimum(row, max(len(places) - 1, 0))], mask=letter == 1)
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2], pa.array(costs[start]), count(fault == BLANK), count(fault == TWICE), count(fault == CUT), count(illegal),
                pa.array(audits, pa.string()), pa.ListArray.from_arrays(offsets, own),
                pa.ListArray.from_arrays(offsets, pa.array(kinds[kind], pa.string())),
            ],
            names=["conv", "block", "cost", "blank", "duplicate", "truncated", "illegal", "audit", "places", "edits"],
        )


def edited_blocks(placed: DataFrame) -> DataFrame:
    """(conv, block, cost, blank, duplicate, truncated, illegal, audit, places, edits) of every block.

    ``cost`` is that of the block and all that follows it.
    """
    blocks = stored(blocks_of(placed), "turns-blocks")
    kind = _kind(blocks)
    several = blocks.groupBy("conv").agg(F.count("*").alias("n"), F.max("block").alias("to")).where("n > 1")
    several = stored(several.select(F.col("conv").alias("c"), "to"), "turns-several")
    end = F.array(*[F.lit(int(x)).cast("long") for x in AT_END])
    here = F.col("conv").eqNullSafe(F.col("c"))
    alone = blocks.join(several, here, "left_anti").select(
        "*", end.alias("behind"), F.lit(True).alias("final"), F.lit(0).cast("long").alias("state"), F.lit(-1).cast("long").alias("initial")
    )
    out = alone.mapInArrow(_edited, EDITS.format(kind))
    if several.isEmpty():
        return out
    long_ = stored(blocks.join(several, here).drop("c"), "turns-long")

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            m = matrices(*_flat(batch, "codes")).transpose(0, 2, 1).reshape(-1)
            ms = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * 16, pa.int32()), pa.array(np.ascontiguousarray(m)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], ms], names=["conv", "block", "m"])

    # what follows a block: products of transposed matrices, numbered from the end
    top = F.lit(several.agg(F.max("to")).first()[0])
    turned = long_.select("conv", (top - F.col("block")).alias("block"), "codes").mapInArrow(costs, f"conv {kind}, block long, m array<long>")
    after = products_before(turned).select(F.col("conv").alias("c"), (top - F.col("block")).alias("b"), F.col("before").alias("after"))
    # after[e][s] is the cost from state s behind the block to state e at the end
    behind = F.array(*[F.array_min(F.array(*[F.get("after", F.lit(4 * e + s)) + int(AT_END[e]) for e in range(4)])) for s in range(4)])
    same = here & (F.col("block") == F.col("b"))
    known = stored(
        long_.join(after, same).select("conv", "block", "places", "codes", behind.alias("behind"), (F.col("block") == F.col("to")).alias("final")),
        "turns-behind",
    )
    maps = known.select("conv", "block", "codes", "behind", "final").mapInArrow(_maps, f"conv {kind}, block long, m array<long>")
    before = products_before(maps).select(F.col("conv").alias("c"), F.col("block").alias("b"), "before")
    zero_at = lambda start: F.array_position(F.slice("before", start + 1, 4), F.lit(0).cast("long")) - 1
    # the last initial doesn't depend on the state, but before the first block, where the matrix is the identity
    is_first = (F.get("before", F.lit(16)) == 0) & (F.get("before", F.lit(16 + 5)) == 0)
    joined = known.join(before, same).select(
        "conv", "block", "places", "codes", "behind", "final", zero_at(0).cast("long").alias("state"),
        F.when(is_first, -1).otherwise(zero_at(16)).cast("long").alias("initial"),
    )
    return out.unionByName(joined.mapInArrow(_edited, EDITS.format(kind)))


# -- results -------------------------------------------------------------------------------------


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of conversations (conv_id, turn, role, text), and the repaired rows.

    First: (conv, block, cost, blank, duplicate, truncated, illegal, audit) for every block of a conversation, in order
    of block. Second: (conv, block, step, edit, role, text), the rows that remain, in order of block and step; an
    inserted row has an empty text.
    """
    placed = ordered(rows)
    edits = stored(edited_blocks(placed), "turns-edits")
    return edits.drop("places", "edits"), repaired_rows(placed, edits)


def repaired_rows(placed: DataFrame, edits: DataFrame) -> DataFrame:
    steps = edits.select("conv", "block", F.posexplode(F.arrays_zip("places", "edits")).alias("step", "x")).select(
        "conv", "block", "step", F.col("x.places").alias("at"), F.col("x.edits").alias("edit")
    )
    steps = steps.where("edit <> 'D'")
    role = F.when(F.col("edit").endswith("-user"), "user").when(F.col("edit").endswith("-assistant"), "assistant")
    own = placed.select(F.col("place").alias("p"), F.col("role").alias("own_role"), "text")
    kept = steps.where(F.col("at").isNotNull()).join(own, F.col("at") == F.col("p"))
    columns = ["conv", "block", "step", F.substring("edit", 1, 1).alias("edit")]
    return kept.select(*columns, F.coalesce(role, "own_role").alias("role"), "text").unionAll(
        steps.where(F.col("at").isNull()).select(*columns, role.alias("role"), F.lit("").alias("text"))
    )


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired rows as ``role:text`` lines. A hash is taken in order, so one task reads a
    conversation; it holds a batch of rows at a time."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, started, done = None, hashlib.sha256(), False, []
        for batch in batches:
            ids, lines = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for own, line in zip(ids, lines, strict=True):
                if started and own == conv:
                    held.update(b"\n" + line)
                    continue
                if started:
                    done.append((conv, held.hexdigest()))
                conv, held, started = own, hashlib.sha256(line), True
            if done:
                yield _named(done, batch)
                done = []
        if started:
            yield _named([(conv, held.hexdigest())], batch)

    def _named(done: list, batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], batch.schema.field(0).type), pa.array([h for _, h in done], pa.string())], names=["conv", "sha256"]
        )

    lines = rows.repartition("conv").sortWithinPartitions("conv", "block", "step").select("conv", F.concat("role", F.lit(":"), "text"))
    return lines.mapInArrow(run, f"conv {_kind(rows)}, sha256 string")


def repaired(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row for each conversation of ``original``: the faults of its damaged rows, the edits and the repaired text's hash."""
    placed = ordered(damaged)
    edits = stored(edited_blocks(placed), "turns-edits")
    total = lambda c: F.sum(c).alias(c)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x.audit), "")
    faults = edits.groupBy("conv").agg(
        total("blank"), total("duplicate"), total("truncated"), total("illegal"), F.min_by("cost", "block").alias("cost"), audit.alias("audit")
    )
    turns = placed.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    hashes = digests(repaired_rows(placed, edits))
    out = original.select(col("conv_id").alias("conv_id")).distinct()
    for part in (turns, faults, hashes):
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
