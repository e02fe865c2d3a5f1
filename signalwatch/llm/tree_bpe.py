"""Byte-level byte-pair encoding as a reduction of a text's halves, and decoding up the same tree.

Encodings of neighbouring pieces form a monoid: ``join`` makes the encoding of the whole from those of its parts
by encoding anew only a window around their border, grown until the tokens outside it are proven to stay.

*Within a match of the pattern* tokens are stable by pairs: a row of tokens is the encoding of its bytes exactly
if each two neighbours are the encoding of their own bytes. (Take the first merge in the whole that crosses a border
between two tokens. Until then the merges in these two were the least ranks, from the left, of the whole, so
of the two alone; the two alone would make that merge as well.) So the last tokens of the left part and the first
of the right are encoded together, and the window doubles on each side whose border with the rest isn't such a pair.

*Between matches*, where a match of the pattern begins decides all that follows it. A match looks at most two
characters beyond its end, so the matches of the left part that end earlier stay; the pattern goes on behind them
until it stops where a match of the right part stops, and the rest of the right part stays.

A leaf of a text is some thousand characters, a leaf of a match some dozen bytes. A long text costs the tree's depth of copies
of its ids, and memory in proportion to the text. Null texts count as empty; an empty text has no ids.
Every row gives one row, repeated rows included; other columns stay, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from signalwatch.llm.common import col, fresh, slices

#: Characters of a text's leaf, bytes of a match's leaf, bytes of a window that is merged part by part.
LEAF, WORD_LEAF, SMALL = 4096, 8, 192
#: Characters beyond its end that a match may have looked at, in patterns like the tokenizers' own.
LOOK = 2
#: Bytes of text that are encoded at once, matches remembered, and their greatest length.
SLICE, REMEMBERED, SHORT = 1 << 20, 1 << 19, 64
#: The rank of two parts that make no token.
NONE = 1 << 60


class Encoder:
    """Ids of texts by the ranks of a vocabulary file, each match of the pattern by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, word_leaf: int = WORD_LEAF):
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.leaf, self.word_leaf = max(leaf, 1), max(word_leaf, 1)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.stable: dict[tuple[int, int], bool] = {}
        self.known, self.merged = _Known(self), {}
        self.joins = 0

    # -- within a match --------------------------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """All merges of a leaf or window; those of some bytes are remembered, as they come again in other words."""
        if len(word) > 16:
            return self._merge_listed(word) if len(word) <= SMALL else self._merge_queued(word)
        ids = self.merged.get(word)
        if ids is None:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            ids = self.merged[word] = self._merge_listed(word)
        return ids

    def _merge_listed(self, word: bytes) -> list[int]:
        """The lowest rank first, from the left."""
        rank = self.ranks.get
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [rank(word[i : i + 2], NONE) for i in range(len(word) - 1)]
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], NONE)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], NONE)
        return [self.ranks[part] for part in parts]

    def _merge_queued(self, word: bytes) -> list[int]:
        """The same for a window that has grown long: pairs wait in a queue by rank and place."""
        n, rank = len(word), self.ranks.get
        ends, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that begins at a place
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapify(queue)
        while queue:
            _, i, end = heappop(queue)
            middle = ends[i]
            if middle is None or middle >= n or ends[middle] != end:
                continue  # one of the two has been merged otherwise
            ends[i], ends[middle] = end, None
            if end < n:
                before[end] = i
                if (r := rank(word[i : ends[end]])) is not None:
                    heappush(queue, (r, i, ends[end]))
            if i and (r := rank(word[before[i] : end])) is not None:
                heappush(queue, (r, before[i], end))
        return [self.ranks[word[i:end]] for i, end in enumerate(ends) if end is not None]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) > 1 << 18:
                self.stable.clear()
            known = self.stable[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join_words(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring stretches of a match from theirs."""
        if not left or not right or self.neighbours(left[-1], right[0]):
            return left + right
        self.joins += 1
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            span = b"".join(map(self.bytes_of.__getitem__, left[len(left) - a :] + right[:b]))
            window = self.merge(span)
            grow_left = a < len(left) and not self.neighbours(left[-a - 1], window[0])
            grow_right = b < len(right) and not self.neighbours(window[-1], right[b])
            if not (grow_left or grow_right):
                return left[: len(left) - a] + window + right[b:]
            a, b = a * (2 if grow_left else 1), b * (2 if grow_right else 1)

    def _halves(self, word: bytes) -> list[int]:
        if len(word) <= self.word_leaf:
            return self.merge(word)
        cut = len(word) // 2
        return self.join_words(self._halves(word[:cut]), self._halves(word[cut:]))

    def word(self, match: str) -> tuple[int, ...]:
        """The ids of one match; a match that is itself a token is that token."""
        word = match.encode()
        whole = self.ranks.get(word)
        return (whole,) if whole is not None else tuple(self._halves(word))

    # -- between matches -------------------------------------------------------------------------

    def _leaf(self, text: str, start: int, end: int) -> Segment:
        matches = self.pattern.findall(text, start, end)
        ends = start + np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        if (ends[-1] if len(ends) else start) != end:  # the pattern leaves characters out
            found = list(self.pattern.finditer(text, start, end))
            matches, ends = [m[0] for m in found], np.array([m.end() for m in found], np.int64)
        return self._segment(matches, ends)

    def _segment(self, matches: list[str], ends: np.ndarray) -> Segment:
        parts = list(map(self.known.__getitem__, matches))
        return self._of_parts(parts, ends)

    @staticmethod
    def _of_parts(parts: list, ends: np.ndarray) -> Segment:
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.fromiter(chain.from_iterable(parts), np.int32, int(counts.sum()))
        return Segment(ids, ends, np.cumsum(counts))

    def join(self, text: str, start: int, cut: int, end: int, left: Segment, right: Segment) -> Segment:
        """The encoding of text[start:end] from those of its parts on either side of ``cut``."""
        safe = int(np.searchsorted(left.ends, cut - LOOK, side="left"))  # matches that saw nothing of the cut
        at = int(left.ends[safe - 1]) if safe else start
        matches, ends, parts = [], [], []
        skip = 0  # matches of the right part that are done anew
        while at < end:
            if at >= cut:
                if at == cut:
                    break
                skip = int(np.searchsorted(right.ends, at, side="left"))
                if skip < len(right.ends) and right.ends[skip] == at:
                    skip += 1
                    break
            match = self.pattern.search(text, at, end)
            if match is None:
                skip = len(right.ends)
                break
            at = match.end()
            matches.append(match)
            ends.append(at)
        else:
            skip = len(right.ends)
        for match in matches:
            parts.append(self._spanning(match, start, cut, left, right))
        window = self._of_parts(parts, np.array(ends, np.int64))
        return left.head(safe) + window + right.tail(skip)

    def _spanning(self, match, start: int, cut: int, left: Segment, right: Segment) -> list[int] | tuple[int, ...]:
        """The ids of a match; one that both parts end and begin with is joined from theirs."""
        p, q = match.span()
        if q - p <= self.word_leaf or not p < cut < q:
            return self.known[match[0]]
        whole = self.ranks.get(match[0].encode())
        n = len(left.ends)
        begins = int(left.ends[n - 2]) if n > 1 else start
        if whole is None and n and begins == p and left.ends[-1] == cut and len(right.ends) and right.ends[0] == q:
            return self.join_words(self._own(left, n - 1, p, cut, match[0][: cut - p]), self._own(right, 0, cut, q, match[0][cut - p :]))
        return self.known[match[0]]

    def _own(self, part: Segment, i: int, p: int, q: int, piece: str) -> list[int]:
        ids = part.of(i)
        # a match that was a token by itself may not be what merges give
        if len(ids) == 1 and q - p > 1:
            return self._halves(piece.encode())
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text, by halves."""
        return self._tree(text, 0, len(text)).ids if text else np.zeros(0, np.int32)

    def _tree(self, text: str, start: int, end: int) -> Segment:
        if end - start <= self.leaf:
            return self._leaf(text, start, end)
        cut = (start + end) // 2
        return self.join(text, start, cut, end, self._tree(text, start, cut), self._tree(text, cut, end))

    # -- decoding --------------------------------------------------------------------------------

    def decode(self, ids) -> bytes:
        """The bytes of ids, concatenated up a tree."""
        if len(ids) > self.leaf:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids))


class Segment:
    """The encoding of a stretch of text: its ids, where its matches end, and how many ids there are up to each."""

    __slots__ = ("counts", "ends", "ids")

    def __init__(self, ids: np.ndarray, ends: np.ndarray, counts: np.ndarray):
        self.ids, self.ends, self.counts = ids, ends, counts

    def head(self, n: int) -> Segment:
        return Segment(self.ids[: self.counts[n - 1] if n else 0], self.ends[:n], self.counts[:n])

    def tail(self, n: int) -> Segment:
        gone = int(self.counts[n - 1]) if n else 0
        return Segment(self.ids[gone:], self.ends[n:], self.counts[n:] - gone)

    def of(self, i: int) -> list[int]:
        return self.ids[self.counts[i - 1] if i else 0 : self.counts[i]].tolist()

    def __add__(self, other: Segment) -> Segment:
        join = np.concatenate
        return Segment(join([self.ids, other.ids]), join([self.ends, other.ends]), join([self.counts, len(self.ids) + other.counts]))


class _Known(dict):
    """Ids of short matches seen, up to a number of them."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = self.encoder.word(match)
        if len(match) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[match] = ids
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file: a token in base 64 and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def with_ids(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The rows with their texts' ids in a further, last column. Every worker has the file at ``path``."""
    keep = docs.columns if keep is None else keep
    [inner] = fresh(docs, "text_in")
    docs = docs.select(*map(col, keep), col(text).alias(inner))
    [name] = fresh(docs, out)
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for whole in batches:
            for batch in slices(whole, at, SLICE):
                ids = [known.encode(text.as_py()) for text in batch.column(at)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], _lists(ids)], names=[*keep, name])

    return docs.mapInArrow(run, StructType(docs.schema.fields[:at]).add(name, ArrayType(IntegerType())))


def with_bytes(rows: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """The rows with the bytes that their ids stand for in a further, last column; null ids are no ids."""
    keep = rows.columns if keep is None else keep
    [inner] = fresh(rows, "ids_in")
    rows = rows.select(*map(col, keep), col(ids).alias(inner))
    [name] = fresh(rows, out)
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for batch in batches:
            decoded = pa.array([known.decode(x.values.to_numpy() if x.is_valid else []) for x in batch.column(at)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], decoded], names=[*keep, name])

    return rows.mapInArrow(run, StructType(rows.schema.fields[:at]).add(name, BinaryType()))


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``ids`` and ``decoded``, encoded and decoded by the same worker: ids don't travel twice."""
    keep = docs.columns if keep is None else keep
    [inner] = fresh(docs, "text_in")
    docs = docs.select(*map(col, keep), col(text).alias(inner))
    ids_name, out_name = fresh(docs, "ids", "decoded")
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for whole in batches:
            for batch in slices(whole, at, SLICE):
                ids = [known.encode(text.as_py()) for text in batch.column(at)]
                decoded = pa.array([known.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], _lists(ids), decoded], names=[*keep, ids_name, out_name])

    schema = StructType(docs.schema.fields[:at]).add(ids_name, ArrayType(IntegerType())).add(out_name, BinaryType())
    return docs.mapInArrow(run, schema)
