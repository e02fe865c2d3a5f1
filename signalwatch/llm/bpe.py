"""Byte-pair encoding as a streaming transducer, and decoding as a byte-to-text state machine.

A merge list has a *sufficient lookahead*: how far left of the end of a prefix the merges of the
prefix and of the whole word can differ. Compare the two, merge rule by merge rule. They agree left of
a frontier, which starts at the end of the prefix. Rule (u, v) moves the frontier left by u only if u ends
at it and v begins there in one of the two. A later rule (u2, v2) moves it again only if u is on the left
edge of v2's derivation and was not merged there before the first rule had its turn. Chains of such
rules have rising rank, so the longest total shift follows from one pass over the merge list. Tokens of
the prefix that end at or before its end less that lookahead are final. The transducer keeps a window of fixed
length, emits the final tokens and goes on behind them, so the memory for a word of any length is constant.

This holds for lists in which a token is made by one rule only and its parts' rules come first; other
lists are refused. Normalisation and splitting into words are the tokenizer's own, so Unicode versions agree.

Words that fit in the window are complete before anything must be emitted; those of a slice of texts are merged
together by array operations. Longer ones go through the window symbol by symbol. Null texts count as empty;
an empty text has no ids. Every row gives one row, repeated rows and ids included.
"""

from __future__ import annotations

import codecs
import json
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType

from signalwatch.llm.common import col, fresh, mix, seeds, slices

NO_RANK = np.int32(2**31 - 1)
#: Bytes of text that are encoded at once.
SLICE = 1 << 20
#: UTF-8 of white space beyond ASCII.
FAR_SPACE = re.compile(
    b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
LETTER, DIGIT, SPACE, OTHER, FOREIGN = range(5)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]]) -> int:
    """The sufficient lookahead of a merge list, in symbols of its tokens."""
    made: dict[str, tuple[int, str]] = {}  # token -> rank of its rule, left part
    used: set[str] = set()
    for rank, (u, v) in enumerate(merges):
        used |= {u, v}
        if u + v in made or u + v in used:
            raise ValueError(f"merge {rank} makes a token anew or behind a rule that needs it")
        made[u + v] = (rank, u)
    # per left part: ranks of its rules, and the largest shift up to each
    ranks: dict[str, list[int]] = {}
    shifts: dict[str, list[int]] = {}
    longest = 0
    for rank, (u, v) in enumerate(merges):
        before, edge, until = 0, v, rank
        while True:  # edge is on the left edge of v and is merged there by rule `until`
            if edge in ranks and (k := bisect_right(ranks[edge], until if until < rank else rank - 1)):
                before = max(before, shifts[edge][k - 1])
            if edge not in made:
                break
            until, edge = made[edge]
        shift = len(u) + before
        ranks.setdefault(u, []).append(rank)
        own = shifts.setdefault(u, [])
        own.append(max(shift, own[-1] if own else 0))
        longest = max(longest, shift)
    return longest


class Transducer:
    """Ids of words by a tokenizer file's merge list, in constant memory per word."""

    def __init__(self, model: dict, window: int | None = None):
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("a plain BPE model is needed")
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.lookahead = lookahead(merges)
        self.longest = max(map(len, self.vocab))
        self.window = max(window or 0, self.lookahead + 2 * self.longest)

    def _merge(self, parts: list[str]) -> list[str]:
        """All merges of the symbols: the lowest rank first, from the left."""
        ranks = self.ranks
        while len(parts) > 1:
            best = min(ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:], strict=False))
            if best == 1 << 60:
                break
            out, i, n = [], 0, len(parts)
            while i < n:
                if i + 1 < n and ranks.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def tokens(self, word: Iterable[str]) -> Iterator[str]:
        """Tokens of one word, given symbol by symbol, each emitted as soon as it is stable."""
        held: list[str] = []
        source, size = iter(word), self.window
        last = next(source, None)
        while last is not None:
            following = next(source, None)
            held.append(last if following is not None else last + self.end)
            last = following
            if last is not None and len(held) >= size:
                tokens, at = self._merge(held), 0
                length = sum(map(len, held))
                for token in tokens:
                    if at + len(token) > length - self.lookahead:
                        break
                    yield token
                    at += len(token)
                held = held[at:]
                size = len(held) + self.longest + 1 if not at else self.window
        yield from self._merge(held)

    def ids(self, word: str) -> list[int]:
        vocab = self.vocab
        return [vocab[t] for t in self.tokens(word) if t in vocab]


class PairTable:
    """Rank and result of a pair of token ids: an open hash table in arrays."""

    SIZE = 1 << 20

    def __init__(self, ranks: dict[tuple[str, str], int], vocab: dict[str, int]):
        if len(ranks) > self.SIZE // 4:
            raise ValueError("too many merges for the table")
        self.keys = np.full(self.SIZE, -1, np.int64)
        self.ranks = np.full(self.SIZE, NO_RANK, np.int32)
        self.made = np.zeros(self.SIZE, np.int32)
        for (u, v), rank in ranks.items():
            key = vocab[u] << 32 | vocab[v]
            at = int(self._place(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) % self.SIZE
            self.keys[at], self.ranks[at], self.made[at] = key, rank, vocab[u + v]

    def _place(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(44)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair, or of an empty cell."""
        key = left.astype(np.int64) << 32 | right
        at = self._place(key)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % self.SIZE
            open_ = open_[(self.keys[at[open_]] != key[open_]) & (self.keys[at[open_]] >= 0)]
        return at


class Encoder:
    """Texts to ids as the tokenizers library gives them for a file, without added special tokens.

    A slice of texts is split by array operations; each distinct word of the slice is merged once. Pieces
    between white space with characters beyond Latin letters, and texts with special tokens, are split by
    the library itself. Words are told apart by a 64-bit hash and their length within a slice.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.file = load(path)
        self.split = Tokenizer.from_file(path)
        self.transducer = own = transducer(path)
        self.pairs = PairTable(own.ranks, own.vocab)
        symbols = byte_symbols()
        self.inner = np.array([own.vocab.get(s, -1) for s in symbols], np.int32)
        self.final = np.array([own.vocab.get(s + own.end, -1) for s in symbols], np.int32)
        if min(self.inner.min(), self.final.min()) < 0:
            raise ValueError("a byte-level vocabulary is needed")
        self.bytes_of = {s: bytes([b]) for b, s in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in self.file["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, self.special)).encode()) if self.special else None
        #: one kind drops white space and takes digits one by one, the other joins a space to the word behind
        names = json.dumps([self.file["normalizer"], self.file["pre_tokenizer"]])
        self.drops, self.lowers = '"Removed"' in names, '"Lowercase"' in names

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids end, with 0 in front. Null texts are empty."""
        texts = texts.fill_null("").cast(pa.large_binary())
        first = texts.offset
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[first : first + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        ends = offsets[1:] - offsets[0]
        data = raw.tobytes()
        apart = {}  # texts that are split as a whole by the library
        hits = [m.start() for m in self.specials.finditer(data)] if self.specials else []
        if not self.drops:
            hits += [m.start() for m in FAR_SPACE.finditer(data)]
        for i in np.unique(np.searchsorted(ends, hits, side="right")):
            apart[int(i)] = self._apart(data[ends[i - 1] if i else 0 : ends[i]])
        if apart:
            lengths = np.diff(ends, prepend=0)
            keep = np.ones(len(ends), bool)
            keep[list(apart)] = False
            raw = raw[np.repeat(keep, lengths)]
            ends = np.cumsum(np.where(keep, lengths, 0))
        ids, word_ends, counts = self._words_of(raw, ends)
        out_ends = np.concatenate([[0], np.cumsum(np.bincount(word_ends, counts, len(ends)).astype(np.int64))])
        if apart:
            pieces, sizes, at = [], np.diff(out_ends), 0
            for i in sorted(apart):
                pieces += [ids[at : out_ends[i]], apart[i]]
                at, sizes[i] = out_ends[i], len(apart[i])
            ids = np.concatenate([*pieces, ids[at:]])
            out_ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, out_ends

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.string()))[0].tolist()

    def _apart(self, raw: bytes) -> np.ndarray:
        out, text, at = [], raw.decode(), 0
        for match in re.finditer("|".join(map(re.escape, self.special)) or "(?!)", text):
            out += [*self._piece(text[at : match.start()]), self.special[match[0]]]
            at = match.end()
        return np.array(out + self._piece(text[at:]), np.uint32)

    def _piece(self, text: str) -> list[int]:
        """Ids of a text without special tokens, split by the library."""
        text = self.split.normalizer.normalize_str(text) if self.split.normalizer else text
        words = [w for w, _ in self.split.pre_tokenizer.pre_tokenize_str(text)]
        known = {w: self.transducer.ids(w) for w in set(words)}
        return [i for w in words for i in known[w]]

    def _starts(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where words begin and whether a word has foreign characters; the bytes as the words have them."""
        kind = KINDS[raw]
        lead = np.flatnonzero(raw == 0xC3)
        if len(lead):
            after = raw[np.minimum(lead + 1, len(raw) - 1)]
            lead = lead[(after != 0x97) & (after != 0xB7)]
            kind[lead] = kind[lead + 1] = LETTER
        if self.lowers:
            raw = LOWERED[raw]
            if len(lead):
                after = raw[lead + 1]
                raw[lead + 1] = np.where(after < 0x9F, after + 0x20, after)
        edge = np.zeros(len(raw) + 1, bool)  # a text begins here
        edge[0] = edge[ends] = True
        start = edge[:-1].copy()
        space = kind == SPACE
        gap = space[1:] != space[:-1]
        unit = start.copy()
        unit[1:] |= gap
        changed = kind[1:] != kind[:-1]
        start[1:] |= changed
        if self.drops:
            start |= kind == DIGIT
        marks = np.flatnonzero((raw == 0x27) & start)
        if not self.drops and len(marks):  # a space in front takes the mark to itself
            joined = (marks > 0) & ~edge[marks] & (raw[marks - 1] == 0x20)
            marks = marks[~joined]
        for m in marks.tolist():
            rest = raw[m + 1 : m + 3].tobytes()
            size = 1 if rest[:1] in (b"s", b"t", b"m", b"d") else 2 if rest in (b"re", b"ve", b"ll") else 0
            if size and not edge[m + 1] and not (size == 2 and edge[m + 2]):
                start[m + 1] = False
                if size == 2:
                    start[m + 2] = False
                if m + 1 + size < len(raw):
                    start[m + 1 + size] = True
        foreign = np.zeros(len(raw), bool)
        strange = np.flatnonzero(kind == FOREIGN)
        if len(strange):
            units = np.flatnonzero(unit)
            hit = np.unique(np.searchsorted(units, strange, side="right") - 1)
            stops = np.append(units[1:], len(raw))
            for u in hit.tolist():
                start[units[u] + 1 : stops[u]] = False
            foreign[units[hit]] = True
        if not self.drops:  # the last space before a word is the word's, other white space stands alone
            begins = np.flatnonzero(gap & ~space[1:]) + 1
            begins = begins[~edge[begins]]
            start[begins - 1] = True
            joins = begins[raw[begins - 1] == 0x20]
            start[joins] = False
            foreign[joins - 1] = foreign[joins]
        at = np.flatnonzero(start)
        return at, foreign[at], space[at], raw

    def _words_of(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and per word its text's number and its count of ids."""
        none = np.zeros(0, np.int64)
        if not len(raw):
            return np.zeros(0, np.uint32), none, none
        at, foreign, space, own = self._starts(raw, ends)
        sizes = np.diff(np.append(at, len(raw)))
        if self.drops:
            keep = ~space
            at, foreign, sizes = at[keep], foreign[keep], sizes[keep]
        with np.errstate(over="ignore"):
            if len(POWERS[0]) < len(raw):
                POWERS[0], POWERS[1] = _powers(len(raw) + (1 << 18)), _powers(len(raw) + (1 << 18), True)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(SALTS[own] * POWERS[0][: len(raw)])])
            key = mix((sums[at + sizes] - sums[at]) * POWERS[1][at] + sizes.astype(np.uint64) * STEP)
        _, chosen, which = np.unique(key, return_index=True, return_inverse=True)
        ids, counts = self._distinct(raw, own, at[chosen], sizes[chosen], foreign[chosen])
        first = np.cumsum(counts) - counts
        n = counts[which]
        whole = np.repeat(first[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return ids[whole], np.searchsorted(ends, at, side="right"), n

    def _distinct(self, raw, own, at, sizes, foreign) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places, one after the other, and how many each has."""
        odd = foreign | (sizes >= self.transducer.window)
        plain = np.flatnonzero(~odd)
        n = sizes[plain]
        where = np.repeat(at[plain] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        ids, word = self._merge_all(own[where], n)
        counts = np.zeros(len(at), np.int64)
        counts[plain] = np.bincount(word, minlength=len(plain))
        if not odd.any():
            return ids, counts
        more, order = [ids], [plain[word]]
        symbols = byte_symbols()
        for i in np.flatnonzero(odd).tolist():
            span = slice(at[i], at[i] + sizes[i])
            if foreign[i]:
                made = self._piece(raw[span].tobytes().decode())
            else:  # symbol by symbol through the window
                tokens = self.transducer.tokens(symbols[b] for b in own[span].tolist())
                made = [self.transducer.vocab[t] for t in tokens]
            counts[i] = len(made)
            more.append(np.array(made, np.uint32))
            order.append(np.full(len(made), i))
        return np.concatenate(more)[np.argsort(np.concatenate(order), kind="stable")], counts

    def _merge_all(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words within the window, and each id's word: every round merges each word's lowest pair."""
        ids = self.inner[raw]
        last = np.cumsum(sizes) - 1
        ids[last] = self.final[raw[last]]
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        done_ids, done_words = [ids[:0]], [word[:0]]
        while len(ids):
            inside = word[:-1] == word[1:]
            at = np.zeros(len(ids), np.int64)
            some = np.flatnonzero(inside)
            at[some] = self.pairs.find(ids[some], ids[some + 1])
            rank = np.full(len(ids), NO_RANK)
            rank[some] = self.pairs.ranks[at[some]]
            starts = np.flatnonzero(np.append(True, ~inside))
            lengths = np.diff(np.append(starts, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            going = least != NO_RANK
            done_ids.append(ids[~going])
            done_words.append(word[~going])
            merge = going & (rank == least)
            follows = merge & np.append(False, merge[:-1])
            if follows.any():  # runs of one pair, as in "aaa": every other one from the left
                index = np.arange(len(ids))
                run = np.maximum.accumulate(np.where(merge & ~follows, index, 0))
                merge &= (index - run) % 2 == 0
            where = np.flatnonzero(merge)
            ids[where] = self.pairs.made[at[where]]
            going[where + 1] = False
            ids, word = ids[going], word[going]
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return ids[order].astype(np.uint32), word[order]


def _kinds() -> np.ndarray:
    kinds = np.full(256, FOREIGN, np.uint8)
    kinds[:128] = OTHER
    kinds[[9, 10, 11, 12, 13, 32]] = SPACE
    kinds[48:58] = DIGIT
    kinds[65:91] = kinds[97:123] = LETTER
    return kinds


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    base = pow(int(BASE), -1, 1 << 64) if inverse else int(BASE)
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out)


KINDS = _kinds()
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
SALTS = seeds(256)
BASE, STEP = seeds(2, 1000) | np.uint64(1)
POWERS = [_powers(1 << 16), _powers(1 << 16, True)]


class Decoder:
    """Ids to text. Bytes go through a UTF-8 state machine; complete characters leave it at once."""

    def __init__(self, path: str):
        file = load(path)
        kind = (file["decoder"] or {"type": None})["type"]
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"no decoder of type {kind} here")
        self.joint = " " if kind is None else ""
        symbols = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["id"]: t["content"] for t in file["added_tokens"]}
        tokens = {i: t for t, i in file["model"]["vocab"].items()} | special
        self.texts: dict[int, str] = {}
        self.parts: dict[int, bytes] = {}
        for i, token in tokens.items():
            if kind is None:
                self.texts[i] = token
                continue
            whole = all(c in symbols for c in token)
            raw = bytes(symbols[c] for c in token) if whole else token.encode()
            self.parts[i] = raw
            try:
                self.texts[i] = raw.decode()
            except UnicodeDecodeError:
                pass

    def pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """The text in pieces, as the bytes of its characters become complete."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        inside, texts, parts = False, self.texts, self.parts
        for i in ids:
            if not inside and i in texts:
                yield texts[i]
            elif i in parts:
                yield state.decode(parts[i])
                inside = bool(state.getstate()[0])
        if inside:
            yield state.decode(b"", True)

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        try:
            return self.joint.join(map(self.texts.__getitem__, ids))
        except KeyError:
            return self.joint.join(self.pieces(ids))


@cache
def load(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@cache
def transducer(path: str) -> Transducer:
    return Transducer(load(path)["model"])


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


@cache
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _encoded(path: str, at: int):
    """For batches with a text at ``at``, the columns before it and the ids."""

    def run(batches):
        own = encoder(path)
        for whole in batches:
            for batch in slices(whole, at, SLICE):
                ids, ends = own.encode_all(batch.column(at))
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], made], names=[*batch.schema.names[:at], "ids"])

    return run


def _decoded(path: str, at: int, keep_ids: bool):
    """For batches with ids at ``at``, the columns before it, the ids if wanted, and the text."""

    def run(batches):
        own, last = decoder(path), at + keep_ids
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = [own.decode(i or ()) for i in batch.column(at).to_pylist()]
                columns = [*batch.columns[:last], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:last], "decoded"])

    return run


def _prepared(rows: DataFrame, value: str, keep: list[str] | None, *outs: str) -> tuple[DataFrame, StructType, list[str]]:
    """Columns to keep and the value behind them; the kept columns' schema; names of the new columns."""
    keep = rows.columns if keep is None else keep
    rows = rows.select(*map(col, keep), col(value).alias(fresh(rows, "value_in")[0]))
    kept = StructType(rows.schema.fields[:-1])
    return rows, kept, fresh(rows.select(*map(col, keep)), *outs)


def _named(run, schema: StructType):
    """The batches with the schema's names."""
    names = schema.names
    return lambda batches: (pa.RecordBatch.from_arrays(b.columns, names=names) for b in run(batches))


def with_ids(docs: DataFrame, path: str, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The rows with the text's ids, an array of integers, in a further column.

    ``path`` names the tokenizer file on every executor; ``keep`` the columns to return, all if not given.
    A clash of ``out`` with a column lengthens it.
    """
    rows, schema, [name] = _prepared(docs, text, keep, out)
    run = _encoded(path, len(schema))
    schema = schema.add(name, ArrayType(IntegerType()))
    return rows.mapInArrow(_named(run, schema), schema)


def with_text(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """The rows with the ids' text in a further column; null ids give an empty text."""
    rows, schema, [name] = _prepared(rows, ids, keep, out)
    run = _decoded(path, len(schema), False)
    schema = schema.add(name, "string")
    return rows.mapInArrow(_named(run, schema), schema)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with ``ids`` and the text ``decoded`` from these, in one pass of one worker per task."""
    rows, schema, names = _prepared(docs, text, keep, "ids", "decoded")
    at = len(schema)
    encode, decode = _encoded(path, at), _decoded(path, at, True)
    schema = schema.add(names[0], ArrayType(IntegerType())).add(names[1], "string")
    return rows.mapInArrow(_named(lambda batches: decode(encode(batches)), schema), schema)
