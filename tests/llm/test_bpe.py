import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from signalwatch.llm import bpe

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "", None, "  ", "a<|endoftext|>b  <|endoftext|>c \n<|endoftext|>", "x  y\n\nz \t\x1c\x1d q　r  s",
    "ΑΣ ΟΔΟΣ İstanbul é ́a ﬁ", "a" * 5000, "aaa aaaa aaaaa", "ab" * 3000 + " " * 50,
    "'S it's'LL don't 12345 ٣٤ 'tis ''s !'s x 's they're I'vey 'l 'r", "😀👍🏽 日本語テキスト", "\x00�​",
    "Hello, world!! ok... (x) A.B", "it'", "'", "'s", "'r", "e", "×÷ ÀÉß “quoted” — dash",
]


@pytest.mark.parametrize("file", FILES)
def test_same_as_the_library(file):
    path, draw = P.path(file), random.Random(3)
    long = ["".join(draw.choice("abcdefgh0123+/") for _ in range(6000)), "the" * 2000]
    mixed = ["".join(draw.choice("  \n\t'strevmld.!A9éÉ×“日") for _ in range(draw.randint(0, 12))) for _ in range(1500)]
    texts = [*ODD, *long, *mixed]
    own, library, back = bpe.encoder(path), Tokenizer.from_file(path), bpe.decoder(path)
    ids, ends = own.encode_all(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        got = ids[ends[i] : ends[i + 1]].tolist()
        assert got == want, text
        assert back.decode(got) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("file", FILES)
def test_tokens_are_stable_within_the_lookahead(file):
    """The window's output, token by token, equals merging the whole word, and the window is bounded."""
    own, draw, symbols = bpe.transducer(P.path(file)), random.Random(5), bpe.byte_symbols()
    assert own.window < 1000
    for size in (1, own.window - 1, own.window, own.window + 1, 3 * own.window):
        for letters in ("ab", "the ing", "0123456789"):
            word = [symbols[ord(draw.choice(letters))] for _ in range(size)]
            whole = own._merge([*word[:-1], word[-1] + own.end])
            assert list(own.tokens(iter(word))) == whole


def test_lookahead_of_small_lists():
    assert bpe.lookahead([]) == 0
    assert bpe.lookahead([("a", "b")]) == 1
    # bc undoes ab to its left: the frontier moves over b, then over a
    assert bpe.lookahead([("b", "c"), ("a", "b")]) == 2
    with pytest.raises(ValueError):
        bpe.lookahead([("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError):
        bpe.lookahead([("a", "bc"), ("ab", "c")])


def test_bytes_become_text_when_complete():
    back = bpe.decoder(P.path("byte_bpe_50k.json"))
    ids = bpe.encoder(P.path("byte_bpe_50k.json")).encode("日本 é")
    assert "".join(back.pieces(ids)) == "日本 é"
    cut = list(back.pieces(ids[:1]))
    assert "".join(cut) == Tokenizer.from_file(P.path("byte_bpe_50k.json")).decode(ids[:1])


def test_rows_nulls_clashes_and_empty_tables(spark, docs):
    path = P.path(FILES[0])
    rows = docs((1, "Hello there"), (None, None), (3, ""), (1, "Hello there")).withColumnRenamed("lang", "ids")
    out = bpe.with_text(bpe.with_ids(rows, path), path, ids="ids_")
    got = {(r.doc_id, r.text): (r.ids_, r.decoded) for r in out.collect()}
    assert out.count() == 4 and got[(None, None)] == ([], "") and got[(3, "")] == ([], "")
    assert got[(1, "Hello there")][0] == Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids
    assert bpe.round_trip(rows.limit(0), path).count() == 0
    both = bpe.round_trip(rows, path, keep=["doc_id"])
    assert both.columns == ["doc_id", "ids", "decoded"]
    assert np.array_equal(sorted(len(r.ids) for r in both.collect()), sorted(len(v) for v in [[], [], got[(1, "Hello there")][0], got[(1, "Hello there")][0]]))
