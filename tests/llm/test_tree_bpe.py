import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from signalwatch.llm import queries, tree_bpe
from signalwatch.llm.tree_bpe import Encoder, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [
    "a", "b", "the", "ing", "'", "'r", "'re", "'ll", " ", "   ", "\n", "\t", "é", "日本", "😀", "1", "23", ".", "!!",
    " ", "　", "ل", "é", "<|endoftext|>", "\x00", "\x1c", " ", "'S", "ſ",
]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("leaf", "word_leaf"), [(1, 1), (2, 3), (5, 2), (16, 4), (4096, 48)])
def test_any_cut_gives_the_librarys_ids(ranks, library, leaf, word_leaf):
    encoder, draw = Encoder(ranks, public_tokenizers.PATTERN, leaf, word_leaf), random.Random(leaf)
    for _ in range(400):
        text = "".join(draw.choices(PIECES, k=draw.randrange(40)))
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()
    assert encoder.joins > 0 or word_leaf > 16


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 10000, " " * 20000 + "x", "x" + "\n" * 9000, "日本" * 5000, "é" * 9000 + "'s", "word " * 4000])
def test_long_runs(ranks, library, text):
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_random_letters_without_a_break(ranks, library):
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    text = "".join(random.Random(5).choices("abcdefgh", k=30000))
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    assert encoder.joins > 50  # windows at borders, not the whole run at once


def test_queue_and_list_merge_alike(ranks):
    encoder, draw = Encoder(ranks, public_tokenizers.PATTERN), random.Random(1)
    for _ in range(300):
        word = "".join(draw.choices("etaoin ", k=draw.randrange(1, 150))).encode()
        assert encoder._merge_queued(word) == encoder._merge_listed(word)


def test_columns_nulls_repeats_and_empty_tables(spark, ranks, library):
    rows = spark.createDataFrame(
        [(1, "Hello there", "x"), (1, "Hello there", "x"), (None, None, "y"), (3, "", None)],
        "doc_id long, text string, IDS string",
    )
    out = tree_bpe.with_ids(rows, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "IDS", "ids_"]
    got = sorted((r[0] or 0, r[1] or "", r[2] or "", r[3]) for r in out.collect())
    hello = library.encode_ordinary("Hello there")
    assert got == [(0, "", "y", []), (1, "Hello there", "x", hello), (1, "Hello there", "x", hello), (3, "", "", [])]
    back = tree_bpe.with_bytes(out.withColumn("ids_", F.when(F.col("doc_id") == 1, F.col("ids_"))), PATH, public_tokenizers.PATTERN, ids="ids_")
    assert sorted(bytes(r[-1]) for r in back.collect()) == [b"", b"", b"Hello there", b"Hello there"]
    assert tree_bpe.round_trip(rows.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_gives_the_librarys_digests(spark, docs, library, tmp_path):
    texts = [(1, "The   cat's 23 hats.\n\n\tEt ça, où?"), (2, None), (3, "x" * 5000 + " " * 300), (4, "")]
    docs(*texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_tree_bpe(spark, str(tmp_path)).collect()}
    for doc_id, text in texts:
        ids = library.encode_ordinary(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
