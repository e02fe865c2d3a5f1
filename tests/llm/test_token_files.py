import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from signalwatch.llm import token_files

PATH = P.path("byte_bpe_50k.json")


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    found = [(doc is not None, doc, tokenizer.encode(text or "", add_special_tokens=False).ids + [0]) for doc, text in rows]
    found.sort(key=lambda r: (r[0], r[1] or 0, np.array(r[2], "<u2").tobytes()))
    out, at = [], 0
    for _, doc, ids in found:
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def run(df, **options):
    root, shards, keys = token_files.write_ids(df, PATH, **options)
    got = token_files.read_ids(root, shards, keys, digest=True).collect()
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=repr)


def test_files_hold_all_documents_in_order(docs):
    rows = [(7, "seven"), (2, None), (5, ""), (None, "no id"), (9, "x" * 5000), (2, "two again"), (2, None), (-4, "minus"), (2**62, "big")]
    assert run(docs(*rows)) == brute(rows)


def test_small_shards(docs, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 64)
    monkeypatch.setattr(token_files, "SHARD_DOCS", 3)
    rows = [(i * 3 % 101, f"text number {i}") for i in range(101)]
    assert run(docs(*rows), parts=4) == brute(rows)


def test_unknown_keys_give_nulls(spark, docs):
    root, shards, keys = token_files.write_ids(docs((1, "one"), (2, "two")), PATH, parts=1)
    shard = keys.first().shard
    asked = spark.createDataFrame([(1, 0, shard), (77, 0, shard), (1, 5, shard)], "doc_id long, occurrence long, shard long")
    got = {(r.doc_id, r.n_tokens, None if r.ids is None else tuple(r.ids)) for r in token_files.read_ids(root, shards, asked).collect()}
    want = tuple(Tokenizer.from_file(PATH).encode("one").ids + [0])
    assert got == {(1, len(want), want), (77, None, None), (1, None, None)}


def test_empty_table(docs):
    assert run(docs((1, "x")).limit(0)) == []
