from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from branchyard.llm import blocks, byte_bpe, token_counts
from tests.llm.helpers import ODD, clashing, frame

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return clashing(frame(spark, ODD)).select("doc_id", "text").union(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000", "text")).cache()


def rows_of(frame, *names):
    return sorted((tuple(row[n] for n in names) for row in frame.collect()), key=repr)


def test_encoding_is_the_library_s_and_comes_back(docs):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.ranks(RANKS), special_tokens={})
    want = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        text = (row.text or "").encode()
        want.append((row.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()))
    got = rows_of(byte_bpe.round_trip(docs, RANKS, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=repr)


def test_counts_are_the_library_s(docs):
    library = Tokenizer.from_file(WORDS)
    want = []
    for row in docs.collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        want.append((row.doc_id, len((row.text or "").encode()), n, n > 2048))
    got = rows_of(token_counts.token_counts(docs, WORDS), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == sorted(want, key=repr)


def test_blocks_of_few_bytes_give_the_same(spark, docs, monkeypatch):
    # a block ends after each document
    small = docs.where("length(text) < 3000")
    want = rows_of(byte_bpe.round_trip(small, RANKS, P.PATTERN), "doc_id", "ids_sha256")
    with monkeypatch.context() as patch:
        patch.setattr(blocks, "BLOCK_BYTES", 1)
        parts = list(blocks._cut(iter([_batch([(1, "a b"), (2, None), (1, "a b")])])))
        assert [(ids, texts) for _, ids, texts in parts] == [([1], ["a b"]), ([2, 1], ["", "a b"])]
    assert want == rows_of(byte_bpe.round_trip(small.repartition(7), RANKS, P.PATTERN), "doc_id", "ids_sha256")


def _batch(rows):
    import pyarrow as pa

    return pa.record_batch({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})


def test_a_block_that_changed_is_an_error():
    import pyarrow as pa

    [row] = blocks._places(iter([_batch([(1, "a b")])]), str.split, False)
    one = blocks.packed(np.array([1]))
    results = pa.Table.from_pylist([{"block": 0, "n": 1, "n_values": 1, "numbers": one, "sizes": one, "results": one}])
    with pytest.raises(RuntimeError, match="changed"):
        blocks.Block(pa.Table.from_batches([row]), results)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert byte_bpe.round_trip(empty, RANKS, P.PATTERN).collect() == []
    assert token_counts.token_counts(empty, WORDS).collect() == []


def test_packing_comes_back():
    for numbers in ([], [0], [1, 2, 2**32 - 1], range(70_000)):
        a = np.array(numbers, np.uint32)
        assert (blocks.unpacked(blocks.packed(a), len(a)) == a).all()


def test_decoding_joins_the_bytes_of_tokens(spark):
    rows = frame(spark, [(1, [0, 1, 2]), (2, []), (3, None)], "doc_id long, ids array<int>")
    table = byte_bpe.token_bytes(RANKS)
    assert [(r.doc_id, r.bytes) for r in byte_bpe.decode(rows, RANKS).collect()] == [(1, table[0] + table[1] + table[2]), (2, b""), (3, None)]
