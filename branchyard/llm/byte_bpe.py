"""Byte-level BPE: texts to ids and back.

Encoding (see ``blocks``): the split pattern takes texts apart into pre-tokens with their
positions; each distinct pre-token of the corpus is merged once, on whichever task its rows
meet; the ids are joined back to the blocks and stand in order of position. Decoding joins ids
with the table of token bytes. That table is as large as the vocabulary file, so every task
holds it.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated rows give
repeated rows, null document ids stay null. An empty table gives no rows. Only the two named
columns are read, so others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.blocks import Block, once_per_word, sized
from branchyard.llm.common import column, python_tasks


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids of a rank file: a base64 token and a number a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("of a file", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    table = [b""] * (max(ranks(path).values()) + 1)
    for token, rank in ranks(path).items():
        table[rank] = token
    return table


# The classes of the characters up to U+00FF, for texts that have no others: the standard
# library's matcher is twice as fast, but knows no \p{L} and \p{N}.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = r"\t-\r \x85\xa0"
NARROW = {r"\p{L}": LETTERS, r"\p{N}": NUMBERS, r"\s": SPACES, r"\S": f"^{SPACES}"}


@lru_cache(maxsize=4)
def matchers(pattern: str) -> tuple:
    """findall for texts up to U+00FF, and for all texts."""
    narrow = re.sub(
        r"\[(.*?)\]|(\\p\{[LN]\}|\\[sS])",
        lambda m: "[" + re.sub(r"\\p\{[LN]\}|\\s", lambda k: NARROW[k[0]], m[1]) + "]" if m[1] else f"[{NARROW[m[2]]}]",
        pattern,
    )
    # \s of the first matcher also takes U+001C to U+001F, which Unicode's white space leaves out
    wide = re.sub(r"\[(\^?)\\s|\\s|\\S", lambda m: f"[{m[1]}{WHITE}" if m[0][0] == "[" else f"[{'^' if m[0] == chr(92) + 'S' else ''}{WHITE}]", pattern)
    return re.compile(narrow).findall, regex.compile(wide).findall


#: The characters with Unicode's White_Space property.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def pre_tokens(text: str, pattern: str) -> list[str]:
    """The matches of the pattern, in order."""
    narrow, wide = matchers(pattern)
    return narrow(text) if text.isascii() or max(text) <= "\xff" else wide(text)


def _encoder(ranks_path: str, pattern: str):
    """What turns distinct pre-tokens into ids."""
    one = encoding(ranks_path, pattern)._encode_single_piece
    return lambda words: sized([one(word.encode()) for word in words])


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the token ids of each whole text, without special tokens."""

    def finish(block: Block):
        ids, sizes = block.results()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = ends[np.concatenate([[0], block.ends])].astype(np.int32)
        return pa.table({"doc_id": pa.array(block.doc_ids, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view(np.int32)))})

    split = partial(pre_tokens, pattern=pattern)
    return once_per_word(docs, split, partial(_encoder, ranks_path, pattern), finish, "doc_id long, ids array<int>", id_col=id_col, text_col=text_col)


def _decoded(batches, ranks_path):
    table = token_bytes(ranks_path)
    for batch in batches:
        data = [b"".join(map(table.__getitem__, ids.as_py())) if ids.is_valid else None for ids in column(batch, "ids")]
        yield batch.append_column("bytes", pa.array(data, pa.binary()))


def decode(encoded: DataFrame, ranks_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, bytes): the bytes that lists of ids stand for; a null list gives null."""
    python_tasks(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(lambda batches: _decoded(batches, ranks_path), "doc_id long, ids array<int>, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts encoded, and their ids decoded again.

    As encode(), decode() and digests, but a task takes one document after the other in the worker that
    puts its block together, so that neither ids nor bytes of a block are held or sent on whole.
    """

    def finish(block: Block):
        table, out = token_bytes(ranks_path), ([], [], [])
        for ids in block.each():
            out[0].append(len(ids))
            out[1].append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
            out[2].append(hashlib.sha256(b"".join(map(table.__getitem__, ids.tolist()))).hexdigest())
        return pa.table({"doc_id": pa.array(block.doc_ids, pa.int64()), "n_tokens": pa.array(out[0], pa.int64()), "ids_sha256": pa.array(out[1], pa.string()), "decoded_sha256": pa.array(out[2], pa.string())})

    split = partial(pre_tokens, pattern=pattern)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return once_per_word(docs, split, partial(_encoder, ranks_path, pattern), finish, schema, id_col=id_col, text_col=text_col)
