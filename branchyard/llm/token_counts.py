"""Token counts of whole texts without their ids.

The tokenizer's own rules split a text into pre-tokens; a document is kept as its distinct
pre-tokens and their frequencies (see ``blocks``). The pieces of each distinct pre-token of the
corpus are counted once by the tokenizer, the counts are joined to the frequencies, and a
document's count is the sum of their products.

Defined results: a null or empty text has 0 bytes and 0 tokens. Repeated rows give repeated rows,
null document ids stay null. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from branchyard.llm.blocks import Block, once_per_word
from branchyard.llm.byte_bpe import pre_tokens

@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=4)
def rules(path: str) -> tuple[str, object]:
    """The pattern that finds pre-tokens, and a matcher of the special strings."""
    with open(path, encoding="utf-8") as file:
        description = json.load(file)
    parts = description["pre_tokenizer"].get("pretokenizers", [description["pre_tokenizer"]])
    splits = [p for p in parts if p["type"] == "Split"]
    steps = [s["type"] for s in (description["normalizer"] or {}).get("normalizers", [])]
    if len(splits) != 1 or not splits[0]["invert"] or splits[0]["behavior"] != "Removed" or steps != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path}: only files that lower-case texts and split them by one pattern are supported")
    special = [regex.escape(t["content"]) for t in description["added_tokens"] if t["special"] and not t["normalized"]]
    return splits[0]["pattern"]["Regex"], regex.compile("(" + "|".join(special) + ")") if special else None


def pieces(text: str, path: str) -> list[str]:
    """The pre-tokens of a text; special strings are pre-tokens of their own, as written."""
    pattern, special = rules(path)
    if special is None or not special.search(text):
        return _plain(text, pattern)
    out = []
    for k, part in enumerate(special.split(text)):
        out += [part] if k % 2 else _plain(part, pattern)
    return out


def _plain(text: str, pattern: str) -> list[str]:
    if not text.isascii():
        # lower-casing goes letter by letter, so a final sigma is like any other
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return pre_tokens(text.lower(), pattern)


def token_counts(docs: DataFrame, path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each whole text.

    ``path`` names a tokenizer file of the ``tokenizers`` library that lower-cases and splits
    by one pattern. Tokens are counted without added special tokens; special strings inside a
    text count as the library counts them.
    """

    def start():
        made = tokenizer(path)

        def work(words):
            counts = [len(x.ids) for x in made.encode_batch(words, add_special_tokens=False)]
            return np.ones(len(counts), np.int64), np.array(counts, np.int64)

        return work

    def finish(block: Block):
        products = block.results()[0].astype(np.int64) * block.times
        sums = np.concatenate([[0], np.cumsum(products)]).astype(np.int64)
        n = np.diff(sums[np.concatenate([[0], block.ends])])
        return pa.table(
            {"doc_id": pa.array(block.doc_ids, pa.int64()), "n_bytes": pa.array(block.n_bytes, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array(n > limit)}
        )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return once_per_word(docs, partial(pieces, path=path), start, finish, schema, id_col=id_col, text_col=text_col, frequencies=True)
