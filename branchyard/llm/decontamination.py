"""Benchmark decontamination by spaced-seed hashing.

Each mask is a run of word positions of which some are ignored. The words at the positions that
a mask keeps are hashed, at every place of every benchmark item and of every document, so a
place still meets its copy when the ignored words were replaced. Hashes of both sides are
joined. Around each hit document and item are laid on each other (hits of one document and item
at the same distance share one alignment) and compared word by word, which decides: a document
is contaminated by an item where an aligned run of at least ``min_words`` words, or the whole
item if that is shorter, agrees in ``percent`` of its words.

The masks are chosen so that no overlap is lost before it is compared: a run of 13 words or more
that agrees in 80 % of them has all kept words of some mask at some place, wherever the replaced
words stand. Items of fewer than 13 words have masks of their own, over the whole item, with the
same property. Both are checked in the tests by going through all places of replaced words, the
first also for runs of any length.

The benchmark's hashes also fill a filter of fixed size, which the tasks that read the documents
hold: most places of documents fall through it and are never shuffled. What passes is joined,
so false passes of the filter change nothing.

Defined results: null and empty texts on either side meet nothing. Items with fewer words than
``min_words`` have to stand whole in a document, from the first word to the last, and agree in
``percent`` of them; with fewer than 5 words that is all.
A document that several items or several rows of an item meet has one row per document, item and
alignment group. Rows without an id meet nothing and are never dropped. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.functions.expressions import quoted
from branchyard.llm.common import FACTOR, INVERSE, bit_filter, column, free_name, mixed, passes, powers, python_tasks, row_ids, span_hashes, stored, word_spans

#: The masks; 1 keeps a word, 0 ignores it. Each keeps 7 of up to 13 words. Every
#: run of MIN_WORDS words or more that agrees in PERCENT of them is met by one of them.
MASKS = ("111101011", "1011001000111", "11011111", "11100011011", "1110000101011", "10100110111")
#: Words that an overlap has at least, and per cent of them that agree.
MIN_WORDS = 13
PERCENT = 80

IN_WORD = np.zeros(256, bool)
IN_WORD[[*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True


def word_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").lower().encode(), np.uint8)
    return span_hashes(data, *word_spans(data, IN_WORD))


def _kept(mask: str) -> tuple[int, ...]:
    return tuple(k for k, bit in enumerate(mask) if bit == "1")


@lru_cache(maxsize=None)
def short_masks(n: int) -> tuple[str, ...]:
    """Masks over a whole item of ``n`` words, so many that one keeps no word that may be replaced.

    The words between the first and the last are dealt into groups of one or two; each mask
    ignores as many groups as words may be replaced.
    """
    size, replaced = (1 if n < 8 else 2), n * (100 - PERCENT) // 100
    groups = [range(k, min(k + size, n - 1)) for k in range(1, n - 1, size)]
    ignored = [{k for group in chosen for k in group} for chosen in combinations(groups, replaced)]
    return tuple("".join("0" if k in gaps else "1" for k in range(n)) for gaps in ignored)


def seeds(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of every mask at every place, and of the masks of whole items of the given short lengths."""
    masks = [(k, mask) for k, mask in enumerate(MASKS)] + [(64 * int(n) + k, mask) for n in lengths for k, mask in enumerate(short_masks(int(n)))]
    hashes, places = [], []
    with np.errstate(over="ignore"):
        # the sum of the kept words' hashes, each times a power for its place, taken back to place 0
        placed, back = words * powers(FACTOR, len(words))[: len(words)], powers(INVERSE, len(words))
        for number, mask in masks:
            n = max(0, len(words) - len(mask) + 1)
            sums = np.zeros(n, np.uint64)
            for k in _kept(mask):
                sums += placed[k : k + n]
            hashes.append(mixed(sums * back[:n] ^ np.uint64(number * FACTOR % 2**64)))
            places.append(np.arange(n))
    return np.concatenate(hashes), np.concatenate(places)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(column(batch, "item_id").to_pylist(), column(batch, "item_text").to_pylist()):
            words = word_hashes(text)
            hashes, places = seeds(words, np.array([len(words)] if 0 < len(words) < MIN_WORDS else [], int))
            n = len(hashes)
            yield pa.record_batch(
                {"item_id": pa.array([item] * n, pa.int64()), "hash": pa.array(hashes.view(np.int64)), "item_place": pa.array(places, pa.int32()), "n_words": pa.array([len(words)] * n, pa.int32())}
            )


def _doc_seeds(batches: Iterator[pa.RecordBatch], bits: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text")):
            words = word_hashes(text.as_py())
            hashes, places = seeds(words, lengths)
            keep = passes(bits, hashes)
            if keep.any():
                out.append((np.full(int(keep.sum()), doc, np.int64), hashes[keep].view(np.int64), places[keep].astype(np.int32)))
        if out:
            docs, hashes, places = map(np.concatenate, zip(*out))
            yield pa.record_batch({"doc_id": pa.array(docs), "hash": pa.array(hashes), "doc_place": pa.array(places)})


def best_run(same: np.ndarray, min_words: int, percent: int) -> tuple[int, int] | None:
    """The longest stretch that begins and ends with agreeing words and agrees in ``percent`` of them, as (first, length)."""
    at = np.flatnonzero(same)
    if not len(at):
        return None
    # with 100 for an agreeing word and a loss of ``percent`` for every word, a stretch is good if its sum is not negative
    sums = np.concatenate([[0], np.cumsum(100 * same.astype(np.int64) - percent)])
    # the greatest sum behind an agreeing word at or after each place falls from left to right
    ahead = np.full(len(sums), sums.min() - 1)
    ahead[at + 1] = sums[at + 1]
    ahead = np.maximum.accumulate(ahead[::-1])[::-1]
    lengths = np.searchsorted(-ahead, -sums[at], side="right") - 1 - at
    best = int(np.argmax(lengths))
    return (int(at[best]), int(lengths[best])) if lengths[best] >= min_words else None


def _checked(batches: Iterator[pa.RecordBatch], min_words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows have the texts of a document and an item and the shifts of their alignments."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64()), ("n_equal", pa.int64())])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            doc, item = word_hashes(row["text"]), word_hashes(row["item_text"])
            best = None
            for shift in row["shifts"]:  # where the item's first word falls in the document
                low, high = max(0, -shift), min(len(item), len(doc) - shift)
                same = doc[shift + low : shift + high] == item[low:high]
                run = best_run(same, min(min_words, len(item)), percent)
                if run and (best is None or run[1] > best[1]):
                    best = (shift + low + run[0], run[1], int(same[run[0] : run[0] + run[1]].sum()))
            if best:
                rows.append({"doc_id": row["doc_id"], "item_id": row["item_id"], "doc_word": best[0], "n_words": best[1], "n_equal": best[2]})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, item_id, doc_word, n_words, n_equal): the longest overlap of each document and item that have one.

    ``doc_word`` is the place of its first word in the document, ``n_words`` its length and
    ``n_equal`` how many of its words agree. The masks lose no overlap down to MIN_WORDS words and
    PERCENT, so lower values are an error.
    """
    if min_words < MIN_WORDS or percent < PERCENT:
        raise ValueError(f"the masks are made for min_words of {MIN_WORDS} and percent of {PERCENT} at least")
    python_tasks(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("item_text")).where("item_id IS NOT NULL")
    item_seeds = stored(items.mapInArrow(_item_seeds, "item_id long, hash long, item_place int, n_words int"), "item-seeds")
    bits = bit_filter(item_seeds, "hash")
    short = item_seeds.where(F.col("n_words") < MIN_WORDS).select("n_words").distinct()  # MIN_WORDS rows at most
    lengths = np.array(sorted(row["n_words"] for row in short.collect()), int)
    doc_seeds = docs.mapInArrow(partial(_doc_seeds, bits=bits, lengths=lengths), "doc_id long, hash long, doc_place int")
    shifts = doc_seeds.join(item_seeds, "hash").select("doc_id", "item_id", (F.col("doc_place") - F.col("item_place")).alias("shift")).distinct()
    hits = stored(shifts.groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_list("shift")).alias("shifts")), "hits")
    bits = bit_filter(hits.select("doc_id"), "doc_id")
    texts = docs.mapInArrow(partial(_filtered, bits=bits), "doc_id long, text string")
    rows = hits.join(texts, "doc_id").join(items, "item_id")
    found = rows.mapInArrow(partial(_checked, min_words=min_words, percent=percent), "doc_id long, item_id long, doc_word long, n_words long, n_equal long")
    # a document or item that stands in several rows keeps its longest overlap
    best = F.max(F.struct("n_words", "n_equal", (-F.col("doc_word")).alias("before"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("best.before")).alias("doc_word"), "best.n_words", "best.n_equal")


def _filtered(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(passes(bits, column(batch, "doc_id").to_numpy(zero_copy_only=False))))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that no benchmark item contaminates, with all their columns; rows without an id stay.

    Of an id that stands in several rows, only the rows whose own text is contaminated go.
    """
    rows, row = row_ids(docs, id_col)
    name = free_name(rows, "_contaminated")
    found = contaminations(rows, benchmark, id_col=row, **options).select(F.col("doc_id").alias(name)).distinct()
    return rows.join(found, F.col(row).cast("long") == F.col(name), "left_anti").select([quoted(c) for c in docs.columns])
