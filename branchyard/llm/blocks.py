"""Work done once per distinct word of a whole corpus.

Documents are taken in blocks of at most BLOCK_BYTES of text. A block numbers its distinct
words and keeps its documents as sequences of these numbers. Then each (block, number, word)
is a row; the rows of all blocks are shuffled by word, so that equal words stand together,
and each distinct word of the corpus is worked on once, whatever number of blocks use it.
The results go back to the blocks, which put them in the place of the words. On their way back
the results of many words of a block travel packed in one row.

A row is a word of a block, not of a document or a place, so far fewer rows are shuffled
than there are words. A very frequent word has one row per block, and its rows are read as a
stream. No word list is ever held whole.

Blocks are named by a hash of what they hold. They are formed anew for the words and for the
documents, so a block must be the same when it is read again: the input should be a scan or a
written table. If a block is not, the job fails; it never gives wrong results.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import column, python_tasks

#: Bytes of text in one block: it is taken apart and put together in one task's memory.
BLOCK_BYTES = 16 << 20

Split = Callable[[str], list[str]]


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers in few bytes: first all lowest bytes, then the next, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=4 * n + 1), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[str]]]:
    """Blocks as (name, ids, texts); null is the empty text."""
    ids, texts, size, digest = [], [], 0, hashlib.blake2b(digest_size=8)
    for batch in batches:
        for doc, value in zip(column(batch, "doc_id").to_pylist(), column(batch, "text")):
            text = value.as_py() or ""
            data = text.encode()
            digest.update(b"%r %d " % (doc, len(data)) + data)
            ids.append(doc)
            texts.append(text)
            size += len(data)
            if size >= BLOCK_BYTES:
                yield int.from_bytes(digest.digest(), "little", signed=True), ids, texts
                ids, texts, size, digest = [], [], 0, hashlib.blake2b(digest_size=8)
    if ids:
        yield int.from_bytes(digest.digest(), "little", signed=True), ids, texts


def _words(batches: Iterator[pa.RecordBatch], split: Split) -> Iterator[pa.RecordBatch]:
    for block, _, texts in _cut(batches):
        words: dict[str, None] = {}
        for text in texts:
            words |= dict.fromkeys(split(text))
        yield pa.record_batch({"block": pa.array([block], pa.int64()), "words": pa.array([list(words)], pa.list_(pa.string()))})


def _places(batches: Iterator[pa.RecordBatch], split: Split, frequencies: bool) -> Iterator[pa.RecordBatch]:
    """Numbers are given in the order in which the words first appear, as in ``_words``."""
    for block, ids, texts in _cut(batches):
        number = defaultdict(count().__next__)
        parts, times, bytes_ = [], [], []
        for text in texts:
            words = split(text)
            places = np.fromiter(map(number.__getitem__, words), np.uint32, len(words))
            if frequencies:
                places, n = np.unique(places, return_counts=True)
                times.append(n.astype(np.uint32))
            parts.append(places)
            bytes_.append(len(text.encode()))
        row = {
            "block": pa.array([block], pa.int64()),
            "n_words": pa.array([len(number)], pa.int64()),
            "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "n_bytes": pa.array([bytes_], pa.list_(pa.int64())),
            "lengths": pa.array([[len(p) for p in parts]], pa.list_(pa.int32())),
            "places": pa.array([packed(np.concatenate(parts))], pa.binary()),
            "times": pa.array([packed(np.concatenate(times)) if frequencies else None], pa.binary()),
        }
        yield pa.record_batch(row)


PLACES = "block long, n_words long, doc_ids array<long>, n_bytes array<long>, lengths array<int>, places binary, times binary"


Results = tuple[np.ndarray, np.ndarray]
Start = Callable[[], Callable[[list[str]], Results]]


def _once(batches: Iterator[pa.RecordBatch], start: Start) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by word; ``start()`` gives what turns distinct words into results.

    Results are whole numbers, as many of a word as it has: how many, and all of them in order.
    """
    work = start()
    last_word, last = None, (np.zeros(1, np.int64), np.zeros(0, np.int64))
    for batch in batches:
        if not batch.num_rows:
            continue
        words = pc.dictionary_encode(column(batch, "word"))
        distinct = words.dictionary.to_pylist()
        if distinct[0] == last_word:
            sizes, values = map(np.concatenate, zip(last, work(distinct[1:])))
        else:
            sizes, values = work(distinct)
        last_word, last = distinct[-1], (sizes[-1:], values[len(values) - sizes[-1] :])
        at = words.indices.to_numpy()
        block, number = column(batch, "block").to_numpy(), column(batch, "number").to_numpy()
        order = np.lexsort((number, block))
        at, block, number = at[order], block[order], number[order]
        values, sizes = gathered(sizes, values, at)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        rows = [
            {
                "block": block[i], "n": j - i, "n_values": ends[j] - ends[i], "numbers": packed(np.diff(number[i:j], prepend=0)),
                "sizes": packed(sizes[i:j]), "results": packed(values[ends[i] : ends[j]]),
            }
            for i, j in zip(cuts, cuts[1:])
        ]
        yield pa.RecordBatch.from_pylist(rows, RESULTS)


RESULTS = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("n_values", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary()), ("results", pa.binary())])


def gathered(sizes: np.ndarray, values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The results of the words at ``places`` one after the other, and how many each has."""
    own = sizes[places]
    ends = np.cumsum(own)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(n, len(values)) < 2**31 else np.int64  # half the memory
    moved = (np.cumsum(sizes) - sizes)[places] - (ends - own)
    at = np.repeat(moved.astype(kind), own)
    at += np.arange(n, dtype=kind)
    return values[at], own


class Block:
    """The documents of one block as numbers, and the results of each number."""

    def __init__(self, places: pa.Table, results: pa.Table) -> None:
        row = places.to_pylist()[0]
        self.doc_ids, self.n_bytes = row["doc_ids"], row["n_bytes"]
        self.lengths = np.array(row["lengths"], np.int64)
        self.places = unpacked(row["places"], int(self.lengths.sum()))
        self.times = unpacked(row["times"], len(self.places)) if row["times"] is not None else None
        self.ends = np.cumsum(self.lengths)
        nothing = np.zeros(0, np.int64)
        numbers, sizes, values = [nothing], [nothing], [nothing.astype(np.uint32)]
        for part in results.to_pylist():
            numbers.append(np.cumsum(unpacked(part["numbers"], part["n"]).astype(np.int64)))
            sizes.append(unpacked(part["sizes"], part["n"]).astype(np.int64))
            values.append(unpacked(part["results"], part["n_values"]))
        # a block that stands twice has its results twice
        numbers, first = np.unique(np.concatenate(numbers), return_index=True)
        if len(numbers) != row["n_words"]:
            raise RuntimeError("a block of documents changed while it was read; give a written table")
        self.values, self.sizes = gathered(np.concatenate(sizes), np.concatenate(values), first)

    def each(self) -> Iterator[np.ndarray]:
        """The results of one document after the other."""
        begins = np.cumsum(self.sizes) - self.sizes
        for a, b in zip(self.ends - self.lengths, self.ends):
            places = self.places[a:b]
            own = self.sizes[places]
            at = np.repeat(begins[places] - (np.cumsum(own) - own), own)
            yield self.values[at + np.arange(len(at))]

    def results(self) -> tuple[np.ndarray, np.ndarray]:
        """The results of all words of the documents in order, and how many each word has."""
        return gathered(self.sizes, self.values, self.places)


def once_per_word(
    docs: DataFrame,
    split: Split,
    start: Start,
    finish: Callable[[Block], pa.Table],
    schema: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequencies: bool = False,
) -> DataFrame:
    """``finish`` of every block, which has the results of ``start()`` for its distinct words.

    ``frequencies``: a block keeps the distinct words of a document and how often they stand
    there, instead of all its words in order.
    """
    python_tasks(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = docs.mapInArrow(lambda batches: _words(batches, split), "block long, words array<string>")
    words = words.select("block", F.posexplode("words").alias("number", "word"))
    words = words.repartition("word").sortWithinPartitions("word")
    results = words.mapInArrow(lambda batches: _once(batches, start), "block long, n long, n_values long, numbers binary, sizes binary, results binary")
    places = docs.mapInArrow(lambda batches: _places(batches, split, frequencies), PLACES)

    def put_together(left, right):
        if not left.num_rows:
            raise RuntimeError("a block of documents changed while it was read; give a written table")
        out = [finish(Block(left.slice(i, 1), right)) for i in range(left.num_rows)]
        return pa.concat_tables(out)

    return places.groupBy("block").cogroup(results.groupBy("block")).applyInArrow(put_together, schema)


def sized(lists: list[list[int]]) -> Results:
    """Lists as their sizes and all their numbers."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
