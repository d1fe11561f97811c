"""Substring dedup by relative Lempel-Ziv parsing against an index of reference contexts.

A passage of ``window`` words or more that also stands in a document with a smaller id goes. Documents
are parsed into factors, stretches that a reference text already holds, and what lies between them.
Parsing every document against every block of reference documents would be a product of the two. Here
the index of references is dealt out by anchors, and a document meets the parts it shares anchors with.

Anchors. Of the runs of SEED words within a window, the one with the smallest hash is the window's
anchor. It depends on the window alone, so equal windows have equal anchors wherever they stand, and
about one word in twenty begins one. The context of an anchor is all words that share a window with it.

Index. For each anchor that two documents have, and for each of its distinct contexts, the smallest
document that holds it: the reference. Anchors of one document are dropped before anything else.

Factors. In a document, every window whose anchor stands in the context of a smaller document is known
to be repeated, as the whole context is. A factor begins at the first such window and goes on greedily
as long as the next window is one: these are the factors that are long enough. At factor boundaries
contexts differ, so a window may still be repeated though its anchor's context is not: there the
windows are checked one by one, by the smallest document that holds the same words. Only documents
that are the first with their context have to take part in that check, as reference or as copy:
another window with that anchor either equals one of theirs or is known already. So the check is
complete, and exact copies and the inner part of passages cost one row per anchor.

Context and window are compared by 64-bit hashes of all their words within equal 64-bit hashes of the
anchor, or by 128 bits. Rows are combined before they are shuffled; the joins by anchor, context and
window are plain equi-joins, whose hot keys Spark splits. Texts are shuffled once, and those of the
documents with windows to check once more.

Defined results: words are runs of bytes other than space and \\t to \\r. A null text has no words and
is kept as none. Documents with fewer words than ``window`` lose none. Rows without an id are kept
whole and are no reference. Rows of one id are not held against each other; each is judged by its own
text. Empty tables give no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import FACTOR, column, mixed, powers, python_tasks, span_hashes, stored, texts_of, word_spans

#: Words of the runs that anchors are chosen from.
SEED = 12
#: A second odd factor, for hashes of 128 bits.
OTHER = 0xC2B2AE3D27D4EB4F

IN_WORD = np.ones(256, bool)
IN_WORD[[32, *range(9, 14)]] = False


class Runs:
    """Hashes of runs of words: any run's from two sums, the same wherever it stands."""

    def __init__(self, words: np.ndarray, factor: int) -> None:
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * powers(factor, len(words))[:-1], out=self.sums[1:])
        self.inverse = pow(factor, -1, 2**64)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[ends] - self.sums[starts]) * powers(self.inverse, len(self.sums))[starts]
            return mixed(raw ^ (ends - starts).astype(np.uint64) * np.uint64(FACTOR))


class Words:
    """The words of some texts one after the other, and the windows and anchors of each text."""

    def __init__(self, texts: list[bytes], window: int) -> None:
        data = np.frombuffer(b" ".join(texts), np.uint8)
        starts, ends = word_spans(data, IN_WORD)
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        #: the first word of each text, and the number of all words
        self.firsts = np.searchsorted(starts, begins)
        words = span_hashes(data, starts, ends)
        self.n, self.window = len(words), window
        text_of = np.repeat(np.arange(len(texts)), np.diff(self.firsts))
        at = np.arange(max(0, self.n - window + 1))
        #: the windows that lie in one text, by their first word
        self.windows = at[text_of[at] == text_of[at + window - 1]]
        self.text_of = text_of
        self.runs = Runs(words, FACTOR), Runs(mixed(words), OTHER)
        seeds = self.runs[0].hashes(np.arange(max(0, self.n - SEED + 1)), np.arange(SEED, max(SEED, self.n + 1)))
        width = window - SEED + 1
        view = np.lib.stride_tricks.sliding_window_view(seeds, width) if len(seeds) >= width else np.zeros((0, 1), np.uint64)
        #: the anchor of each window, by its first word
        self.anchor_of = np.empty(len(self.windows), np.int64)
        for k in range(0, len(self.windows), 1 << 16):
            part = self.windows[k : k + (1 << 16)]
            self.anchor_of[k : k + (1 << 16)] = part + view[part].argmin(1)
        self.anchors, self.number = np.unique(self.anchor_of, return_inverse=True)
        self.seeds = seeds[self.anchors]
        own = text_of[self.anchors]
        left = np.maximum(self.anchors - (window - SEED), self.firsts[own])
        right = np.minimum(self.anchors + window, self.firsts[own + 1])
        with np.errstate(over="ignore"):
            #: the context of each anchor, and where in it the anchor stands
            self.contexts = mixed(self.runs[1].hashes(left, right) + (self.anchors - left).astype(np.uint64))


#: Bytes of text that are taken apart at once.
PART_BYTES = 2 << 20


def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of a batch of some PART_BYTES together, and the row of the first."""
    first, texts, size = 0, [], 0
    for row, text in enumerate(texts_of(batch)):
        texts.append(text)
        size += len(text)
        if size >= PART_BYTES:
            yield first, texts
            first, texts, size = row + 1, [], 0
    if texts:
        yield first, texts


# ---- the index of references ------------------------------------------------------------------


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in parts(batch):
            words = Words(texts, window)
            row = words.text_of[words.anchors]
            found = np.unique(np.stack([row, words.seeds.view(np.int64), words.contexts.view(np.int64)], 1), axis=0)
            at = pa.array(found[:, 0] + first)
            yield pa.record_batch({
                "doc_id": column(batch, "doc_id").take(at), "text_key": column(batch, "text_key").take(at),
                "anchor": pa.array(found[:, 1]), "context": pa.array(found[:, 2]),
            })


def marks(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_key, marks) of the anchors that a document shares with others.

    A mark is known where a smaller document has the anchor in the same context; else its windows
    are to be checked.
    """
    anchors = docs.where("doc_id IS NOT NULL").mapInArrow(lambda batches: _anchors(batches, window), "doc_id long, text_key long, anchor long, context long")
    anchors = stored(anchors, "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("anchor")
    anchors = stored(anchors.join(shared, "anchor"), "shared-anchors")
    contexts = anchors.groupBy("anchor", "context").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = contexts.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("several"))
    index = contexts.join(several, "anchor").where("several OR first < last")
    found = anchors.join(index, ["anchor", "context"]).where("several OR first < doc_id")
    mark = F.struct("anchor", "context", (F.col("first") < F.col("doc_id")).alias("known"))
    return found.groupBy("doc_id", "text_key").agg(F.collect_set(mark).alias("marks"))


# ---- parsing -----------------------------------------------------------------------------------


def covered(repeated: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words lie in a window, given where windows begin."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, repeated, 1)
    np.add.at(steps, np.minimum(repeated + window, n), -1)
    return np.cumsum(steps[:-1]) > 0


def factors(repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last windows of the greedy factors: each goes on while the next window is repeated too."""
    cuts = np.flatnonzero(np.diff(repeated) != 1)
    return repeated[np.concatenate([[0], cuts + 1]).astype(int)] if len(repeated) else repeated, repeated[np.concatenate([cuts, [-1]]).astype(int)] if len(repeated) else repeated


def kept_text(text: bytes, removed: np.ndarray | None) -> tuple[int, int, bytes]:
    words = text.split()
    if removed is None:
        return len(words), 0, b" ".join(words)
    return len(words), int(removed.sum()), b" ".join(compress(words, ~removed))


FACTORED = (
    "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string, text string,"
    " firsts array<int>, lasts array<int>, at array<int>, a array<long>, b array<long>"
)


def _factored(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Documents without windows to check are done; the others keep their text, factors and windows."""
    for batch in batches:
        out = []
        ids, keys, lists = column(batch, "doc_id").to_pylist(), column(batch, "text_key").to_pylist(), column(batch, "marks")
        for first, texts in parts(batch):
            for row, text in enumerate(texts, first):
                known = to_check = np.zeros(0, np.int64)
                words = None
                if lists[row].is_valid:
                    words = Words([text], window)
                    found = lists[row].values
                    pairs = np.stack([found.field("anchor").to_numpy(), found.field("context").to_numpy()], 1)
                    state = dict(zip(map(tuple, pairs.tolist()), found.field("known").to_pylist()))
                    own = zip(words.seeds.view(np.int64).tolist(), words.contexts.view(np.int64).tolist())
                    of_anchor = np.array([{None: 0, True: 1, False: 2}[state.get(pair)] for pair in own], np.int8)
                    kinds = of_anchor[words.number] if len(of_anchor) else np.zeros(0, np.int8)
                    known, to_check = words.windows[kinds == 1], words.windows[kinds == 2]
                firsts, lasts = factors(known)
                removed = covered(known, words.n, window) if len(known) else None
                if removed is not None and len(to_check):
                    # inside a factor there is nothing left to decide
                    inside = np.concatenate([[0], np.cumsum(removed)])
                    to_check = to_check[inside[to_check + window] - inside[to_check] < window]
                line = {"doc_id": ids[row], "text_key": keys[row]}
                if len(to_check):
                    every = words.windows[kinds == 2]  # as references for others all of them count
                    hashes = [runs.hashes(every, every + window).view(np.int64) for runs in words.runs]
                    line |= {"text": text.decode(), "firsts": firsts, "lasts": lasts, "at": every, "a": hashes[0], "b": hashes[1]}
                else:
                    if words is not None and (kinds == 2).any():
                        every = words.windows[kinds == 2]
                        hashes = [runs.hashes(every, every + window).view(np.int64) for runs in words.runs]
                        line |= {"at": every, "a": hashes[0], "b": hashes[1]}
                    line["n_words"], line["n_removed"], kept = kept_text(text, removed)
                    line["kept_sha256"] = hashlib.sha256(kept).hexdigest()
                out.append(line)
            yield pa.RecordBatch.from_pylist(out, SCHEMA)
            out = []


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string()),
    ("firsts", pa.list_(pa.int32())), ("lasts", pa.list_(pa.int32())), ("at", pa.list_(pa.int32())), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())),
])


def _checked(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The factors of a document and its repeated windows put together."""
    for batch in batches:
        out = []
        ids = column(batch, "doc_id").to_pylist()
        for row, text in enumerate(texts_of(batch)):
            spans = [np.arange(a, b + 1) for a, b in zip(column(batch, "firsts")[row].as_py(), column(batch, "lasts")[row].as_py())]
            starts = column(batch, "starts")[row].as_py() or []
            repeated = np.concatenate([*spans, np.array(starts, np.int64)]).astype(np.int64)
            n, gone, kept = kept_text(text, covered(repeated, len(text.split()), window))
            out.append((ids[row], n, gone, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.record_batch({name: pa.array(values, kind) for name, values, kind in zip(("doc_id", "n_words", "n_removed", "kept_sha256"), columns, kinds)})


def without_repeats(docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): each document without the passages of ``window`` words that smaller ids hold.

    ``kept_sha256`` is that of the words that stay, joined by one space.
    """
    if window < SEED:
        raise ValueError(f"a window has at least {SEED} words")
    python_tasks(docs.sparkSession)
    text = F.col(text_col)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    marked = docs.join(marks(docs, window), ["doc_id", "text_key"], "left")
    parsed = stored(marked.mapInArrow(lambda batches: _factored(batches, window), FACTORED), "parsed")
    windows = parsed.where("at IS NOT NULL").select("doc_id", "text_key", F.col("text").isNotNull().alias("asks"), F.inline(F.arrays_zip("at", "a", "b")))
    first = windows.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    repeated = windows.where("asks").join(first, ["a", "b"]).where("first < doc_id").groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("starts"))
    to_check = parsed.where("text IS NOT NULL").select("doc_id", "text_key", "text", "firsts", "lasts").join(repeated, ["doc_id", "text_key"], "left")
    done = parsed.where("text IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.union(to_check.mapInArrow(lambda batches: _checked(batches, window), "doc_id long, n_words long, n_removed long, kept_sha256 string"))
