"""Near duplicates by bottom-k sketches.

One hash function orders a document's word shingles. Its hash space is dealt into BANDS
classes, and of each class the PER_BAND smallest values are retained, so a sketch has at
most k = BANDS * PER_BAND values. What a class retains is one entry of the inverted lists:
documents that retain the same values in a class meet there. Sets with a similarity s meet
in each class with a chance of about s ** PER_BAND, so at 0.8 the chance to meet nowhere is
about 1e-9; sets of few shingles have fewer values in a class and meet more surely.

Members of a list are first held against two pivots of the list, which links most of a large
group without its pairs. Members that are still in different components are then held against
each other, in blocks of bounded size. The estimate of a pair's similarity from the union of
the sketches drops pairs that lie six standard errors below the threshold (a sketch that holds
the whole set estimates exactly); the exact Jaccard similarity of the whole sets decides.

Defined results: a null or empty text, or one without words, has no shingles and is linked with
nothing. A text with fewer words than a shingle is one shingle. Rows without an id are not
linked, have a null component and are kept. Repeated rows have the same component. An empty
table gives no rows. Other columns of the input are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import (
    FACTOR,
    bit_filter,
    column,
    connected,
    lower_ascii,
    mixed,
    passes,
    python_tasks,
    span_hashes,
    stored,
    texts_of,
    window_hashes,
    with_group_min,
    word_spans,
)

BANDS = 40
PER_BAND = 4
EMPTY = np.uint32(0xFFFFFFFF)
#: Members of a list that one block holds; a longer list is compared block by block.
BLOCK = 512
#: Pivots of each kind that a member is held against first; it has at most BANDS of each.
PIVOTS = 2
#: Pairs of members that are held against each other at once.
PAIRS = 1 << 13

IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def shingles(text: bytes, width: int) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a text."""
    data = lower_ascii(text)
    words = span_hashes(data, *word_spans(data, IN_WORD))
    if not len(words):
        return words
    width = min(width, len(words))
    return np.unique(window_hashes(words, tuple(range(width)), width))


def sketch(values: np.ndarray) -> np.ndarray:
    """BANDS x PER_BAND numbers: of each class the smallest values in order, then EMPTY."""
    band = (values % np.uint64(BANDS)).astype(np.int64)
    order = np.argsort(band, kind="stable")
    band, firsts = band[order], np.searchsorted(band[order], np.arange(BANDS))
    rank = np.arange(len(band)) - firsts[band]
    out = np.full((BANDS, PER_BAND), EMPTY)
    kept = rank < PER_BAND
    out[band[kept], rank[kept]] = np.minimum(values[order][kept] >> np.uint64(32), np.uint64(EMPTY - 1)).astype(np.uint32)
    return out


def list_keys(sketches: np.ndarray) -> np.ndarray:
    """For each sketch and class the key of its inverted list; 0 where nothing is retained."""
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(mixed(np.arange(BANDS, dtype=np.uint64)), sketches.shape[:2]).copy()
        for k in range(PER_BAND):
            keys = mixed(keys * np.uint64(FACTOR) + sketches[:, :, k])
    keys[sketches[:, :, 0] == EMPTY] = 0
    return keys.view(np.int64)


def unpacked(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint32).reshape(-1, BANDS, PER_BAND)


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of two sketch arrays may come from sets (of n_a and n_b) with that similarity.

    In each class the values up to the smaller of the two last retained ones are a sample
    of the union; a class that is not full is known whole. The sample is drawn without
    replacement, so the error of the estimate shrinks to nothing as it nears the union.
    """
    top = np.minimum(a[:, :, -1], b[:, :, -1])[:, :, None]
    in_a, in_b = (a <= top) & (a != EMPTY), (b <= top) & (b != EMPTY)
    both = np.zeros(a.shape[0], np.int64)
    for k in range(PER_BAND):
        both += (in_a & (a == np.roll(b, k, axis=2)) & np.roll(in_b, k, axis=2)).sum((1, 2))
    union = in_a.sum((1, 2)) + in_b.sum((1, 2)) - both
    unseen = np.maximum(1 - union * (1 + least) / (n_a + n_b), 0)  # of a union with that similarity
    margin = 6 * np.sqrt(least * (1 - least) * unseen / np.maximum(union, 1))
    return both >= (least - margin) * union - 1e-9


def _sketched(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, sketches = [], [], []
        for text in texts_of(batch):
            values = shingles(text, width)
            counts.append(len(values))
            digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
            sketches.append(sketch(values).tobytes() if len(values) else None)
        yield pa.record_batch(
            {"doc_id": column(batch, "doc_id"), "n_shingles": pa.array(counts, pa.int64()), "digest": pa.array(digests, pa.binary()), "sketch": pa.array(sketches, pa.binary())}
        )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = list_keys(unpacked(column(batch, "sketch").to_pylist()))
            kept = keys.ravel() != 0
            nodes, sizes = (np.repeat(column(batch, name).to_numpy(), BANDS)[kept] for name in ("node", "n_shingles"))
            yield pa.record_batch({"key": pa.array(keys.ravel()[kept]), "node": pa.array(nodes), "size": pa.array(sizes)})


def _estimated(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sketches = (unpacked(column(batch, f"sketch_{side}").to_pylist()) for side in "ab")
            sizes = (column(batch, f"n_{side}").to_numpy() for side in "ab")
            keep = likely(*sketches, *sizes, least)
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _sets(batches: Iterator[pa.RecordBatch], width: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = batch.filter(pa.array(passes(bits, column(batch, "doc_id").to_numpy(zero_copy_only=False))))
        sets = [shingles(text, width).tobytes() for text in texts_of(batch)]
        yield pa.record_batch({"node": column(batch, "doc_id"), "set": pa.array(sets, pa.binary())})


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(column(batch, "set_a").to_pylist(), column(batch, "set_b").to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _cross(left: pa.Table, least: float) -> pa.Table:
    """Likely pairs of a block pair whose members are in different components, each in the first list they share."""
    left = left.sort_by("node")
    node, component, side = (left.column(c).to_numpy() for c in ("node", "component", "side"))
    size = left.column("n_shingles").to_numpy()
    sketches = unpacked(left.column("sketch").to_pylist())
    keys, key = list_keys(sketches), left.column("key")[0].as_py()
    starts = np.flatnonzero(side == 0)
    same_block = left.column("same_block")[0].as_py()
    others = np.arange(len(node)) if same_block else np.flatnonzero(side == 1)
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows in np.array_split(starts, max(1, len(starts) * len(others) // PAIRS)):
        apart = component[rows, None] != component[others]
        apart &= np.minimum(size[rows, None], size[others]) >= least * np.maximum(size[rows, None], size[others])
        if same_block:
            apart &= node[rows, None] < node[others]
        i, j = np.nonzero(apart)
        i, j = rows[i], others[j]
        shared = (keys[i] == keys[j]) & (keys[i] != 0)
        first = keys[i, shared.argmax(1)] == key
        i, j = i[first], j[first]
        near = likely(sketches[i], sketches[j], size[i], size[j], least)
        out_a.append(np.minimum(node[i], node[j])[near])
        out_b.append(np.maximum(node[i], node[j])[near])
    return pa.table({"a": pa.array(np.concatenate(out_a), pa.int64()), "b": pa.array(np.concatenate(out_b), pa.int64())})


class NearDuplicates:
    """The steps of one run; ``components()`` is the result."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> None:
        self.width, self.percent, self.least = width, percent, percent / 100
        python_tasks(docs.sparkSession)
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        schema = "doc_id long, n_shingles long, digest binary, sketch binary"
        self.sketched = stored(self.docs.mapInArrow(partial(_sketched, width=width), schema), "sketches")
        linked = self.sketched.where("doc_id IS NOT NULL AND digest IS NOT NULL")
        classes = linked.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        #: One row for each distinct set, named by its smallest document.
        self.classes = stored(classes.select("node", "n_shingles", "sketch"), "classes")

    def lists(self) -> DataFrame:
        """Members of the inverted lists with two members or more, and the two pivots of the list.

        One pivot is the member that meets the most others in all its lists: what the copies in
        a group were made from is nearer to them than they are to each other. The other is drawn.
        """
        rows = self.classes.mapInArrow(_listed, "key long, node long, size long")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = stored(rows.join(sizes, "key"), "members")
        met = rows.groupBy("node").agg(F.sum("n").alias("met"))
        drawn = F.xxhash64("node")
        pivots = rows.join(met, "node").groupBy("key").agg(F.max(F.struct("met", drawn, "node", "size")).alias("x"), F.min(F.struct(drawn, "node", "size")).alias("y"))
        pivots = pivots.select("key", *(F.struct(f"{p}.node", f"{p}.size").alias(name) for p, name in (("x", "central"), ("y", "drawn"))))
        return stored(rows.drop("n").join(pivots, "key"), "lists")

    def pivot_pairs(self, lists: DataFrame) -> DataFrame:
        """Pairs (a, b) of a member and the pivots of its lists that most of its lists name, PIVOTS of each kind.

        A list's pivot whose size alone rules the similarity out is left out. What these few pairs do not
        link is held against each other afterwards, so no link hangs on the number.
        """
        rows = lists.select("node", "size", F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("central").alias("pivot")), F.struct(F.lit(1).alias("kind"), F.col("drawn").alias("pivot")))))
        larger, smaller = F.greatest("size", "pivot.size"), F.least("size", "pivot.size")
        rows = rows.where(F.col("pivot.node") != F.col("node")).where(100 * smaller >= self.percent * larger)
        named = rows.groupBy("node", "kind", "pivot").agg(F.count(F.lit(1)).alias("n"))
        best = F.slice(F.sort_array(F.collect_list(F.struct("n", "pivot")), asc=False), 1, PIVOTS)
        rows = named.groupBy("node", "kind").agg(best.alias("best")).select("node", F.explode("best.pivot").alias("pivot"))
        return rows.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()

    def candidates(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sketches do not tell that the sets are too far apart."""
        sketches = self.classes.select("node", "n_shingles", "sketch")
        for side in "ab":
            pairs = pairs.join(sketches.toDF(side, f"n_{side}", f"sketch_{side}"), side)
        return stored(pairs.mapInArrow(partial(_estimated, least=self.least), "a long, b long"), "candidates")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Candidates whose whole sets are similar."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        bits = bit_filter(nodes, "node")
        rows = self.docs.where("doc_id IS NOT NULL").mapInArrow(partial(_sets, width=self.width, bits=bits), "node long, set binary")
        sets = rows.join(nodes, "node", "left_semi").distinct()
        for side in "ab":
            pairs = pairs.join(sets.toDF(side, f"set_{side}"), side)
        return stored(pairs.mapInArrow(partial(_verified, percent=self.percent), "a long, b long").distinct(), "edges")

    def apart(self, lists: DataFrame, labels: DataFrame) -> DataFrame:
        """Likely pairs of list members that the labels leave in different components."""
        rows = lists.select("key", "node").join(labels, "node", "left")
        rows = rows.select("key", "node", F.coalesce("label", "node").alias("component"))
        mixed_lists = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n")).where("x <> y")
        rows = rows.join(mixed_lists.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key")
        rows = rows.join(self.classes, "node")
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        rows = rows.withColumn("block", block)
        # each member goes to every pair of blocks that its own block is part of
        others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        rows = rows.select("*", others).select(
            "key", "node", "component", "n_shingles", "sketch",
            F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            (F.col("block") == F.col("other")).alias("same_block"),
        )
        least = self.least

        def cross(members):
            return _cross(members, least)

        return rows.groupBy("key", "first", "second").applyInArrow(cross, "a long, b long").distinct()

    def components(self) -> DataFrame:
        lists = self.lists()
        pairs = stored(self.pivot_pairs(lists), "pairs")
        edges = self.verified(self.candidates(pairs))
        labels = stored(connected(edges), "labels")
        rest = self.apart(lists, labels).join(pairs, ["a", "b"], "left_anti")
        stars = labels.toDF("a", "b")  # the components so far; what is new is linked to them
        # these pairs went through the estimate where they were found
        labels = stored(connected(stars.union(self.verified(stored(rest, "candidates")))), "labels")
        rows = with_group_min(self.sketched.select("doc_id", "n_shingles", "digest").where("doc_id IS NOT NULL"), "digest", "doc_id", "node")
        rows = rows.join(labels, "node", "left").select("doc_id", "n_shingles", F.coalesce("label", "node", "doc_id").alias("component_id"))
        nameless = self.sketched.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
        return rows.union(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents whose shingle sets have ``100 * intersection >= percent * union`` are linked;
    ``component_id`` is the smallest id that links reach. See the module's text for the method
    and for what nulls, empty texts, repeated rows and empty tables give.
    """
    return NearDuplicates(docs, id_col, text_col, width, percent).components()
