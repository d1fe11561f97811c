"""A Merkle manifest of a table: digests of all rows in trees of eight, and proofs that a row belongs.

Leaves. A leaf is the digest of a row's columns, each as ``-`` if null and else as its length in UTF-8
bytes, ``:`` and its value. The rows of a tree (one for each value of a column) stand by id. Their
places come from a range partitioned, sorted, written table: the rows before a partition are counted
for each tree, so a tree with most of the rows is numbered by many tasks.

Trees. Every eight consecutive nodes become one by a grouping on the place div 8, level by level, each
level written once; what remains of a tree is its subroot. The subroots, in order, are the leaves of a
last tree, built the same way, whose remaining node is the root.

Proofs (octopus multiproof). The leaves of a tree are dealt into leaf partitions of up to BLOCK_LEAVES
neighbours. For each partition the coordinates (level, place) of nodes are listed that the proofs of
its leaves need and that neither are its leaves nor follow from them: the union of all paths, without
what is shared. These few coordinates meet the nodes in one join. Each partition then derives the
interior nodes that its leaves share, once, and expands the proof of each leaf from what it holds: the
other nodes of the run, left to right, level by level, through the subroot to the root.

Only digests and ids are shuffled, never texts. A partition's group is of bounded size, however many
rows a tree has; nothing is broadcast by hand.

Defined results: null trees come first, then by UTF-8 bytes; null ids come first in a tree. Rows of one
id stand by their digest. A table of one row has that leaf as its root and an empty proof. Repeated
rows have leaves each, at different places. Empty tables give no rows, and no root. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchyard.functions.expressions import quoted
from branchyard.llm.common import column, python_tasks, stored

#: Nodes that become one.
ARITY = 8
#: Leaves that are proved together.
BLOCK_LEAVES = ARITY**4
#: The tree over the subroots. Others are named n (null) or s and the value, so it stands apart.
TOP = ""


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


# ---- places ---------------------------------------------------------------------------------


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows with their place in their ``tree`` by ``order``, and the size of the tree.

    Equal rows are told apart by where they were read, so that many of them can be dealt out.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ordered = tied.repartitionByRange("tree", *order, "_tie").sortWithinPartitions("tree", *order, "_tie").drop("_tie")
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = stored(ordered.withColumns({"_part": F.spark_partition_id(), "_row": in_part}), name)
    parts = ordered.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_rows").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "_part", (before - F.col("_first")).alias("_start"), F.sum("_rows").over(tree).alias("size"))
    return ordered.join(parts, ["tree", "_part"]).withColumn("place", F.col("_row") + F.col("_start")).drop("_part", "_row", "_start")


# ---- trees ----------------------------------------------------------------------------------


def levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """(tree, size, place, digest) of all nodes, by level; ``size`` is the number of nodes of the tree's level."""
    out = [leaves.select("tree", "size", "place", "digest")]
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        runs = out[-1].where("size > 1").groupBy("tree", F.floor(F.col("place") / ARITY).alias("place"))
        run = F.array_sort(F.collect_list(F.struct("place", "digest")))
        nodes = runs.agg(F.ceil(F.first("size") / ARITY).alias("size"), F.sha2(F.array_join(F.transform(run, lambda x: x["digest"]), ""), 256).alias("digest"))
        out.append(stored(nodes.select("tree", "size", "place", "digest"), name))
        most = -(-most // ARITY)
    return out


def union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# ---- proofs ---------------------------------------------------------------------------------


def run_of(place: int, size: int) -> range:
    """The places of the nodes that become one with the node at ``place``."""
    first = place - place % ARITY
    return range(first, min(first + ARITY, size))


def missing_nodes(places: Sequence[int], size: int) -> list[tuple[int, int]]:
    """(level, place) of the fewest nodes that, with the leaves at ``places``, give all their proofs."""
    known, level, out = set(places), 0, []
    while size > 1:
        parents = {place // ARITY for place in known}
        out += [(level, at) for parent in sorted(parents) for at in run_of(parent * ARITY, size) if at not in known]
        known, level, size = parents, level + 1, -(-size // ARITY)
    return out


def _missing(batches):
    schema = pa.list_(pa.struct([("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64())]))
    for batch in batches:
        wanted = []
        for row in batch.to_pylist():
            for tree, places, size in ((row["tree"], row["places"], row["size"]), (TOP, [row["top_place"]], row["top_size"])):
                wanted.append([{"tree": tree, "level": level, "place": place} for level, place in missing_nodes(places, size)])
        lists = [a + b for a, b in zip(wanted[::2], wanted[1::2])]
        kept = batch.select(["tree", "block", "top_place", "top_size", "subroot"])
        yield kept.append_column("wanted", pa.array(lists, schema))


MISSING = "tree string, block long, top_place long, top_size long, subroot string, wanted array<struct<tree:string,level:int,place:long>>"


class Paths:
    """The nodes of one tree that a partition holds or derives, and the way from each to the end."""

    def __init__(self, size: int, nodes: dict[tuple[int, int], str], leaves: dict[int, str]) -> None:
        self.sizes = [size]
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // ARITY))
        self.nodes = nodes
        known = dict(leaves)
        for level, n in enumerate(self.sizes):
            self.nodes.update({(level, place): digest for place, digest in known.items()})
            if n > 1:
                runs = {place // ARITY: run_of(place, n) for place in known}
                known = {up: sha256("".join(self.nodes[level, at] for at in run)) for up, run in runs.items()}
        self.ways: dict[tuple[int, int], tuple] = {}

    def end(self) -> str:
        return self.nodes[len(self.sizes) - 1, 0]

    def way(self, level: int, place: int) -> tuple[str, tuple[tuple[str, str], ...]]:
        """The other nodes from here on as one text, and at each level those to the left and to the right."""
        if level == len(self.sizes) - 1:
            return "", ()
        if (level, place) not in self.ways:
            run = run_of(place, self.sizes[level])
            left = "".join(self.nodes[level, at] for at in run if at < place)
            right = "".join(self.nodes[level, at] for at in run if at > place)
            text, sides = self.way(level + 1, place // ARITY)
            way = left + right + text, ((left, right), *sides)
            if not level:
                return way  # one leaf's alone
            self.ways[level, place] = way
        return self.ways[level, place]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _expanded(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    names = ("subroot", "root", "proof_sha256", "folded_root")
    rows, found = leaves.to_pylist(), fetched.to_pylist()
    out = defaultdict(list)
    if rows:
        own, top = {}, {}
        for node in found:
            if node["level"] is not None:
                (top if node["node_tree"] == TOP else own)[node["level"], node["place"]] = node["digest"]
        inner = Paths(rows[0]["size"], own, {row["place"]: row["digest"] for row in rows})
        outer = Paths(found[0]["top_size"], top, {found[0]["top_place"]: found[0]["subroot"]})
        rest, rest_sides = outer.way(0, found[0]["top_place"])
        for row in rows:
            text, sides = inner.way(0, row["place"])
            folded = row["digest"] if row["changed"] is None else row["changed"]
            for left, right in (*sides, *rest_sides):
                folded = sha256(left + folded + right)
            for name, value in zip(names, (inner.end(), outer.end(), sha256(text + rest), folded)):
                out[name].append(value)
    shown = leaves.select(["tree", "place", "id", "digest"]).rename_columns(["tree", "place", "id", "leaf"])
    for name in names:
        shown = shown.append_column(name, pa.array(out[name], pa.string()))
    return shown


EXPANDED = "tree string, place long, id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def proofs(leaves: DataFrame, nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """The proof of each of ``leaves``, which may be some of all, folded from ``changed`` where that is not null.

    leaves: tree, size, place, id, digest, changed; nodes: tree, level, place, digest of all trees;
    tops: tree, digest, place, size of the subroots in the tree over them.
    """
    leaves = leaves.withColumn("block", F.floor(F.col("place") / BLOCK_LEAVES))
    blocks = leaves.groupBy("tree", "block").agg(F.first("size").alias("size"), F.collect_list("place").alias("places"))
    over = tops.select("tree", F.col("place").alias("top_place"), F.col("size").alias("top_size"), F.col("digest").alias("subroot"))
    blocks = blocks.join(over, "tree").mapInArrow(_missing, MISSING)
    wanted = blocks.select("tree", "block", "top_place", "top_size", "subroot", F.explode_outer("wanted").alias("w"))
    wanted = wanted.select("*", F.col("w.tree").alias("node_tree"), F.col("w.level").alias("level"), F.col("w.place").alias("place")).drop("w")
    named = nodes.select(F.col("tree").alias("node_tree"), "level", "place", "digest")
    fetched = wanted.join(named, ["node_tree", "level", "place"], "left")
    return leaves.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(_expanded, EXPANDED)


def merkle_proofs(
    rows: DataFrame, values: Sequence[str], changed: dict[str, Column] | None = None, *, where: Column | None = None, id_col: str = "doc_id", tree_col: str = "lang"
) -> DataFrame:
    """(tree, place, id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``values`` are the columns of a leaf. ``changed`` replaces some of them in the rows for which
    ``where`` holds, as if they had been tampered with after the manifest was made: ``folded_root`` is
    what the changed leaf and the original proof give, and ``verified`` says whether that is the root.
    """
    python_tasks(rows.sparkSession)
    columns = {name: F.col(quoted(name)) for name in values}
    other = row_digest([(changed or {}).get(name, value) for name, value in columns.items()])
    tampered = F.lit(False) if where is None or not changed else where
    tree = F.col(quoted(tree_col)).cast("string")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("s"), tree), F.lit("n")).alias("tree"), F.col(quoted(id_col)).cast("long").alias("id"),
        row_digest(list(columns.values())).alias("digest"), F.when(tampered, other).alias("changed"),
    )
    leaves = stored(leaves, "digests")  # finding the ranges reads the rows twice, but no text
    leaves = stored(numbered(leaves, ["id", "digest"], "leaves"), "placed")
    inner = levels(leaves, "nodes")
    subroots = union([level.where("size = 1") for level in inner]).select("tree", "digest")
    tops = stored(numbered(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest"), ["of"], "subroots"), "tops")
    outer = levels(tops, "top-nodes")
    nodes = union([level.select("tree", F.lit(k).alias("level"), "place", "digest") for trees in (inner, outer) for k, level in enumerate(trees)])
    out = proofs(leaves, nodes, tops.select(F.col("of").alias("tree"), "digest", "place", "size"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
