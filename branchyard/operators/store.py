"""The store: refs over tables, all kept as Parquet below one folder.

    ledger/ref=<ref>/seq=<n>/       one short row, the n-th move of a ref
    commits/<hash>/                 one row per commit
    contents/<id>/                  one row per table version
    data/table=<id>/_batch=<id>/    the rows, never changed after the write
    deletes/table=<id>/_delete=<id>/  keys of deleted rows, with the batch of each
    marks/table=<id>/_delete=<id>/  places of deleted rows, as bits
    staging/<name>/                 unversioned tables, seen from every ref
    streams/<lane>/<table>/<name>/  checkpoints of streams into a ref

A move is a folder of its own, named by its number, that gets its name by a rename which
never overwrites. Of writers that meet, one publishes; the others get ``StaleHead``.
"""

from __future__ import annotations

import re
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from branchyard.errors import AlreadyExists, StaleHead, UnknownRef, UnknownTable
from branchyard.functions.expressions import quoted
from branchyard.operators import ledger as lg
from branchyard.operators import merge as mg
from branchyard.operators.content import CONTENT_SCHEMA, PLACE, Content, Delete, partition_name, partition_of, struct_of
from branchyard.operators.tables import RefTables
from branchyard.session import names_in, no_rows, publish_folder, rows_frame

REF_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
COMMIT_HASH = re.compile(r"[0-9a-f]{64}")
#: metadata rows that a store object keeps of each kind
KEPT = 1000
#: rows whose marks are one row, a bit each
MARKED = 32_768
#: ways of reading a version's batches, by the deletes that name them, before those are brought together
READS = 4
MARKS_SCHEMA = "_batch string, file string, block bigint, bits binary"
PLACE_TYPE = StructType().add("file", "string").add("row", "long")
TABLE_KEY = re.compile(r"[A-Za-z0-9_]+\.[A-Za-z0-9_]+")


def keep(known: OrderedDict, name: str, value):
    """Remember a metadata row; the oldest of more than ``KEPT`` goes."""
    known[name] = value
    if len(known) > KEPT:
        known.popitem(last=False)
    return value


def _placed(rows: DataFrame) -> DataFrame:
    """Rows just read, with the place of each."""
    at = rows.metadataColumn("_metadata")
    return rows.select("*", F.struct(at["file_name"].alias("file"), at["row_index"].alias("row")).alias(PLACE))


def _held(rows: DataFrame, marks: DataFrame, there: bool) -> DataFrame:
    """The rows whose places are marked, or those whose places are not."""
    # four bytes of marks a number, made once for a block
    word = lambda n: F.conv(F.hex(F.substring(F.col("bits"), 4 * n + 1, F.lit(4))), 16, 10).cast("bigint")
    marks = marks.withColumn("bits", F.transform(F.sequence(F.lit(0), F.lit(MARKED // 32 - 1)), word))
    file, row, bits = F.col(f"r.{quoted(PLACE)}.file"), F.col(f"r.{quoted(PLACE)}.row"), F.col("m.bits")
    same = (F.col("r._batch") == F.col("m._batch")) & (file == F.col("m.file")) & (F.shiftright(row, MARKED.bit_length() - 1) == F.col("m.block"))
    at = row.bitwiseAND(MARKED - 1).cast("int")
    marked = F.bit_get(bits[F.shiftright(at, 5)], 24 - at.bitwiseAND(24) + at.bitwiseAND(7)) == 1
    both = rows.alias("r").join(marks.alias("m"), same, "inner" if there else "left")
    return both.where(marked if there else bits.isNull() | ~marked).select("r.*")


class BranchStore:
    """The store at ``root``; ``BranchStore.start`` makes a new one.

    ``path_limit``: a table version of up to this many batches is read by naming
    its folders; a longer list stays in Spark and is joined.
    ``broadcast_limit``: that join broadcasts the list only up to this many
    batches (an id is about 40 bytes); beyond it Spark chooses the join.
    ``marks_limit``: marks of deleted rows are broadcast up to this many blocks of 8 KB, each
    for 32,768 rows of touched files; beyond it Spark chooses the join.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        default: str = "main",
        path_limit: int = 1000,
        broadcast_limit: int = 500_000,
        marks_limit: int = 10_000,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.default = default
        self.path_limit = path_limit
        self.broadcast_limit = broadcast_limit
        self.marks_limit = marks_limit
        self._contents: OrderedDict[str, Content] = OrderedDict()
        self._commits: OrderedDict[str, dict] = OrderedDict()
        self._n_marks: OrderedDict[str, int] = OrderedDict()
        #: of streams: the last move looked at, and the last number published
        self.stream_numbers: dict[tuple[str, str], tuple[int, int | None]] = {}
        #: session views that create_views made: for each ref, and under "" of the current ref
        self.views: dict[str, list[str]] = {}

    @classmethod
    def start(cls, spark: SparkSession, root: str, default: str = "main", **options) -> BranchStore:
        """A new store with an empty default ref; an error if there is one already."""
        store = cls(spark, root, default, **options)
        first = lg.new_commit([], f"{default}.0", 0, "start", {})
        store.save_commit(first)
        if store.last_move(default) is not None:
            raise AlreadyExists(f"a store at {root}")
        store._add_move(lg.next_move(default, None, "started", first["hash"]))
        return store

    # ---- reading the metadata -------------------------------------------------

    def ledger(self) -> DataFrame:
        """All moves of all refs; a filter on ``ref`` reads only that ref's files."""
        return self.spark.read.schema(lg.MOVE_SCHEMA).parquet(f"{self.root}/ledger")

    def moves(self, ref: str) -> DataFrame:
        """All moves of one ref, listing only its own folder."""
        ledger = f"{self.root}/ledger"
        files = self.spark.read.schema(lg.MOVE_SCHEMA).option("basePath", ledger)
        return self._found(lambda: files.parquet(f"{ledger}/ref={ref}"), ref)

    def move(self, ref: str, seq: int) -> dict:
        """The move of a ref with that number; opens its one file."""
        ledger = f"{self.root}/ledger"
        files = self.spark.read.schema(lg.MOVE_SCHEMA).option("basePath", ledger)
        return files.parquet(f"{ledger}/ref={ref}/seq={seq}").first().asDict()

    def last_move(self, ref: str) -> dict | None:
        """The last move of a ref, also if it says that the ref is dropped; None if it has none.

        The folders' names say which it is, so however many there are, one file is opened.
        """
        names = names_in(self.spark, f"{self.root}/ledger/ref={ref}")
        numbers = [int(name.removeprefix("seq=")) for name in names if name.startswith("seq=")]
        return self.move(ref, max(numbers)) if numbers else None

    def commits(self) -> DataFrame:
        """Every commit, also of dropped refs."""
        files = self.spark.read.schema(lg.COMMIT_SCHEMA).option("recursiveFileLookup", True)
        return files.parquet(f"{self.root}/commits")

    def commit_rows(self, hashes: Iterable[str]) -> DataFrame:
        """Some commits by hash, read from their own folders."""
        paths = [f"{self.root}/commits/{name}" for name in sorted(set(hashes))]
        files = self.spark.read.schema(lg.COMMIT_SCHEMA)
        return self._found(lambda: files.parquet(*paths), ", ".join(sorted(set(hashes))))

    def commits_of(self, hashes: Iterable[str]) -> dict[str, dict]:
        """Some commits by hash. They never change, so a known one is not read again."""
        commits = {name: self._commits.get(name) for name in hashes}
        unknown = sorted(name for name, commit in commits.items() if commit is None)
        if unknown:
            for row in self.commit_rows(unknown).collect():
                commits[row["hash"]] = keep(self._commits, row["hash"], row.asDict(recursive=True))
        return commits

    def commit_of_lane(self, lane: str, pos: int) -> dict:
        """The commit made at a position of a lane, found through its ref's moves."""
        ref = lane.rpartition(".")[0]
        return self.state(self.move(ref, pos)["hash"])

    def history(self, seen: dict[str, dict]) -> DataFrame:
        """The commits that a state with this ``seen`` includes, itself among them."""
        return self.commits().filter(lg.included_in(seen))

    @staticmethod
    def _found(read: Callable[[], DataFrame], name: str) -> DataFrame:
        try:
            return read()
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                raise UnknownRef(name) from None
            raise

    def _or_empty(self, read: Callable[[], DataFrame], schema: str) -> DataFrame:
        """What a folder holds, or no rows while nothing was written to it yet."""
        try:
            return read()
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return rows_frame(self.spark, [], schema)
            raise

    def ref_state(self, ref: str) -> dict:
        """Where a live ref points: its last move together with the commit."""
        if not REF_NAME.fullmatch(ref):
            raise ValueError(f"not a ref name: {ref!r}")
        move = self.last_move(ref)
        if move is None or move["action"] == "dropped":
            raise UnknownRef(ref)
        return {**self.commits_of([move["hash"]])[move["hash"]], **move}

    def state(self, name: str) -> dict:
        """Where a ref points now, or the commit of that hash."""
        if not COMMIT_HASH.fullmatch(name):
            return self.ref_state(name)
        return {"ref": name, **self.commits_of([name])[name]}

    def live_states(self) -> list[dict]:
        """The state of every live ref; one row per ref."""
        moves = [row.asDict() for row in lg.latest_per_ref(self.ledger()).collect()]
        commits = self.commits_of({move["hash"] for move in moves})
        return [{**commits[move["hash"]], **move} for move in moves]

    def content_rows(self, ids: Iterable[str]) -> DataFrame:
        """The version rows of these content ids, read from their own folders."""
        paths = [f"{self.root}/contents/{i}" for i in sorted(set(ids))]
        if not paths:
            return rows_frame(self.spark, [], CONTENT_SCHEMA)
        return self.spark.read.schema(CONTENT_SCHEMA).parquet(*paths)

    def all_contents(self) -> DataFrame:
        """Every version row ever written."""
        files = self.spark.read.schema(CONTENT_SCHEMA).option("recursiveFileLookup", True)
        return self._or_empty(lambda: files.parquet(f"{self.root}/contents"), CONTENT_SCHEMA)

    def stored_rows(self) -> DataFrame:
        """table, _batch for each row of every batch; reads footers only."""
        schema = "table string, _batch string"
        return self._or_empty(lambda: self.spark.read.schema(schema).parquet(f"{self.root}/data"), schema)

    def stored_files(self) -> DataFrame:
        """table, _batch, length of every data file, from the listing alone."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        listed = self._or_empty(
            lambda: files.load(f"{self.root}/data"), "table string, _batch string, length bigint"
        )
        return listed.select("table", "_batch", "length")

    def content_of(self, content_id: str) -> Content:
        """One version; versions never change, so a known one is not read again."""
        return self.contents_of([content_id])[0]

    def contents_of(self, ids: Iterable[str]) -> list[Content]:
        """Several versions, the unknown ones from a single read."""
        contents = {i: self._contents.get(i) for i in sorted(set(ids))}
        unknown = [i for i, content in contents.items() if content is None]
        if unknown:
            short = F.when(F.col("n_batches") <= self.path_limit, F.col("batches"))
            for row in self.content_rows(unknown).withColumn("batches", short).collect():
                contents[row["content_id"]] = keep(self._contents, row["content_id"], Content.from_row(row))
        return list(contents.values())

    def content_at(self, state: dict, key: str) -> Content:
        content_id = state["tables"].get(key)
        if content_id is None or content_id == lg.NAMESPACE:
            raise UnknownTable(f"{key} at {state['ref']}")
        return self.content_of(content_id)

    # ---- writing the metadata -------------------------------------------------

    def _add_move(self, move: dict) -> None:
        """The publishing step: the ref now points at the commit of the move.

        ``StaleHead`` if the ref already made a move of that number.
        """
        frame = rows_frame(self.spark, [move], lg.MOVE_SCHEMA).drop("ref", "seq")
        written = f"{self.root}/unpublished/{uuid.uuid4().hex}"
        frame.write.parquet(written)
        if not publish_folder(self.spark, written, f"{self.root}/ledger/ref={move['ref']}/seq={move['seq']}"):
            raise StaleHead(f"{move['ref']} moved meanwhile")

    def save_commit(self, commit: dict) -> None:
        """Write a commit before a move points at it."""
        frame = rows_frame(self.spark, [commit], lg.COMMIT_SCHEMA)
        frame.write.mode("overwrite").parquet(f"{self.root}/commits/{commit['hash']}")
        keep(self._commits, commit["hash"], commit)

    def save_content(
        self, new: Content, old: Content | None = None, added: Sequence[str] = (), lists: DataFrame | None = None
    ) -> str:
        """Write a version row before a commit names it.

        A long batch list never comes to the driver: the new row is derived in
        Spark from the row of ``old``, plus the batches ``added``, or gets the one row of ``lists``.
        """
        content_id = new.content_id
        if new.batches is None:
            batches = F.col("batches")
            if added:
                batches = F.concat(batches, F.array(*map(F.lit, added)))
            frame = rows_frame(self.spark, [new.as_row()], CONTENT_SCHEMA).drop("batches")
            if lists is None:
                lists = self.content_rows([old.content_id]).select(batches.alias("batches"))
            frame = frame.withColumn("one", F.lit(1)).join(lists.withColumn("one", F.lit(1)), "one").drop("one")
        else:
            frame = rows_frame(self.spark, [new.as_row()], CONTENT_SCHEMA)
        frame.write.mode("overwrite").parquet(f"{self.root}/contents/{content_id}")
        if new.n_batches <= self.path_limit:
            keep(self._contents, content_id, new)
        return content_id

    def save_listed(self, content: Content, lists: DataFrame) -> Content:
        """A saved version of the content's table with the batches of ``lists`` (column _batch).

        The digest is combined in Spark; only a list of up to ``path_limit`` batches is held here.
        """
        parts = [F.bit_xor(F.conv(F.substring(F.sha2("_batch", 256), 8 * k + 1, 8), 16, 10).cast("bigint")) for k in range(8)]
        row = lists.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.coalesce(p, F.lit(0)) for p in parts]).alias("digest")).first()
        new = replace(content, n_batches=row["n"], digest="".join(f"{p:08x}" for p in row["digest"]), batches=None)
        if row["n"] <= self.path_limit:
            new = replace(new, batches=tuple(sorted(r["_batch"] for r in lists.collect())))
        self.save_content(new, lists=lists.agg(F.sort_array(F.collect_list("_batch")).alias("batches")))
        return new

    def commit(
        self,
        ref: str,
        message: str,
        changes: dict[str, str | None],
        base: dict | None = None,
        expected_hash: str | None = None,
        now: dict | None = None,
        **more,
    ) -> str:
        """Put or remove table keys in one commit on top of the ref's head.

        ``changes`` maps a key to a content id, or to None to remove it. ``base``
        is the state that a longer work began from: a key that moved since raises
        ``StaleHead``. With ``expected_hash`` any move raises. ``now`` is the
        ref's state if the caller has only just read it.
        """
        now = now or self.ref_state(ref)
        if expected_hash is not None and now["hash"] != expected_hash:
            raise StaleHead(f"{ref} is at {now['hash']}, not at {expected_hash}")
        if base is not None and base["hash"] != now["hash"]:
            moved = [k for k in changes if base["tables"].get(k) != now["tables"].get(k)]
            if moved or base["ref_lane"] != now["ref_lane"]:
                raise StaleHead(f"{ref} moved; changed meanwhile: {moved}")
        tables = {**now["tables"], **changes}
        tables = {key: value for key, value in tables.items() if value is not None}
        commit = lg.new_commit([now], now["ref_lane"], now["seq"] + 1, message, tables)
        self.save_commit(commit)
        self._add_move(lg.next_move(ref, now, "committed", commit["hash"], **more))
        return commit["hash"]

    # ---- refs -------------------------------------------------------------------

    def default_ref(self) -> str:
        return self.default

    def head(self, ref: str) -> str:
        """Hash of the commit that the ref points at."""
        return self.ref_state(ref)["hash"]

    def list_refs(self) -> DataFrame:
        """ref_type, name, hash of every live ref."""
        return lg.latest_per_ref(self.ledger()).select("ref_type", F.col("ref").alias("name"), "hash")

    def _ref_row(self, name: str, commit_hash: str) -> DataFrame:
        row = {"ref_type": "Branch", "name": name, "hash": commit_hash}
        return rows_frame(self.spark, [row], "ref_type string, name string, hash string")

    def create_ref(self, name: str, source: str | None = None, at: str | None = None) -> DataFrame:
        """A new ref at the source's head, or at an older commit of it. Copies no rows."""
        if not REF_NAME.fullmatch(name) or COMMIT_HASH.fullmatch(name):
            raise ValueError(f"not a ref name: {name!r}")
        last = self.last_move(name)
        if last is not None and last["action"] != "dropped":
            raise AlreadyExists(name)
        state = self.ref_state(source or self.default)
        if at is not None and at != state["hash"]:
            commit = self.state(at)
            if not lg.includes(state, commit):
                raise UnknownRef(f"{at} is not in the history of {state['ref']}")
            state = commit
        self._add_move(lg.next_move(name, last, "created", state["hash"]))
        return self._ref_row(name, state["hash"])

    def drop_ref(self, name: str) -> None:
        """The ref is gone; its batches stay until nothing reaches them."""
        if name == self.default:
            raise ValueError("the default ref cannot be dropped")
        last = self.ref_state(name)
        self._add_move(lg.next_move(name, last, "dropped", last["hash"]))

    def merge_ref(
        self,
        source: str,
        into: str | None = None,
        message: str | None = None,
        by_key: dict[str, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Publish all tables of ``source`` on ``into`` in one move.

        ``by_key`` names the key columns of tables that may be merged row by row
        if both sides changed their rows. Columns are merged by themselves: what one side
        added, renamed, widened or dropped goes with what the other did. Any conflict left
        publishes nothing.
        """
        target = into or self.default
        commit_hash = mg.merge_ref(self, source, target, message, by_key or {})
        return self._ref_row(target, commit_hash)

    def at(self, ref: str) -> RefTables:
        """The tables of one ref (or, to read only, of one commit)."""
        return RefTables(self, ref)

    def create_namespace(self, name: str, ref: str | None = None, if_not_exists: bool = True) -> None:
        """Put a namespace key; a repeat changes nothing."""
        ref = ref or self.default
        if not re.fullmatch(r"[A-Za-z0-9_]+", name):
            raise ValueError(f"not a namespace name: {name!r}")
        state = self.ref_state(ref)
        if name in state["tables"]:
            if not if_not_exists:
                raise AlreadyExists(name)
            return
        self.commit(ref, f"create namespace {name}", {name: lg.NAMESPACE}, now=state)

    def list_namespaces(self) -> DataFrame:
        """ref, namespace for every live ref."""
        rows = [
            {"ref": state["ref"], "namespace": key}
            for state in self.live_states()
            for key, content_id in state["tables"].items()
            if content_id == lg.NAMESPACE
        ]
        return rows_frame(self.spark, rows, "ref string, namespace string")

    # ---- tables -----------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        """``ns.table`` at the default ref, or ``ns.table@ref``."""
        key, _, ref = name.partition("@")
        return self.at(ref or self.default).table(key)

    def new_table(self, key: str, schema: StructType, state: dict, partitioned_by: str | None = None) -> Content:
        if not TABLE_KEY.fullmatch(key):
            raise ValueError(f"a table is named namespace.table, not {key!r}")
        namespace = key.partition(".")[0]
        if state["tables"].get(namespace) != lg.NAMESPACE:
            raise UnknownTable(f"no namespace {namespace} at {state['ref']}")
        return Content.empty(schema, partitioned_by)

    def batch_path(self, table_id: str, batch: str) -> str:
        return f"{self.root}/data/table={table_id}/_batch={batch}"

    def delete_path(self, table_id: str, delete: str) -> str:
        return f"{self.root}/deletes/table={table_id}/_delete={delete}"

    def marks_path(self, table_id: str, delete: str) -> str:
        return f"{self.root}/marks/table={table_id}/_delete={delete}"

    def write_marks(self, table_id: str, delete: str) -> str:
        """Mark the places that a written delete names; the folder of the marks."""
        kinds = f"_batch string, `{PLACE}` struct<file:string,row:bigint>"
        rows = self.spark.read.schema(kinds).parquet(self.delete_path(table_id, delete))
        place, path = F.col(quoted(PLACE)), self.marks_path(table_id, delete)
        block = F.shiftright(place["row"], MARKED.bit_length() - 1).alias("block")
        rows = rows.select("_batch", place["file"].alias("file"), block, (place["row"] % MARKED).alias("at"))
        rows.groupBy("_batch", "file", "block").agg(F.bitmap_construct_agg("at").alias("bits")).write.parquet(path)
        return path

    def marks(self, table_id: str, deletes: Sequence[Delete]) -> DataFrame:
        """_batch, file, block, bits: which rows of a block of a file one of the deletes names."""
        paths = {d.id: self.marks_path(table_id, d.id) for d in deletes}
        rows = self.spark.read.schema(MARKS_SCHEMA).parquet(*paths.values())
        if len(paths) > 1:
            rows = rows.groupBy("_batch", "file", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        known = self._n_marks
        for name, path in paths.items():
            if name not in known:
                keep(known, name, self.spark.read.schema(MARKS_SCHEMA).parquet(path).count())
        n_blocks = sum(self._n_marks.get(name, self.marks_limit + 1) for name in paths)
        return F.broadcast(rows) if n_blocks <= self.marks_limit else rows

    def write_batch(self, content: Content, df: DataFrame, batch: str, mode: str = "errorifexists") -> list[str]:
        """Write rows by position under the version's columns; the names of the batches made.

        Spark's own rules for storing into a declared schema apply: a wrong
        number of columns or a type that does not fit is an error. The write
        keeps the partitions of ``df``; it adds no shuffle. Rows of a partitioned table are
        first brought together by partition, large partitions in several tasks, and become
        one batch for each partition value, none if there are no rows.
        """
        rows = df.toDF(*content.schema.names).to(content.schema).toDF(*content.file_schema.names)
        if content.partition is None:
            rows.write.mode(mode).parquet(self.batch_path(content.table_id, batch))
            return [batch]
        value = F.expr(content.partition).cast("string")
        odd = F.replace(F.replace(F.replace(F.url_encode(value), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%"), F.lit("!"))
        name = F.concat(F.lit(f"{batch}~"), F.coalesce(F.concat(F.lit("v"), odd), F.lit("n")))
        folder = f"{self.root}/data/table={content.table_id}"
        rows.withColumn("_batch", name).hint("rebalance", "_batch").write.mode("append").partitionBy("_batch").parquet(folder)
        return sorted(n.removeprefix("_batch=") for n in names_in(self.spark, folder, f"_batch={batch}~*"))

    def batch_list(self, content: Content) -> DataFrame:
        """The batch ids of one version, one per row."""
        if content.batches is not None:
            return rows_frame(self.spark, [{"_batch": b} for b in content.batches], "_batch string")
        rows = self.content_rows([content.content_id]).filter(F.col("content_id") == content.content_id)
        return rows.select(F.explode("batches").alias("_batch"))

    def scan(
        self,
        content: Content,
        without: Content | None = None,
        partitions: Sequence | None = None,
        with_batch: bool = False,
        with_place: bool = False,
    ) -> DataFrame:
        """Rows of a version, lazily.

        ``without`` leaves out batches that another version has with the same rows deleted, and where
        both versions' deletes are marked, also rows that the other has of batches with other rows deleted:
        what two versions leave out of each other is the same. ``partitions`` names the only partition
        values to read. Batches are settled before a folder is listed. Only batches that a delete names
        are held against deleted rows, and only against those deletes. ``with_place`` shows where a row is.
        """
        skip = without if without is not None and without.table_id == content.table_id else None
        names = None if partitions is None else {partition_name(value) for value in partitions}
        if names is not None and content.partition is None:
            raise ValueError("the table is not partitioned")
        shown = [F.col(quoted(file)).alias(name) for name, _, file in content.columns]
        shown += [F.col("_batch")] if with_batch else []
        shown += [F.col(quoted(PLACE))] if with_place else []
        if content.batches is not None and (skip is None or skip.batches is not None):
            theirs = {} if skip is None else {b: skip.deletes_of(b) for b in skip.batches}
            groups: dict[tuple, list[str]] = {}
            for batch in content.batches:
                mine = content.deletes_of(batch)
                if theirs.get(batch) == mine or names is not None and partition_of(batch) not in names:
                    continue
                only = theirs.get(batch) if self._marked(content, batch) and skip and self._marked(skip, batch) else None
                if only is None or only:
                    groups.setdefault((mine, only), []).append(batch)
            if len(groups) > READS:
                wide: dict[tuple, list[str]] = {}
                for (mine, only), batches in groups.items():
                    wide.setdefault((bool(mine), only is not None), []).append((mine, only or (), batches))
                groups = {
                    (frozenset().union(*[m for m, _, _ in parts]), frozenset().union(*[o for _, o, _ in parts]) if both else None): [b for _, _, bs in parts for b in bs]
                    for (_, both), parts in wide.items()
                }
            frames = [self._shown(content, skip, mine, only, batches, with_batch, with_place).select(shown) for (mine, only), batches in groups.items()]
            if not frames:
                nothing = content.schema.add("_batch", "string") if with_batch else content.schema
                return no_rows(self.spark, nothing.add(PLACE, PLACE_TYPE) if with_place else nothing)
            return reduce(DataFrame.union, frames)
        wanted = self.batch_list(content)
        if names is not None:
            wanted = wanted.where(F.substring_index("_batch", "~", -1).isin(sorted(names)))
        if skip is not None:
            other = set(content.deletes) ^ set(skip.deletes)
            if all(d.batches is not None for d in other):
                changed = sorted({b for d in other for b in d.batches})
                wanted = wanted.join(self.batch_list(skip).where(~F.col("_batch").isin(changed)), "_batch", "left_anti")
        if content.n_batches <= self.broadcast_limit:
            wanted = F.broadcast(wanted)
        root = f"{self.root}/data/table={content.table_id}"
        rows = self.spark.read.schema(self._read_schema(content).add("_batch", "string")).parquet(root)
        return self._left(content, content.deletes, _placed(rows).join(wanted, "_batch", "left_semi")).select(shown)

    @staticmethod
    def _marked(content: Content, batch: str) -> bool:
        return all(d.marked for d in content.deletes if d.touches(batch))

    def _shown(self, content, skip, mine, only, batches: list[str], with_batch: bool, with_place: bool) -> DataFrame:
        """Rows of batches that none of the deletes ``mine`` names; of these, if given, those that one of ``only`` names."""
        rows = self._read(content, batches, with_batch or bool(mine or only))
        rows = _placed(rows) if with_place or mine or only else rows
        rows = self._left(content, [d for d in content.deletes if d.id in mine], rows)
        if only:
            rows = self.marked_rows(content, [d for d in skip.deletes if d.id in only], rows)
        return rows

    def _read_schema(self, content: Content) -> StructType:
        """The version's columns and those that only its deletes still name, by their names in the files."""
        kinds = {file: kind for d in content.deletes for file, kind in d.keys} | {file: kind for _, kind, file in content.columns}
        return struct_of(list(kinds.items()))

    def _read(self, content: Content, batches: Sequence[str], with_batch: bool) -> DataFrame:
        paths = [self.batch_path(content.table_id, batch) for batch in batches]
        if not with_batch:
            return self.spark.read.schema(content.file_schema).parquet(*paths)
        schema = self._read_schema(content).add("_batch", "string")
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data/table={content.table_id}").parquet(*paths)

    def deleted_keys(self, content: Content, deletes: Sequence[Delete], with_id: bool = False) -> DataFrame:
        """_batch and the keys k0, k1 .. of deletes that have the same key columns; with their ids as _delete."""
        kinds = {file: kind for _, kind, file in content.columns}
        columns = [(file, kinds.get(file, kind)) for file, kind in deletes[0].keys]
        paths = [self.delete_path(content.table_id, d.id) for d in deletes]
        schema, reader = struct_of(columns).add("_batch", "string"), self.spark.read
        if with_id:
            schema, reader = schema.add("_delete", "string"), reader.option("basePath", f"{self.root}/deletes/table={content.table_id}")
        files = reader.schema(schema).parquet(*paths)
        return files.select("_batch", *["_delete"] * with_id, *[F.col(quoted(file)).alias(f"k{n}") for n, (file, _) in enumerate(columns)])

    def _left(self, content: Content, deletes: Sequence[Delete], rows: DataFrame) -> DataFrame:
        """The rows that no delete names: by their places, or one anti join for each set of key columns, by batch and keys."""
        marked = [d for d in deletes if d.marked]
        if marked:
            rows = _held(rows, self.marks(content.table_id, marked), there=False)
        by_keys: dict[tuple, list[Delete]] = {}
        for delete in deletes:
            if not delete.marked:
                by_keys.setdefault(tuple(file for file, _ in delete.keys), []).append(delete)
        for files, named in by_keys.items():
            gone = self.deleted_keys(content, named)
            same = [F.col(f"r.{quoted(file)}").eqNullSafe(F.col(f"g.k{n}")) for n, file in enumerate(files)]
            rows = rows.alias("r").join(gone.alias("g"), reduce(and_, [F.col("r._batch") == F.col("g._batch"), *same]), "left_anti")
        return rows

    def marked_rows(self, content: Content, deletes: Sequence[Delete], rows: DataFrame) -> DataFrame:
        """Those of some rows of a table, with batch and place, that one of the deletes names."""
        return _held(rows, self.marks(content.table_id, deletes), there=True)

    # ---- staging ------------------------------------------------------------------

    def load_staging(self, name: str, rows: DataFrame) -> DataFrame:
        """Replace an unversioned table, seen from every ref, with these rows."""
        path = f"{self.root}/staging/{quote(name)}"
        rows.write.mode("overwrite").parquet(path)
        return self.staging(name)

    def staging(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/staging/{quote(name)}")
