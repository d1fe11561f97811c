"""What one version of a table consists of: its columns, its batches, and rows deleted from them.

A batch is one folder of Parquet files that is never changed after the write.
A version ("content") is a list of batches read under a list of columns, so a
new version shares the old batches and copies no rows.

A column is found in the files by a name that it keeps for good and that no other column of
the table ever gets, whatever it is called. Deleted rows are named by a folder of keys, each with
the batch it was found in, so batches without such a row are read as before, and rows that
come later are not touched. Where the places of these rows are known too, a folder of marks
holds them as bits, one for each row of a file. In a partitioned table each batch holds one value of the partition,
which its name tells.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from urllib.parse import quote

from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
    TimestampNTZType,
)

CONTENT_SCHEMA = (
    "content_id string, table_id string, columns array<struct<name:string,type:string,file:string>>, partition string,"
    " deletes array<struct<id:string,keys:array<struct<file:string,type:string>>,batches:array<string>>>,"
    " n_batches bigint, digest string, batches array<string>"
)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _with(digest: str, batch: str) -> str:
    """Digest of a set of batches after one more, whatever the order."""
    return f"{int(digest, 16) ^ int(_sha(batch), 16):064x}"


def new_batch_id() -> str:
    return "b" + uuid.uuid4().hex


def partition_of(batch: str) -> str | None:
    """The partition value in a batch's name, as ``partition_name`` writes it."""
    return batch.partition("~")[2] or None


def partition_name(value) -> str:
    """A partition value as part of a folder name: n for null, or v and the text with odd bytes as !XX."""
    if value is None:
        return "n"
    return "v" + quote(str(value), safe="-_.").replace("~", "%7E").replace("%", "!")


EMPTY_DIGEST = "0" * 64


#: a row's file and number in it, in a scan that shows them
PLACE = "_batch~place"


@dataclass(frozen=True)
class Delete:
    """A folder of keys whose rows are gone. ``batches`` are those it names, or None where they are too many to hold here."""

    id: str
    keys: tuple[tuple[str, str], ...]
    batches: tuple[str, ...] | None

    @staticmethod
    def new_id(marked: bool) -> str:
        return ("p" if marked else "d") + uuid.uuid4().hex

    @property
    def marked(self) -> bool:
        """Whether the places of its rows are marked."""
        return self.id.startswith("p")

    def touches(self, batch: str) -> bool:
        return self.batches is None or batch in self.batches


@dataclass(frozen=True)
class Content:
    """One table version. ``batches`` is None where the list is too long to hold here.

    ``columns`` are name, type and name in the files; ``partition`` is an expression over the
    columns by their names in the files.
    """

    table_id: str
    columns: tuple[tuple[str, str, str], ...]
    n_batches: int = 0
    digest: str = EMPTY_DIGEST
    batches: tuple[str, ...] | None = ()
    deletes: tuple[Delete, ...] = ()
    partition: str | None = None

    @staticmethod
    def empty(schema: StructType, partition: str | None = None) -> Content:
        columns = tuple((f.name, f.dataType.json(), f.name) for f in schema.fields)
        return Content(table_id="t" + uuid.uuid4().hex, columns=require_names(columns), partition=partition)

    @property
    def content_id(self) -> str:
        """Equal for equal states: same table, same columns, same set of batches, same deleted rows."""
        state = [self.table_id, self.columns, self.n_batches, self.digest, self.partition, sorted(d.id for d in self.deletes)]
        return _sha(json.dumps(state))

    @property
    def schema(self) -> StructType:
        return struct_of([(name, kind) for name, kind, _ in self.columns])

    @property
    def file_schema(self) -> StructType:
        """The columns by their names in the files."""
        return struct_of([(file, kind) for _, kind, file in self.columns])

    def deletes_of(self, batch: str) -> frozenset[str]:
        """Which deletes may name rows of the batch."""
        return frozenset(d.id for d in self.deletes if d.touches(batch))

    def adding(self, *batches: str) -> Content:
        digest = self.digest
        for batch in batches:
            digest = _with(digest, batch)
        held = None if self.batches is None else (*self.batches, *batches)
        return replace(self, n_batches=self.n_batches + len(batches), digest=digest, batches=held)

    def appended(self, batch: str) -> Content:
        return self.adding(batch)

    def holding(self, *batches: str) -> Content:
        """Same table and columns, but exactly these batches; deletes that name none of them go."""
        deletes = tuple(d for d in self.deletes if any(map(d.touches, batches)))
        return replace(self, n_batches=0, digest=EMPTY_DIGEST, batches=(), deletes=deletes).adding(*batches)

    def deleting(self, delete: Delete) -> Content:
        return replace(self, deletes=(*self.deletes, delete))

    # ---- columns

    def _at(self, column: str) -> int:
        found = [k for k, (name, _, _) in enumerate(self.columns) if name.lower() == column.lower()]
        if not found:
            raise ValueError(f"no column {column}")
        return found[0]

    def _with_columns(self, columns) -> Content:
        return replace(self, columns=require_names(tuple(columns)))

    def without_column(self, column: str) -> Content:
        at = self._at(column)
        if self.partition is not None and re.search(rf"(?i)\b{re.escape(self.columns[at][2])}\b", self.partition):
            raise ValueError(f"the table is partitioned by {column}")
        return self._with_columns(c for k, c in enumerate(self.columns) if k != at)

    def with_column(self, column: str, kind: DataType) -> Content:
        """A column more, of which the present rows have no value. Its name in the files was never used before."""
        return self._with_columns((*self.columns, (column, kind.json(), f"{column}~{uuid.uuid4().hex[:12]}")))

    def renamed_column(self, column: str, new: str) -> Content:
        at = self._at(column)
        return self._with_columns((new, kind, file) if k == at else (name, kind, file) for k, (name, kind, file) in enumerate(self.columns))

    def widened_column(self, column: str, kind: DataType) -> Content:
        at = self._at(column)
        now = type_of(self.columns[at][1])
        if not widens(now, kind):
            raise ValueError(f"{column} is {now.simpleString()}, which {kind.simpleString()} does not widen")
        return self._with_columns((name, kind.json() if k == at else old, file) for k, (name, old, file) in enumerate(self.columns))

    # ---- rows of metadata

    def as_row(self) -> dict:
        return {
            "content_id": self.content_id,
            "table_id": self.table_id,
            "columns": [{"name": name, "type": kind, "file": file} for name, kind, file in self.columns],
            "partition": self.partition,
            "deletes": [
                {
                    "id": d.id,
                    "keys": [{"file": file, "type": kind} for file, kind in d.keys],
                    "batches": None if d.batches is None else list(d.batches),
                }
                for d in self.deletes
            ],
            "n_batches": self.n_batches,
            "digest": self.digest,
            "batches": None if self.batches is None else list(self.batches),
        }

    @staticmethod
    def from_row(row) -> Content:
        return Content(
            table_id=row["table_id"],
            columns=tuple((c["name"], c["type"], c["file"]) for c in row["columns"]),
            n_batches=row["n_batches"],
            digest=row["digest"],
            batches=None if row["batches"] is None else tuple(row["batches"]),
            deletes=tuple(
                Delete(d["id"], tuple((k["file"], k["type"]) for k in d["keys"]), None if d["batches"] is None else tuple(d["batches"]))
                for d in row["deletes"]
            ),
            partition=row["partition"],
        )


# ---- columns -------------------------------------------------------------------------


def require_names(columns: tuple) -> tuple:
    names = [name.lower() for name, _, _ in columns]
    if not names or len(set(names)) != len(names):
        raise ValueError(f"a table needs columns with distinct names, got {[name for name, _, _ in columns]}")
    if "_batch" in names:
        raise ValueError("_batch names the folder of a batch and cannot be a column")
    if PLACE in names:
        raise ValueError(f"{PLACE} names the place of a row and cannot be a column")
    return columns


def struct_of(fields: Sequence[tuple[str, str]]) -> StructType:
    named = [{"name": name, "type": json.loads(kind), "nullable": True, "metadata": {}} for name, kind in fields]
    return StructType.fromJson({"type": "struct", "fields": named})


def type_of(kind: str) -> DataType:
    return struct_of([("c", kind)]).fields[0].dataType


WHOLE = (ByteType, ShortType, IntegerType, LongType)


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of the old type is one of the new, and Parquet files of the old can be read as the new."""
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new != old and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if type(old) in WHOLE and type(new) in WHOLE:
        return WHOLE.index(type(new)) > WHOLE.index(type(old))
    pairs = [(FloatType, DoubleType), (ByteType, DoubleType), (ShortType, DoubleType), (IntegerType, DoubleType), (DateType, TimestampNTZType)]
    return (type(old), type(new)) in pairs
