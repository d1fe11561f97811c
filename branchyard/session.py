"""Where stores live, and small helpers to build metadata rows in Spark."""

from __future__ import annotations

import json
import tempfile
import threading
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder of the session.

    The shared folder is the one the cluster names in ``spark.checkpoint.dir``.
    Only a local session may go without: it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="branchyard-")
    return f"{shared.rstrip('/')}/{quote(name)}-{uuid.uuid4().hex}"


_renaming = threading.Lock()


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    """Names below a folder, from its listing alone; none if there is no such folder."""
    folder, files = _file_system(spark, path)
    if pattern is not None:
        found = files.globStatus(_file_system(spark, f"{path}/{pattern}")[0])
        return [status.getPath().getName() for status in found or []]
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def publish_folder(spark: SparkSession, written: str, name: str) -> bool:
    """Give a written folder its final name; False if another writer took that name first.

    The file system's own rename decides, which on HDFS is one step. Writers of one process
    take turns, for local disks, where looking and renaming are two.
    """
    target, files = _file_system(spark, name)
    source, _ = _file_system(spark, written)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    with _renaming:
        files.mkdirs(target.getParent())
        if files.exists(target):
            return False
        try:
            context.rename(source, target, no_overwrite)
        except Py4JJavaError:
            if files.exists(source) and files.exists(target):
                return False
            raise
    return True


def rows_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A DataFrame of a few metadata rows, built in the JVM without Python tasks."""
    packed = spark.sql("SELECT :rows AS rows", args={"rows": json.dumps(rows)})
    return packed.select(F.inline(F.from_json("rows", f"array<struct<{schema}>>")))


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty, so that it plans nothing for it."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).select(columns).limit(0)
