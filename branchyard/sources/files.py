"""CSV and Parquet files, read with a declared schema wherever one is given.

None of these readers infers types: inference would be a second pass over the
files. Without a schema a CSV file with a header gives string columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def csv_with_header(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV whose first line of each file names the columns."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def csv_without_header(
    spark: SparkSession, path: str, schema: StructType | str, delimiter: str = ","
) -> DataFrame:
    """Delimited text under a declared schema. A header line becomes a data row."""
    return spark.read.schema(schema).option("sep", delimiter).csv(path)


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Plain Parquet files outside any store."""
    return spark.read.parquet(path)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view; it is not versioned."""
    df.createOrReplaceTempView(name)
    return df


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """Write as CSV, one file per partition, each with its own header line."""
    df.write.mode("errorifexists").option("header", header).csv(path)
    return path
