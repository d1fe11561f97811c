"""The corpus pipeline: toxic documents go, then near duplicates, then benchmark leaks; the rest is tokenised.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept; all but
the last return the columns of documents. Rows without a doc_id are never taken for duplicates or
leaks and stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchyard.functions.expressions import quoted
from branchyard.llm import byte_bpe, decontamination, near_duplicates, toxicity
from branchyard.llm.common import row_ids
from branchyard.session import work_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3; the model learns from the labels of the folder."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest doc_id.

    A doc_id that stands in several rows is no link between them: rows of it with the same or a
    near text are reduced to one (the first by the other columns), and a row with another text is
    decided on by that text. Texts without words are linked with nothing, so all their rows stay.
    """
    rows, row = row_ids(docs, "doc_id")
    copies = near_duplicates.near_duplicates(rows, id_col=row).where("NOT kept").select(F.col("doc_id").alias(row)).distinct()
    return rows.join(copies, row, "left_anti").select([quoted(c) for c in docs.columns])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item; rows of a repeated doc_id are decided on one by one."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", tokenise),
]

#: SQL can express neither the trees of the first stage nor the merges of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a folder through all stages; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = work_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
