from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from tests.llm.helpers import clashing  # noqa: E402


def test_stages_drop_what_is_planted_and_keep_the_rest(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    clean = " ".join(f"clean{k}" for k in range(80))
    rude = " ".join(f"w{k} idiot scum moron trash stupid" for k in range(20))
    leak = " ".join(f"a{k}" for k in range(30)) + " " + item + " " + " ".join(f"b{k}" for k in range(30))
    rows = [(500_001, clean), (500_002, clean + " more"), (500_003, rude), (500_004, leak), (500_005, ""), (None, None)]
    planted = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    now, ours = docs.union(planted), F.expr("doc_id IS NULL OR doc_id > 500000")  # the first stage learns from the labelled documents
    left = [{500_001, 500_002, 500_004, 500_005, None}, {500_001, 500_004, 500_005, None}, {500_001, 500_005, None}]
    for (_, stage), want in zip(corpus_pipeline.STAGES, left):
        now = spark.createDataFrame(stage(spark, now, sf).where(ours).collect(), docs.schema)
        assert {r.doc_id for r in now.collect()} == want and now.columns == docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert {r.doc_id for r in last.collect()} == left[-1]


def test_rows_of_a_repeated_id_are_decided_on_by_their_text(spark):
    sf = "/root/testdata/sf0.01"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    a, b, c = (" ".join(f"{side}{k}" for k in range(80)) for side in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b + " more"), (8, c), (8, c), (9, ""), (9, ""), (None, a), (None, a)]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    assert kept.columns == ["doc_id", "text"]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, a), (5, b), (8, c), (9, ""), (9, ""), (None, a), (None, a)], key=repr)
    rows = [(1, a), (1, f"{a} {item} {a}"), (2, b), (2, b), (3, item), (None, item)]
    kept = corpus_pipeline.drop_benchmark_leaks(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    assert kept.columns == ["doc_id", "text"]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, a), (2, b), (2, b), (None, item)], key=repr)


def test_stages_keep_columns_of_any_name_and_type(spark):
    """Names that stages use themselves, a map, a dot in a name, and an id in several rows."""
    sf = "/root/testdata/sf0.01"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    a, b = (" ".join(f"{side}{k}" for k in range(80)) for side in "ab")
    rows = [(1, a, "u1"), (1, f"{b} {item} {b}", "u2"), (3, a, "u3"), (3, a, "u3"), (4, None, None), (None, b, "u5")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, user string"))
    user = F.col("user")
    docs = docs.withColumns({"_row_id": user, "_contaminated": user, "__row_id": user, "tags": F.create_map(F.lit("k"), user), "a.b": user, "lang": user, "source": user, "n_chars": F.lit(1)})
    deduped = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, sf)
    for made, want in ((deduped, ["u1", "u2", "u5", None]), (kept, ["u1", "u3", "u3", "u5", None])):
        assert made.columns == docs.columns
        out = made.collect()
        assert sorted((r.user for r in out), key=str) == sorted(want, key=str)
        for r in out:
            assert r["_row_id"] == r["_contaminated"] == r["__row_id"] == r["a.b"] == r.user and r.tags == {"k": r.user} and r.score == "x"
    toxic = corpus_pipeline.drop_toxic(spark, docs.unionByName(spark.read.parquet(f"{sf}/documents.parquet"), allowMissingColumns=True), sf)
    assert toxic.columns == docs.columns and toxic.where("user = 'u3' AND _row_id = 'u3' AND `a.b` = 'u3'").count() == 2
    assert corpus_pipeline.tokenise(spark, docs, sf).count() == 6
