"""One query for each operator over its whole table, and SQL with the same result where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchyard.llm import arc_archives, byte_bpe, decontamination, license_scan, maxscore, merkle, near_duplicates, preferences, repeated_spans, token_counts, toxicity, url_rules, whitening
from branchyard.llm.oracles import REPEATED_SPANS, merkle as merkle_sql
from branchyard.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = work_folder(spark, "arc"), work_folder(spark, "warc")
    arc_archives.write_arc(table(spark, sf_dir, "pages"), arc)
    arc_archives.convert(spark, arc, warc)
    records = arc_archives.read_warc(spark, warc, payloads=False)
    return records.select(F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2p and 2p + 1 are the chosen and the rejected side of pair p."""
    turns = table(spark, sf_dir, "conversations")
    return preferences.preference_pairs(
        turns.select(F.shiftright("conv_id", 1).alias("pair_id"), (F.col("conv_id") % 2 == 0).alias("is_chosen"), "turn", "role", "text")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=4)


#: The rules of the contract as host, path and verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, verdict)")
    return url_rules.judged_urls(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's deviation is a long: beyond its range the cast is an error; the operator itself has a decimal."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


#: The columns of a leaf, in order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is tampered with: their texts are in small letters."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    proofs = merkle.merkle_proofs(table(spark, sf_dir, "documents"), LEAF, {"text": F.translate("text", CAPITALS, SMALL)}, where=third)
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.without_repeats(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_byte_bpe, op2_arc_to_warc, op3_token_counts, op4_maxscore, op5_preferences,
    op6_toxicity, op7_decontamination, op8_near_duplicates, op9_url_rules, op10_license_scan,
    op11_whitening, op12_merkle_manifest, op13_repeated_spans,
)}

ORACLES = {
    "op2_arc_to_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM f
    """,
    "op4_maxscore": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
    "op5_preferences": """
        WITH t AS (
            SELECT (conv_id - abs(conv_id % 2)) // 2 AS pair_id, conv_id % 2 = 0 AS is_chosen, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        sizes AS (
            SELECT pair_id, count(*) FILTER (is_chosen) AS c, count(*) FILTER (NOT is_chosen) AS r FROM t GROUP BY pair_id
        ),
        differ AS (
            SELECT a.pair_id, min(a.i) - 1 AS n FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.i = b.i
            WHERE a.is_chosen AND NOT b.is_chosen AND (a.role <> b.role OR a.text <> b.text) GROUP BY a.pair_id
        ),
        prefix AS (SELECT s.*, coalesce(d.n, least(c, r)) AS n FROM sizes s LEFT JOIN differ d USING (pair_id)),
        made AS (
            SELECT t.*, p.n, '<|im_start|>' || role || chr(10) || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS line
            FROM t JOIN prefix p USING (pair_id)
        ),
        placed AS (
            SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY pair_id, is_chosen, i > n ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
            FROM made
        ),
        spans AS (
            SELECT *, CASE WHEN role = 'assistant' THEN (pos + 12 + length(role) + 1)::VARCHAR || ':' || (pos + length(line) - 1)::VARCHAR END AS span FROM placed
        )
        SELECT pair_id, any_value(n)::BIGINT AS n_prompt_turns,
            count(*) FILTER (is_chosen AND i > n) AS n_chosen_turns,
            count(*) FILTER (NOT is_chosen AND i > n) AS n_rejected_turns,
            coalesce(string_agg(line, '' ORDER BY i) FILTER (is_chosen AND i <= n), '') AS prompt,
            coalesce(string_agg(line, '' ORDER BY i) FILTER (is_chosen AND i > n), '') AS chosen,
            coalesce(string_agg(span, ',' ORDER BY i) FILTER (is_chosen AND i > n), '') AS chosen_mask,
            coalesce(string_agg(line, '' ORDER BY i) FILTER (NOT is_chosen AND i > n), '') AS rejected,
            coalesce(string_agg(span, ',' ORDER BY i) FILTER (NOT is_chosen AND i > n), '') AS rejected_mask
        FROM spans GROUP BY pair_id
    """,
    "op9_url_rules": """
        WITH u AS (
            SELECT page_id, coalesce(url, '') AS url,
                translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages
        ),
        m AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
            END AS rule FROM u
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m
    """,
    "op12_merkle_manifest": merkle_sql(),
    "op13_repeated_spans": REPEATED_SPANS,
}
