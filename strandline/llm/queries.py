"""The registered queries of the corpus operators, with production parameters, and their twins in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, fingerprint, language_id, license_scan, line_dedup, pii, sentencepieces, sharding, simhash, substring_dedup
from strandline.llm.common import KEY, MODEL, documents


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_with_edits(documents(spark, sf_dir))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(documents(spark, sf_dir), benchmark, seed=5, coverage=0.5)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trips(documents(spark, sf_dir), sentencepieces.read_model(MODEL))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), shards=8)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), limit=4, width=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir), KEY)


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_decontaminate": op2_decontaminate,
    "op3_licenses": op3_licenses,
    "op4_sentencepieces": op4_sentencepieces,
    "op5_sharding": op5_sharding,
    "op6_line_dedup": op6_line_dedup,
    "op7_language": op7_language,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_pseudonyms": op10_pseudonyms,
}

#: Jump consistent hashing for 8 and 9 shards as a recursion (64-bit steps in HUGEINT), and CRC-32 by its table.
ORACLE_SQL = {
    "op5_sharding": """
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS tab FROM (
                SELECT i, list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
                FROM range(256) r(i))),
        bytes AS (
            SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
                   list_transform(string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda h: CAST('0x' || h AS BIGINT)) AS bytes
            FROM documents),
        rows AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM bytes, crc_table),
        step AS (
            SELECT doc_id, n, CAST(doc_id AS HUGEINT) AS key, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (8), (9)) s(n)
            UNION ALL
            SELECT doc_id, n, k, j, CAST(floor((j + 1) * (2147483648.0 / CAST((k // 8589934592) + 1 AS DOUBLE))) AS BIGINT)
            FROM (SELECT doc_id, n, j, (key * 2862933555777941757 + 1) % 18446744073709551616 AS k FROM step WHERE j < n)),
        shards AS (SELECT doc_id, max(b) FILTER (WHERE n = 8) AS shard, max(b) FILTER (WHERE n = 9) AS grown_shard FROM step WHERE j >= n GROUP BY doc_id)
        SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, CAST(grown_shard AS INT) AS grown_shard
        FROM rows JOIN shards USING (doc_id)
    """,
    "op6_line_dedup": """
        WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM rows),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        common AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
        marked AS (
            SELECT k.r, k.doc_id, k.line, k.pos, coalesce(k.doc_id < c.keeper, k.doc_id IS NULL AND c.keeper IS NOT NULL) AS lost
            FROM keyed k LEFT JOIN common c ON k.key = c.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY r, doc_id
    """,
}
