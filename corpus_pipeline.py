"""A corpus from raw documents to tokens, in five stages that each see only what the stage before them kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, language_id, line_dedup, sentencepieces, simhash, substring_dedup
from strandline.llm.common import MODEL, documents, for_texts, written

#: The stages up to the last return these columns; n_chars is that of the text as it then is.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; null texts, texts without a letter and rejected ones go."""
    for_texts(spark)
    return language_id.accepted(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that at least five of them share (the largest doc_id keeps them)."""
    kept = line_dedup.dedup_lines(docs, min_chars=40, min_docs=5, carry=("lang", "source"))
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest doc_id.

    Near duplicates have SimHash codes within 4 bits, or five-word shingles of Jaccard similarity 0.8 or more: most copies of
    that similarity are more than 4 bits apart.
    """
    for_texts(spark)
    docs = docs.select(*COLUMNS)
    return simhash.deduplicated(docs, links=substring_dedup.near_copies(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item."""
    for_texts(spark)
    return decontaminate.decontaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, round_trip) of every document."""
    for_texts(spark)
    return sentencepieces.round_trips(docs, sentencepieces.read_model(MODEL))


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", tokens),
]

#: A learned model, SimHash components and merges by rank have no form in SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
