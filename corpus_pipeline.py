"""A training corpus from raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fernway.llm import langid, lines, mixing, near, pieces
from fernway.llm.common import begin, saved, sha256
from fernway.llm.queries import piece_model


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles recognise."""
    begin(spark)
    return langid.reject_unknown(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    begin(spark)
    found = lines.dedup_lines(docs, min_docs=10, min_chars=1)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return found.select(*[new.get(n, F.col("doc")[n]).alias(n) for n in docs.columns])


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    begin(spark)
    return near.near_unique(docs, percent=75)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents once, twice or not at all, as their source's target asks."""
    begin(spark)
    return mixing.mixed_rows(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the text decoded again."""
    begin(spark)
    return pieces.encode_pieces(docs, piece_model()).select(
        "doc.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

# Profiles, minima and merge rounds have no SQL; tests compare the run with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
