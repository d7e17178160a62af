"""Line dedup: drop the lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import lookup_join
from .common import SPACE, ascii_lower, packed, saved, text_or_empty


def split_lines(text: Column) -> Column:
    """Lines of a text; null or empty gives one empty line."""
    return F.split(text_or_empty(text), "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """One hash per line of its stripped, lower-cased key; null for keys that are too short."""
    return F.transform(
        split_lines(ascii_lower(text_or_empty(text))),
        lambda line: F.transform(
            F.array(F.btrim(line, F.lit(SPACE))),
            lambda key: F.when(F.char_length(key) >= min_chars, F.xxhash64(key)),
        )[0],
    )


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    min_docs: int = 10,
    min_chars: int = 1,
) -> DataFrame:
    """Remove every line whose key is found in ``min_docs`` or more documents.

    Returns ``doc`` (the input row), ``n_lines``, ``n_dropped`` and ``kept`` (the other lines,
    joined by a line break).

    Each row is one document, so a row given twice counts twice. Keys meet by a 64-bit hash. A
    document counts once per key: its hashes are made distinct before they leave the row, and
    counts are summed before the shuffle, so a line of every document costs one row per task.
    The frequent keys are measured, then broadcast or joined with skewed partitions split. Only
    hashes and positions are moved until the last join, which brings a document's dropped
    positions to its text; rows equal in id and text share them.

    Null text is one empty line. Null ids are an ordinary value. No rows give no rows.
    """
    source = packed(docs).select(
        "doc",
        F.col(f"doc.{doc_id}").alias("_id"),
        F.xxhash64(f"doc.{text}").alias("_h"),
        F.col(f"doc.{text}").alias("_text"),
    )
    hashed = source.select("_id", "_h", line_hashes(F.col("_text"), min_chars).alias("_keys"))
    counts = (
        hashed.select(F.explode(F.array_distinct("_keys")).alias("_key"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .count()
        .where(F.col("count") >= min_docs)
        .select("_key")
    )
    frequent = saved(counts, "frequent-lines")
    lines = hashed.select("_id", "_h", F.posexplode("_keys").alias("_pos", "_key")).where(
        F.col("_key").isNotNull()
    )
    dropped = (
        lookup_join(lines, frequent, ["_key"], "left_semi")
        .groupBy(F.col("_id").alias("_did"), F.col("_h").alias("_dh"))
        .agg(F.collect_set("_pos").alias("_gone"))
    )
    joined = source.join(
        dropped, F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_h") == F.col("_dh")), "left"
    )
    # Positions are told apart by hashing, so a long document with many such lines stays linear.
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    return (
        joined.select("doc", "_gone", split_lines(F.col("_text")).alias("_lines"))
        .select(
            "doc",
            F.size("_lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n"))
            .otherwise(
                F.array_join(
                    F.transform(
                        F.array_except(every, "_gone"), lambda i: F.get(F.col("_lines"), i)
                    ),
                    "\n",
                )
            )
            .alias("kept"),
        )
    )
