"""What the operators of this folder share.

Row operators pack the input row into one struct column, ``doc``, and add their own columns
beside it, so input columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import new_work_path, ship_package

# White space of the contracts, and the letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Rows hold whole documents; a batch for Python must fit beside others in an executor.
BATCH_ROWS = 500


def begin(spark: SparkSession) -> SparkSession:
    """Send the package to the executors and keep Python's batches small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared work area and read it back.

    This cuts the lineage: a lost executor costs the tasks of the present stage only.
    """
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct column ``doc``."""
    return docs.select(F.struct("*").alias("doc"))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the runs of non-white-space characters."""
    trimmed = F.btrim(text_or_empty(text), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def word_count(text: Column) -> Column:
    """Number of words as a long, null text giving 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
