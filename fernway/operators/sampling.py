"""Per-label samples and splits, repeatable by seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def _shuffled_rank(df: DataFrame, label: str, key: str, seed: int):
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    return F.row_number().over(W.partitionBy(label).orderBy(order, F.col(key)))


def stratified_sample(df: DataFrame, label: str, key: str, n: int, seed: int = 1) -> DataFrame:
    """``n`` rows per label. A short label yields all it has; ``label_rows`` says how many.

    The bound on the rank is a literal, so each map task forwards at most ``n`` rows per
    label and a dominant label does not reach one task whole.
    """
    ranked = df.withColumn("sample_rank", _shuffled_rank(df, label, key, seed))
    sampled = ranked.where(F.col("sample_rank") <= n)
    return sampled.withColumn("label_rows", F.count("*").over(W.partitionBy(label)))


def train_test_split(
    df: DataFrame, label: str, key: str, n_train: int, n_test: int, seed: int = 1
) -> DataFrame:
    """Disjoint per-label slices of one ranking, marked in column ``split``."""
    ranked = df.withColumn("sample_rank", _shuffled_rank(df, label, key, seed))
    return ranked.where(F.col("sample_rank") <= n_train + n_test).withColumn(
        "split", F.when(F.col("sample_rank") <= n_train, "train").otherwise("test")
    )


def label_coverage(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Test rows whose label occurs in train. Distinct labels come first, so the join
    side is as small as the label set."""
    return test.join(train.select(label).distinct(), label, "left_semi")


def label_gaps(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Test rows whose label train lacks."""
    return test.join(train.select(label).distinct(), label, "left_anti")


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """The label set with its sizes."""
    return df.groupBy(label).agg(F.count("*").alias("n_rows"))
