"""Applying a model to table rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.joins import lookup_join
from ..functions.text import exploded, terms
from ..session import stored

BatchModel = Callable[[pd.Series], pd.Series]


def batch_predict(
    df: DataFrame, text: str, load_model: Callable[[], BatchModel], output: str = "prediction"
) -> DataFrame:
    """Add a model's output for a text column; equal texts are predicted once.

    ``load_model`` runs once per task. Texts meet their predictions again by digest:
    only digests, not texts, are joined, and a digest shared by very many rows is
    split by Spark's skew handling.
    """
    keyed = df.withColumn("_h", F.sha2(F.col(text), 256))
    prompts = keyed.where(F.col(text).isNotNull()).groupBy("_h").agg(F.first(text).alias("_text"))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            yield pd.DataFrame({"_h": batch["_h"], output: model(batch["_text"])})

    predicted = prompts.mapInPandas(predict, f"_h string, `{output}` string")
    return keyed.join(predicted, "_h", "left").drop("_h")


def parse_typed_output(df: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    """Model text to declared columns. A malformed text gives NULLs and ``valid = false``;
    so does one that lacks a declared field."""
    corrupt = "_bad"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(raw, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = df.withColumn("_p", parsed)
    valid = F.col("_p").isNotNull() & F.col(f"_p.{corrupt}").isNull()
    for field in schema.fields:
        if not field.nullable:
            valid = valid & F.col(f"_p.{field.name}").isNotNull()
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    for field in schema.fields:
        value = F.when(F.col("valid"), F.col(f"_p.{field.name}"))
        rows = rows.withColumn(field.name, value)
    return rows.drop("_p")


MICRO = 1_000_000  # log probabilities are whole millionths, so that sums are exact in any order


@dataclass(frozen=True)
class NaiveBayes:
    """Labels in order, their log priors, and for each known term one log probability a label."""

    labels: list[str]
    priors: list[int]
    terms: DataFrame


def _micro_log(ratio: Column) -> Column:
    return F.round(F.log(ratio) * MICRO).cast("long")


def train_classifier(train: DataFrame, text: str, label: str) -> NaiveBayes:
    """Multinomial naive Bayes from counts of words, with one added to each.

    ``train`` is meant to be a bounded sample per label; rows without a label are left out. Labels and
    their totals reach the driver, terms don't.
    """
    rows = train.where(F.col(label).isNotNull())
    shares = sorted(rows.groupBy(label).count().collect())
    labels, total = [r[0] for r in shares], sum(r[1] for r in shares)
    tokens = exploded(rows, [F.col(label).alias("_label")], terms(F.col(text)), "term")
    counted = stored(tokens.groupBy("_label", "term").count(), "term-labels")
    sizes = dict(counted.groupBy("_label").agg(F.sum("count")).collect())
    n_terms = counted.select("term").distinct().count()
    of_label = [F.coalesce(F.sum(F.when(F.col("_label") == x, F.col("count"))), F.lit(0)) for x in labels]
    logs = [_micro_log((c + 1) / F.lit(float(sizes.get(x, 0) + n_terms))) for c, x in zip(of_label, labels)]
    weights = counted.groupBy("term").agg(F.array(*logs).alias("_weights")) if labels else None
    priors = [round(math.log(n / total) * MICRO) for _, n in shares]
    return NaiveBayes(labels, priors, weights and stored(weights, "term-weights"))


def classify(model: NaiveBayes, df: DataFrame, key: str, text: str) -> DataFrame:
    """Add column ``prediction``: the label of the greatest posterior, ties to the first in order.

    Unknown terms say nothing, so a text without a known term gets the most frequent label. Every use of a term meets
    the model by itself: sums of whole numbers are the same, and a task holds one entry a row, not one
    for every row and term. Keys must differ. A model without labels predicts NULL.
    """
    if not model.labels:
        return df.withColumn("prediction", F.lit(None).cast("string"))
    used = exploded(df, [key], terms(F.col(text)), "term")
    known = lookup_join(used, model.terms, ["term"], "inner")
    sums = [F.sum(F.get("_weights", F.lit(i))) for i in range(len(model.labels))]
    scored = df.join(known.groupBy(key).agg(F.array(*sums).alias("_sums")), key, "left")
    posterior = [F.coalesce(F.get("_sums", F.lit(i)), F.lit(0)) + p for i, p in enumerate(model.priors)]
    # The greatest score, then the first label: the later ones have lower second parts.
    best = F.greatest(*[F.struct(s.alias("s"), F.lit(-i).alias("i")) for i, s in enumerate(posterior)]) if len(
        posterior
    ) > 1 else F.struct(posterior[0].alias("s"), F.lit(0).alias("i"))
    named = F.get(F.array(*[F.lit(x) for x in model.labels]), -best["i"])
    return scored.withColumn("prediction", named).drop("_sums")
