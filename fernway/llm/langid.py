"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import begin, packed

UNKNOWN = "und"
PROFILE = 300
BITS = 18  # all letters have smaller code points
FLUSH = 500_000


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    table = np.zeros(sys.maxunicode + 1, bool)
    table[[c for c in range(1 << BITS) if chr(c).isalpha()]] = True
    return table


def gram_codes(text: str | None) -> np.ndarray:
    """All letter n-grams of one to three, over words padded with a blank on either side.

    A code holds the n-gram itself: its letters, 18 bits each, and its length.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letters = np.concatenate([[0], np.where(_letters()[points], points, 0), [0]]).astype(np.int64)
    kept = np.ones(len(letters), bool)
    kept[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    letters = letters[kept]
    one = letters[letters != 0]
    if not len(one):
        return one
    two = (letters[:-1] << BITS) | letters[1:]
    three = ((two[:-1] << BITS) | letters[2:])[letters[1:-1] != 0]
    return np.concatenate([one, two | (1 << 60), three | (2 << 60)])


def counted(codes: np.ndarray, weights: np.ndarray | None = None):
    """Distinct codes with their counts."""
    if weights is None:
        return np.unique(codes, return_counts=True)
    found, where = np.unique(codes, return_inverse=True)
    return found, np.bincount(where, weights).astype(np.int64)


def _count_batches(batches):
    """Partial n-gram counts per language over a whole task, in bounded memory."""
    held: dict[str, list] = {}

    def rows(lang):
        codes, counts = (np.concatenate(x) for x in zip(*held.pop(lang)))
        codes, counts = counted(codes, counts)
        return pd.DataFrame({"lang": lang, "code": codes, "n": counts})

    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            codes = [c for c in map(gram_codes, texts) if len(c)]
            if codes:
                held.setdefault(lang, []).append(counted(np.concatenate(codes)))
        for lang in [k for k, v in held.items() if len(v) > 8]:
            codes, counts = counted(*(np.concatenate(x) for x in zip(*held[lang])))
            held[lang] = [(codes, counts)]
        if sum(len(c) for v in held.values() for c, _ in v) > FLUSH:
            for lang in list(held):
                yield rows(lang)
    for lang in list(held):
        yield rows(lang)


def learn_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE
) -> DataFrame:
    """The ``size`` most frequent n-grams of each language over all rows of ``docs``.

    Returns ``lang, code, rank`` (0 first; equal counts by code). Rows without a language don't
    count. Counts are summed per task before the shuffle.
    """
    begin(docs.sparkSession)
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    order = W.partitionBy("lang").orderBy(F.desc("n"), "code")
    return (
        labelled.mapInPandas(_count_batches, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        # Compared with the bare row number, so that Spark keeps ``size`` rows a task before the exchange.
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .select("lang", "code", (F.col("rank") - 1).alias("rank"))
    )


class Profiles:
    """Language profiles as arrays: a rank for every known n-gram and language."""

    def __init__(self, rows, size: int = PROFILE):
        self.size = size
        self.langs = sorted({r["lang"] for r in rows})
        self.codes = np.unique(np.array([r["code"] for r in rows], np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), size, np.int32)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for r in rows:
            self.ranks[np.searchsorted(self.codes, r["code"]), column[r["lang"]]] = r["rank"]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language by out-of-place distance, the first by name among equals, and one
        minus the distance as a share of the largest possible one."""
        codes = gram_codes(text)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        found, counts = counted(codes)
        found = found[np.lexsort((found, -counts))[: self.size]]
        at = np.minimum(np.searchsorted(self.codes, found), len(self.codes) - 1)
        at = np.where(self.codes[at] == found, at, len(self.codes))
        ranks = self.ranks[at]
        own = np.arange(len(found), dtype=np.int32)[:, None]
        apart = np.where(ranks < self.size, np.abs(ranks - own), self.size).sum(axis=0)
        best = int(apart.argmin())
        return self.langs[best], 1.0 - float(apart[best]) / (self.size * len(found))


def predict_languages(
    docs: DataFrame, profiles: DataFrame, text: str = "text", size: int = PROFILE
) -> DataFrame:
    """The language of every document's whole text.

    Returns ``doc`` (the input row), ``lang_pred`` (``und`` for null or a text without a letter)
    and ``score`` (0 to 1). Equal texts get equal results. The model that reaches the driver and
    the tasks has ``size`` rows per language, whatever the corpus.
    """
    begin(docs.sparkSession)
    model = Profiles(profiles.collect(), size)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(map(model.predict, texts), columns=["lang_pred", "score"])

    return (
        packed(docs)
        .withColumn("_found", predict(F.col(f"doc.{text}")))
        .select("doc", "_found.lang_pred", "_found.score")
    )


def held_out(doc_id: Column) -> Column:
    """Rows that the query never learns from; a null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def reject_unknown(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    min_score: float = 0.1,
) -> DataFrame:
    """Rows whose language is recognised: not ``und``, and a score of ``min_score`` or more.

    Where no profile can be learned, as no row outside the held-out part has a language, only null
    texts and texts without a letter are rejected.
    """
    learned = learn_profiles(docs.where(~held_out(F.col(doc_id))), text, lang)
    rows = learned.collect()
    if not rows:
        begin(docs.sparkSession)

        @F.pandas_udf("boolean")
        def lettered(texts: pd.Series) -> pd.Series:
            return pd.Series([len(gram_codes(t)) > 0 for t in texts], dtype=bool)

        return docs.where(lettered(F.col(text)))
    learned = docs.sparkSession.createDataFrame(rows, learned.schema)
    found = predict_languages(docs, learned, text)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*[F.col("doc")[n].alias(n) for n in docs.columns])
