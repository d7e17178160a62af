"""Keywords of documents, to feed to search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.joins import fits_broadcast
from ..session import stored
from ..functions.text import bind, codes, email_addresses, exploded, terms

# Terms of most documents whose numbers of documents are sent to the counts, if not all are.
COMMON_TERMS = 100_000


def _counted(array: Column) -> Column:
    """``(term, tf)`` of each distinct term of an array: the lengths of the runs once it is sorted."""

    def ends(ordered: Column) -> Column:
        size = F.size(ordered)
        last = lambda i: (i == size) | (F.get(ordered, i) != F.get(ordered, i - 1))
        found = F.when(size > 0, F.filter(F.sequence(F.lit(1), size), last))
        return bind(
            found,
            lambda end: F.transform(
                end,
                lambda at, i: F.struct(
                    F.get(ordered, at - 1).alias("term"),
                    (at - F.coalesce(F.get(end, i - 1), F.lit(0))).cast("long").alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(array), ends)


def _term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term, tf)``. Terms are counted inside their row; only those of keys that several rows hold are exchanged."""
    rows = exploded(docs, [key], _counted(terms(F.col(text))), "_c").select(key, "_c.term", "_c.tf")
    repeated = stored(docs.groupBy(key).count().where("count > 1").select(F.col(key).alias("_key")), "repeated-keys")
    if repeated.isEmpty():
        return rows
    if fits_broadcast(repeated):
        repeated = F.broadcast(repeated)
    same = F.col(key).eqNullSafe(F.col("_key"))
    merged = rows.join(repeated, same, "left_semi").groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return rows.join(repeated, same, "left_anti").unionByName(merged)


def extract_keywords(
    docs: DataFrame, key: str, text: str, n: int, *, common_terms: int = COMMON_TERMS
) -> DataFrame:
    """The ``n`` terms of each document with the highest tf·idf, rounded to 6 places.

    The counts of terms are stored, so texts are read once. Where the terms' numbers of documents are few enough to
    be sent to the counts, only the ``n`` best of a document are exchanged. Else that is so for the ``common_terms`` terms
    of most documents, and the counts of all other terms are exchanged.
    """
    counted = stored(_term_counts(docs, key, text), "term-counts")
    frequency = stored(counted.groupBy("term").agg(F.count("*").alias("df")), "term-documents")
    total = docs.where(F.col(text).isNotNull()).count()
    weight = F.round(F.col("tf") * F.log(F.lit(total + 1.0) / (F.col("df") + 1.0)), 6)
    order = W.partitionBy(key).orderBy(F.desc("weight"), F.col("term"))

    def best(weighted: DataFrame) -> DataFrame:
        return weighted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    if fits_broadcast(frequency):
        weighted = counted.join(F.broadcast(frequency), "term").withColumn("weight", weight)
    else:
        # Of the terms of most documents, each document's best are found where its counts lie.
        common = stored(frequency.orderBy(F.desc("df"), "term").limit(common_terms), "term-common")
        common, parts = F.broadcast(common), [key, "term", "weight"]
        found = best(counted.join(common, "term").withColumn("weight", weight)).select(*parts)
        rare = counted.join(common, "term", "left_anti").join(frequency, "term").withColumn("weight", weight)
        weighted = found.unionByName(rare.select(*parts))
    ranked = best(weighted)
    return ranked.select(key, "term", "weight", "rank")


def extract_emails(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per address found, with its name part."""
    found = exploded(docs, [key], email_addresses(F.col(text)), "e")
    return found.select(key, "e.name", "e.email")


def extract_codes(docs: DataFrame, text: str) -> DataFrame:
    """Each code in the texts with its number of uses."""
    found = exploded(docs, [], codes(F.col(text)), "code")
    return found.groupBy("code").agg(F.count("*").alias("n_uses"))


def lookup_then_retrieve(
    found: DataFrame, keywords: DataFrame, neighbours: DataFrame, passages: DataFrame, key: str
) -> DataFrame:
    """Table lookup, keywords and search results of each question as one report row.

    ``found`` has ``(key, answer)``; all inputs hold a bounded number of rows per question.
    """
    words = keywords.groupBy(key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda t: t["term"]),
            " ",
        ).alias("keywords")
    )
    from .vectors import retrieve_context

    context = retrieve_context(neighbours, passages, "id", "text").withColumnRenamed(
        "query_id", key
    )
    report = found.join(words, key, "left").join(context, key, "left")
    return report.withColumn(
        "report",
        F.concat_ws("\n", "answer", F.concat(F.lit("Keywords: "), "keywords"), "context"),
    )
