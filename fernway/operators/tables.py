"""Table questions over visits, practices and quotes; keyed lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.joins import lookup_join
from ..functions.ordered import neighbour_value
from ..functions.text import literal_map, weighted_hits


def resolve_alias(value: Column, aliases: dict[str, str]) -> Column:
    """Canonical form of a free spelling; unknown spellings stay as they are."""
    return F.coalesce(literal_map(aliases)[F.lower(F.trim(value))], value)


def city_insurer_filter(
    visits: DataFrame,
    aliases: dict[str, str],
    city: str | None = None,
    insurer: str | None = None,
) -> DataFrame:
    """Visits of a city and an insurer, each given in any known spelling."""
    out = visits
    for column, wanted in (("city", city), ("insurer", insurer)):
        if wanted is not None:
            target = aliases.get(wanted.strip().lower(), wanted)
            out = out.where(F.col(column) == target)
    return out


def range_filter(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows with a value above ``low`` and below ``high``, each if given."""
    if low is not None:
        df = df.where(F.col(column) > low)
    if high is not None:
        df = df.where(F.col(column) < high)
    return df


def note_severity(
    notes: DataFrame, key: str, text: str, weights: dict[str, int], k: int
) -> DataFrame:
    """The ``k`` notes with the greatest weight of listed terms in their whole text.

    The weights are a constant of the plan, so scoring needs no join and no shuffle. The
    filter follows the limit, which is equal and scores each text once.
    """
    scored = notes.select(key, weighted_hits(F.col(text), weights).alias("severity"))
    return scored.orderBy(F.desc("severity"), key).limit(k).where("severity > 0")


def visits_within(visits: DataFrame, as_of: str, days: int) -> DataFrame:
    """Visits in the ``days`` days up to ``as_of``, or after it if ``days`` is negative."""
    day = F.lit(as_of).cast("date")
    if days >= 0:
        return visits.where(
            (F.col("visit_date") > F.date_sub(day, days)) & (F.col("visit_date") <= day)
        )
    return visits.where(
        (F.col("visit_date") > day) & (F.col("visit_date") <= F.date_add(day, -days))
    )


def not_seen_since(
    patients: DataFrame, visits: DataFrame, key: str, as_of: str, months: int
) -> DataFrame:
    """Patients without a visit in the last ``months`` months."""
    day = F.lit(as_of).cast("date")
    recent = visits.where(
        (F.col("visit_date") > F.add_months(day, -months)) & (F.col("visit_date") <= day)
    )
    return patients.join(recent.select(key).distinct(), key, "left_anti")


def client_enrich(
    df: DataFrame, file_column: str, files: list[str], clients: list[str]
) -> DataFrame:
    """Add the client of a document file from two parallel lists."""
    pairs = (
        df.sparkSession.range(1)
        .select(F.explode(F.arrays_zip(
            F.array(*map(F.lit, files)).alias("file"), F.array(*map(F.lit, clients)).alias("client")
        )).alias("p"))
        .select(F.col("p.file").alias(file_column), F.col("p.client").alias("client"))
    )
    return df.join(F.broadcast(pairs), file_column, "left")


def duplicate_keys(features: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a lookup table holds more than once."""
    return features.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def feature_lookup(
    requests: DataFrame, features: DataFrame, keys: list[str], check: bool = False
) -> DataFrame:
    """Columns of a feature table by its (composite) primary key.

    The table may be of any size: Spark broadcasts it by its own size figures, at planning
    or, from measured shuffle output, at run time.
    """
    if check and not duplicate_keys(features, keys).isEmpty():
        raise ValueError(f"feature table has several rows for one key of {keys}")
    return requests.join(features, keys, "left")


def visit_practice_join(visits: DataFrame, practices: DataFrame) -> DataFrame:
    """Visits with their practice and with how many in-network practices they could use.

    Practices that share city and insurer are counted before the join, so no visit is
    multiplied by them. Few practices may serve most visits: see ``lookup_join``.
    """
    by_key = practices.select(
        "practice_id",
        "practice_name",
        F.col("city").alias("practice_city"),
        F.col("insurer").alias("practice_insurer"),
        "network_status",
    )
    options = practices.groupBy("city", "insurer").agg(
        F.count_if(F.col("network_status") == "In Network").alias("n_in_network")
    )
    joined = lookup_join(visits, by_key, ["practice_id"], "left")
    joined = lookup_join(joined, options, ["city", "insurer"], "left")
    return joined.select(
        "visit_id",
        "patient",
        "practice_name",
        "network_status",
        (F.col("practice_city") == F.col("city")).alias("same_city"),
        (F.col("practice_insurer") == F.col("insurer")).alias("same_insurer"),
        F.coalesce("n_in_network", F.lit(0)).alias("n_in_network"),
    )


def visits_per_patient(visits: DataFrame) -> DataFrame:
    """Number of visits and the sorted set of reasons (a closed set, so it stays short)."""
    return visits.groupBy("patient").agg(
        F.count("*").alias("n_visits"),
        F.array_sort(F.collect_set("reason")).alias("reasons"),
    )


def mode_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key; the lowest value on a tie."""
    counts = df.groupBy(key, value).agg(F.count(value).alias("_n"))
    best = W.partitionBy(key).orderBy(F.desc("_n"), F.asc_nulls_last(value))
    ranked = counts.withColumn("_rank", F.row_number().over(best))
    return ranked.where("_rank = 1").select(key, value)


def more_than(df: DataFrame, key: str, n: int, when: Column) -> DataFrame:
    """Keys with more than ``n`` rows that satisfy a condition."""
    return df.where(when).groupBy(key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > n)


def attribute_per_key(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The one value of each attribute of a key; ``many_<name>`` marks keys with several."""
    found = [F.min(v).alias(v) for v in values]
    several = [(F.min(v) != F.max(v)).alias(f"many_{v}") for v in values]
    return df.groupBy(key).agg(*found, *several)


def latest_note(visits: DataFrame, key: str, note: str) -> DataFrame:
    """Note of the latest visit per key, by date and then id.

    Map tasks forward one row per key, so texts that lose aren't moved.
    """
    order = W.partitionBy(key).orderBy(F.desc("visit_date"), F.desc("visit_id"))
    ranked = visits.withColumn("_rn", F.row_number().over(order)).where("_rn = 1")
    return ranked.select(key, note, "visit_date")


def latest_quote(quotes: DataFrame) -> DataFrame:
    """Latest close per symbol, rounded, with the close before it and the day's figures.

    Two rows per symbol survive the ranking, and map tasks forward no more than that.
    """
    ranked = quotes.withColumn(
        "_rn", F.row_number().over(W.partitionBy("symbol").orderBy(F.desc("day")))
    ).where("_rn <= 2")
    return ranked.groupBy(F.upper("symbol").alias("symbol")).agg(
        F.round(F.max_by("close", "day"), 2).alias("price"),
        F.round(F.max(F.when(F.col("_rn") == 2, F.col("close"))), 2).alias("previous_close"),
        F.round(F.max_by("day_high", "day"), 2).alias("day_high"),
        F.round(F.max_by("day_low", "day"), 2).alias("day_low"),
        F.max_by("volume", "day").alias("volume"),
    )


def pct_drop(quotes: DataFrame, percent: float) -> DataFrame:
    """Days on which the close fell by more than ``percent`` from the close before it.

    A symbol has one row per day, so the calendar bounds what one task orders.
    """
    by_day = W.partitionBy("symbol").orderBy("day")
    with_prev = quotes.withColumn("previous_close", F.lag("close").over(by_day))
    change = (F.col("close") - F.col("previous_close")) / F.col("previous_close") * 100
    return with_prev.select(
        "symbol", "day", "close", "previous_close", F.round(change, 6).alias("change_pct")
    ).where((F.col("previous_close") > 0) & (change < -percent))


def latest_version(models: DataFrame, name: str, version: str) -> DataFrame:
    """Highest version number per name, at least 1."""
    number = F.expr(f"try_cast(`{version}` AS INT)")
    return models.groupBy(name).agg(F.greatest(F.max(number), F.lit(1)).alias("latest_version"))


def top_k(df: DataFrame, order: Iterable[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def company_profile(quotes: DataFrame, articles: DataFrame) -> DataFrame:
    """One row per company: symbol, quote summary, article summary.

    ``articles`` has ``(symbol, company_name, article_id, n_chars)``; both sides are
    reduced to one row per symbol before they meet.
    """
    latest = latest_quote(quotes).select(
        "symbol",
        F.format_string(
            "close %.2f, high %.2f, low %.2f, volume %d", "price", "day_high", "day_low", "volume"
        ).alias("stock_summary"),
    )
    about = articles.groupBy("symbol").agg(
        F.min("company_name").alias("company_name"),
        F.count("*").alias("n_articles"),
        F.max_by("article_id", F.struct("n_chars", "article_id")).alias("longest_article"),
    )
    return latest.join(about, "symbol", "left").select(
        "symbol",
        "company_name",
        "stock_summary",
        F.format_string(
            "%d articles, longest is %d", F.coalesce("n_articles", F.lit(0)), "longest_article"
        ).alias("article_summary"),
    )


def conversation_history(turns: DataFrame, page_turns: int = 64) -> tuple[DataFrame, DataFrame]:
    """Earlier turns and the last message for every turn, in two linear-size tables.

    The full list of earlier turns per turn grows with the square of a conversation. It is
    therefore cut into pages of ``page_turns`` turn numbers. The first result holds, per
    turn, the earlier turns of its own page, the message before it (also across pages) and
    its page number; the second holds every page in full, so a reader of turn t needs the
    pages below its own plus its own row. Conversations shorter than a page need no second
    table.
    """
    page = F.expr(f"turn div {int(page_turns)}")
    entry = F.struct("turn", "role", "text")
    ranges = F.expr("turn div 4096")
    last = neighbour_value(turns, ["conv_id"], "turn", ranges, {"last_message": "text"})
    inside = (
        W.partitionBy("conv_id", "page").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    )
    own = last.withColumn("page", page).withColumn(
        "page_history", F.collect_list(entry).over(inside)
    )
    pages = turns.groupBy("conv_id", page.alias("page")).agg(
        F.array_sort(F.collect_list(entry)).alias("turns")
    )
    return own.select("conv_id", "turn", "page", "page_history", "last_message"), pages


def full_history(asked: DataFrame, turns: DataFrame, page_turns: int = 64) -> DataFrame:
    """All earlier turns of each asked ``conv_id, turn``, of all pages, oldest first.

    Only the asked turns get their whole history, since that of every turn grows with the square
    of a conversation.
    """
    own, pages = conversation_history(turns, page_turns)
    wanted = own.join(asked.select("conv_id", "turn").distinct(), ["conv_id", "turn"])
    earlier = wanted.select("conv_id", "turn", F.col("page").alias("_page")).join(pages, "conv_id")
    before = earlier.where("page < _page").groupBy("conv_id", "turn").agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("page", "turns")))["turns"]).alias("_before")
    )
    none = F.expr("filter(page_history, h -> false)")
    return wanted.join(before, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.concat(F.coalesce("_before", none), "page_history").alias("history")
    )
