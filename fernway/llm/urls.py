"""URL filters: dated list entries joined to captures as of their fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import bind, packed, saved

ERA_DAYS = 32
# Fixed value: scheme, optional user part, host.
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot; empty if the text is no URL."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1)
    return F.regexp_replace(host, r"\.+$", "")


def parents(host: Column, most: int | None = None) -> Column:
    """The host and all domains above it that have two labels or more, and ``most`` at most."""
    labels = F.split(host, r"\.")
    last = F.greatest(F.size(labels) - 2, F.lit(0))
    first = F.lit(0) if most is None else F.least(F.greatest(F.size(labels) - most, F.lit(0)), last)
    return bind(
        labels,
        lambda own: F.transform(
            F.sequence(first, last), lambda i: F.array_join(F.slice(own, i + 1, F.size(own) - i), ".")
        ),
    )


def validity(entries: DataFrame, until: int) -> DataFrame:
    """Intervals in which a listed domain is active: ``pattern, since, upto`` (days; the last
    excluded).

    ``entries`` has ``pattern, day, action`` (``add`` or ``remove``). On one day the removal counts
    after the addition. Intervals without an end, and those that end later, end at ``until``.
    Entries with a null in any of the three are no entries.
    """
    valid = entries.where(
        "pattern IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')"
    )
    # One entry per pattern and day, so that a day's entries have one result.
    daily = valid.groupBy("pattern", "day").agg(
        F.max((F.col("action") == "remove").cast("int")).alias("removed")
    )
    then = F.lead("day").over(W.partitionBy("pattern").orderBy("day"))
    spans = daily.withColumn("upto", F.least(F.coalesce(then, F.lit(until)), F.lit(until)))
    return spans.where("removed = 0 AND day < upto").select(
        "pattern", F.col("day").alias("since"), "upto"
    )


def filter_urls(
    captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetch_day"
) -> DataFrame:
    """Which list entry, if any, was active for each capture when it was fetched.

    Returns ``doc`` (the input row), ``host``, ``listed``, ``matched`` (the most specific active
    pattern: the host or a domain above it) and ``since`` (the day from which it was active).

    Verdicts are made per host and day, not per capture, after partial sums, so a host of very
    many captures is one row per day. Intervals are cut at eras of 32 days; host-days meet
    them by pattern and era and compare days within it. Captures then meet verdicts by host
    and day. A null URL or one without a host, or a null day, is not listed. Domains of more labels than
    any listed one are left out from the start, so a host of very many labels makes few rows. Repeated
    captures each get their verdict; without captures there are no rows, without entries nothing is listed.
    """
    source = packed(captures).select(
        "doc",
        host_of(F.col(f"doc.{url}")).alias("host"),
        F.col(f"doc.{day}").cast("int").alias("_day"),
    )
    days = saved(
        source.where("host <> '' AND _day IS NOT NULL").select("host", "_day").distinct(), "url-days"
    )
    last = days.agg(F.max("_day")).first()[0]
    spans = validity(entries, (last or 0) + 1)

    def era(value: Column) -> Column:
        return F.floor(value / ERA_DAYS)

    cut = saved(
        spans.withColumn(
            "_era", F.explode(F.sequence(era(F.col("since")), era(F.col("upto") - 1)))
        ),
        "url-spans",
    )
    most = cut.agg(F.max(F.size(F.split("pattern", r"\.")))).first()[0]
    asked = days.withColumn("_era", era(F.col("_day"))).withColumn(
        "pattern", F.explode(parents(F.col("host"), most or 1))
    )
    found = (
        asked.join(cut, ["pattern", "_era"])
        .where("_day >= since AND _day < upto")
        .groupBy(F.col("host").alias("_host"), F.col("_day").alias("_on"))
        .agg(F.max(F.struct(F.char_length("pattern"), "pattern", "since")).alias("_best"))
    )
    verdicts = saved(
        found.select("_host", "_on", "_best.pattern", "_best.since"), "url-verdicts"
    )
    return source.join(
        verdicts, (F.col("host") == F.col("_host")) & (F.col("_day") == F.col("_on")), "left"
    ).select(
        "doc",
        "host",
        F.col("pattern").isNotNull().alias("listed"),
        F.col("pattern").alias("matched"),
        "since",
    )
