"""An embedding table kept in sync with its source.

Layout below ``root``: ``changes/v=<n>`` lists the keys that sync n found changed,
``rows/v=<n>`` holds their new rows, or marks them deleted, and ``commits/v=<n>`` holds one
row once that is complete. A sync writes new folders only,
so readers and failed runs do not disturb each other; a sync that failed is simply run
again. Reading keeps each key's newest committed row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.joins import lookup_join
from ..sources.changes import content_hash

Embed = Callable[[DataFrame], DataFrame]


def committed_version(spark: SparkSession, root: str) -> int:
    """Newest complete version; 0 when there is no index yet."""
    try:
        commits = spark.read.schema("version int").parquet(f"{root}/commits/*")
    except AnalysisException:
        return 0
    return commits.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_index(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The index as of a version: newest row per key, deletions removed.

    The last complete rewrite stays where it is, without the keys changed since, which are
    broadcast if measured to be few. Only the changes are ranked, by the literal ``= 1``.
    """
    newest = committed_version(spark, root) if version is None else version
    if newest == 0:
        raise FileNotFoundError(f"no index at {root}")
    base = _base(spark, root, newest)
    stored = spark.read.option("basePath", f"{root}/rows")
    whole = stored.parquet(f"{root}/rows/v={base}").drop("deleted")
    if newest == base:
        return whole
    later = stored.parquet(*[f"{root}/rows/v={v}" for v in range(base + 1, newest + 1)])
    order = W.partitionBy("id").orderBy(F.desc("v"))
    latest = later.withColumn("_rn", F.row_number().over(order)).where("_rn = 1 AND NOT deleted")
    untouched = lookup_join(whole, later.select("id").distinct(), ["id"], "left_anti")
    return untouched.unionByName(latest.drop("_rn", "deleted"))


def _base(spark: SparkSession, root: str, version: int) -> int:
    """The last complete rewrite at or before ``version``."""
    commits = spark.read.schema("version int, full boolean").parquet(f"{root}/commits/*")
    return commits.where((F.col("version") <= version) & F.col("full")).agg(
        F.max("version")
    ).first()[0]


def _commit(spark: SparkSession, root: str, version: int, full: bool) -> None:
    spark.range(1).select(
        F.lit(version).alias("version"), F.lit(full).alias("full")
    ).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/v={version}")


def index_sync(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    key: str,
    text: str,
    embed: Embed,
    *,
    deletes: bool = True,
) -> int:
    """Create the index, or apply what changed in ``source``; returns the version.

    ``embed`` adds column ``embedding`` and sees changed rows only. The comparison moves
    keys and digests, never texts or vectors. With ``deletes=False`` rows absent from
    ``source`` stay, as for a batch of additions. A sync without changes writes nothing.
    Keys must be unique and not null in ``source``; others raise ``ValueError``.
    """
    version = committed_version(spark, root)
    uses = source.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
    if not uses.where("n > 1 OR id IS NULL").isEmpty():
        raise ValueError(f"{key} is null or not unique")
    rows = source.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn(
        "hash", content_hash("text")
    )
    fresh = version + 1
    target = f"{root}/rows/v={fresh}"
    layout = ["id", "text", "hash", "embedding", "deleted"]
    if version == 0:
        created = embed(rows).withColumn("deleted", F.lit(False)).select(*layout)
        created.write.mode("overwrite").parquet(target)
        _commit(spark, root, fresh, full=True)
        return fresh
    current = read_index(spark, root, version)
    known = current.select("id", F.col("hash").alias("old_hash"))
    changes = (
        rows.select("id", "hash")
        .join(known, "id", "full_outer" if deletes else "left")
        .select(
            "id",
            F.col("hash").isNull().alias("gone"),
            (~F.equal_null("hash", "old_hash")).alias("differs"),
        )
        .where("differs")
        .select("id", "gone")
    )
    # Used three times below, so the comparison is written once.
    diff = f"{root}/changes/v={fresh}"
    changes.write.mode("overwrite").parquet(diff)
    changes = spark.read.schema("id " + rows.schema["id"].dataType.simpleString() + ", gone boolean")
    changes = changes.parquet(diff)
    if changes.isEmpty():
        return version
    changed = rows.join(changes.where("NOT gone").select("id"), "id", "left_semi")
    upserts = embed(changed).withColumn("deleted", F.lit(False)).select(*layout)
    removed = changes.where("gone").select("id")
    for field in upserts.schema.fields[1:]:
        value = F.lit(True) if field.name == "deleted" else F.lit(None).cast(field.dataType)
        removed = removed.withColumn(field.name, value)
    upserts.unionByName(removed).write.mode("overwrite").parquet(target)
    _commit(spark, root, fresh, full=False)
    return fresh


def compact(spark: SparkSession, root: str) -> int:
    """Rewrite the index as one complete version, so reads stop merging old ones."""
    version = committed_version(spark, root)
    whole = read_index(spark, root, version).drop("v").withColumn("deleted", F.lit(False))
    whole.write.mode("overwrite").parquet(f"{root}/rows/v={version + 1}")
    _commit(spark, root, version + 1, full=True)
    return version + 1
