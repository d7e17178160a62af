"""What changed between two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.joins import lookup_join
from ..session import stored

BUCKETS = 1 << 16  # leaves of a digest tree; a power of 256
FAN = 8  # bits: nodes that share one node above


def content_hash(*columns: str):
    """Digest of the content columns; NULL and empty text differ."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _digested(df: DataFrame, key: str, content: list[str], buckets: int) -> DataFrame:
    return df.select(
        key,
        content_hash(*content).alias("hash"),
        F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"),
    )


def digest_tree(df: DataFrame, key: str, content: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n, low, high)``: rows and sums of row digests for each bucket of keys.

    These are the leaves; sums of sums make the nodes above. One row for each bucket and task is
    exchanged, so a tree costs a scan, and the tree of a snapshot can be stored with it.
    """
    return _leaves(_digested(df, key, content, buckets), key)


def _leaves(rows: DataFrame, key: str) -> DataFrame:
    # Key and content by digest, as two numbers of 60 bits.
    row = F.sha2(F.concat_ws("/", F.xxhash64(key).cast("string"), F.xxhash64(key, F.lit(1)).cast("string"), "hash"), 256)
    part = lambda at: F.conv(F.substring("_d", at, 15), 16, 10).cast("decimal(20,0)")
    return rows.withColumn("_d", row).groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(part(1)).alias("low"), F.sum(part(16)).alias("high")
    )


def unequal_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Buckets of two digest trees that differ: the nodes above are compared first, then the leaves
    below those that differ."""
    figures = ["n", "low", "high"]

    def differ(a: DataFrame, b: DataFrame, node: str) -> DataFrame:
        minus = b.select(node, *[(-F.col(c)).alias(c) for c in figures])
        sums = a.select(node, *figures).union(minus).groupBy(node).agg(*[F.sum(c).alias(c) for c in figures])
        return sums.where("n <> 0 OR low <> 0 OR high <> 0").select(node)

    old, new = (t.withColumn("node", F.shiftright("bucket", FAN)) for t in (old, new))
    # A 256th of the leaves at most.
    nodes = stored(differ(old, new, "node"), "unequal-nodes")
    return differ(*(lookup_join(t, nodes, ["node"], "left_semi") for t in (old, new)), "bucket")


def table_snapshot_changes(
    old: DataFrame,
    new: DataFrame,
    key: str,
    content: list[str],
    *,
    buckets: int = BUCKETS,
    old_tree: DataFrame | None = None,
    new_tree: DataFrame | None = None,
) -> DataFrame:
    """Insert, update and delete rows from one snapshot to the next.

    Digest trees of both snapshots (built here unless given) say which buckets of keys differ. Only
    keys and digests of rows in those are exchanged and joined; equal buckets are not
    compared row by row. Keys must differ and not be null. Choose ``buckets`` so that most of them hold
    no change, and the same for stored trees.
    """
    def digested(df: DataFrame, tree: DataFrame | None):
        rows = _digested(df, key, content, buckets)
        if tree is None:
            # Texts are read once; their digests serve the tree and the join.
            rows = stored(rows, "digests")
            tree = _leaves(rows, key)
        return rows, tree

    (old, old_tree), (new, new_tree) = digested(old, old_tree), digested(new, new_tree)
    differ = stored(unequal_buckets(old_tree, new_tree), "unequal-buckets")

    def rows(df: DataFrame, name: str) -> DataFrame:
        return lookup_join(df, differ, ["bucket"], "left_semi").select(key, F.col("hash").alias(name))

    change = (
        F.when(F.col("old_hash").isNull(), "insert")
        .when(F.col("new_hash").isNull(), "delete")
        .when(F.col("old_hash") != F.col("new_hash"), "update")
    )
    return (
        rows(old, "old_hash")
        .join(rows(new, "new_hash"), key, "full_outer")
        .select(key, change.alias("change"), "new_hash")
        .where(F.col("change").isNotNull())
    )


def delete_detect(indexed: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys that are still indexed but gone from the source."""
    return indexed.select(key).join(source.select(key), key, "left_anti")
