"""Order-dependent computations that do not need one task per key.

A plain window sends all rows of a key, or of the whole table when there is no
key, to one task. Here a key is first cut into ranges of its order column; rows
are handled inside a range and only one small row per range is handled per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import stored


def neighbour_value(
    df: DataFrame,
    keys: list[str],
    order: str,
    span: Column,
    values: dict[str, str],
    *,
    following: bool = False,
) -> DataFrame:
    """Add the previous (or following) row's values, as ``lag``/``lead`` by one do.

    ``span`` maps the order column, monotonically, to an integer range number;
    ``values`` maps a new column name to the column whose neighbour it holds.
    ``order`` must be unique within a key.
    """
    ranged = df.withColumn("_span", span)
    inside = W.partitionBy(*keys, "_span").orderBy(F.col(order))
    step = F.lead if following else F.lag
    edge = F.min_by if following else F.max_by
    value = F.struct(*values.values())
    # Which range lies next to which: two numbers per range are all that one task sorts.
    across = W.partitionBy(*keys).orderBy("_span")
    links = ranged.select(*keys, "_span").distinct().withColumn(
        "_near", step("_span").over(across)
    )
    edges = ranged.groupBy(*keys, F.col("_span").alias("_near")).agg(
        edge(value, order).alias("_outer")
    )
    outer = links.join(edges, [*keys, "_near"]).drop("_near")
    joined = ranged.withColumn("_inner", step(value).over(inside)).join(
        outer, [*keys, "_span"], "left"
    )
    source = F.coalesce("_inner", "_outer")
    for new, old in values.items():
        joined = joined.withColumn(new, source[old])
    return joined.drop("_span", "_inner", "_outer")


def dense_number(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Number all rows 0, 1, 2, … by ``order``, which must be unique.

    One exchange: rows are cut into ranges of the order columns and sorted there. They are stored with
    their range and place, so neither changes when a task is repeated; then the ranges are counted,
    and a row's number is the sum of the ranges before plus its place. There are as many ranges as shuffle
    partitions, which bounds what is summed in one task and sent to all.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    kept = stored(placed.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    # The id holds the partition above the lower 33 bits, the place below.
    span, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    before = W.orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    counts = kept.groupBy(span.alias("_span")).agg(F.count("*").alias("_n"))
    starts = counts.select("_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    located = kept.withColumn("_span", span).join(F.broadcast(starts), "_span")
    return located.withColumn(name, F.col("_start") + place).drop("_span", "_start", "_id")
