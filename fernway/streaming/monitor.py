"""Quality figures of a running application, per time window."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

SUMS = ["n", "value_cents", "n_slow"]
PARTS = "window_start timestamp, window_end timestamp, event_type string, n long, value_cents long, n_slow long, last timestamp"
STATE = "open string"  # JSON: the sums and the end of every open window
FIGURES = "window_start timestamp, event_type string, n long, value_cents long, n_slow long, n_late long"


def _cents() -> Column:
    return F.floor(F.col("value") * 100)


def windowed_quality(events: DataFrame, window: str = "1 day") -> DataFrame:
    """Rows, sum of values and slow rows per window and kind, of a batch."""
    return events.groupBy(F.window("ts", window).alias("w"), "event_type").agg(
        F.count("*").alias("n"), F.sum(_cents()).alias("value_cents"), F.count_if(F.col("value") > 5).alias("n_slow")
    ).select(F.col("w.start").alias("window_start"), "event_type", *SUMS)


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each window and kind of a batch of rows, so that no hot window is exchanged whole."""
    for batch in batches:
        groups = batch.groupby(["window_start", "window_end", "event_type"], dropna=False, as_index=False)
        yield groups.agg(
            n=("ts", "size"), value_cents=("value_cents", "sum"), n_slow=("slow", "sum"), last=("ts", "max")
        )


def _kept(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Add a batch's sums to the open windows of a kind; rows of closed windows are counted as late."""
    mark = state.getCurrentWatermarkMs()
    open_ = json.loads(state.get[0]) if state.exists else {}
    open_ = {start: w for start, w in open_.items() if w["end"] > mark}
    rows = []
    for start, end, *sums in pd.concat(parts)[["window_start", "window_end", *SUMS]].itertuples(index=False):
        name, end, sums = start.isoformat(), end.timestamp() * 1000, [int(x) for x in sums]
        if end <= mark:
            rows.append((start, key[0], 0, 0, 0, sums[0]))
            continue
        window = open_.setdefault(name, {"end": end, "sums": [0, 0, 0]})
        window["sums"] = [a + b for a, b in zip(window["sums"], sums)]
        rows.append((start, key[0], *window["sums"], 0))
    state.update((json.dumps(open_),))
    yield pd.DataFrame(rows, columns=["window_start", "event_type", *SUMS, "n_late"])


def stream_quality_monitor(
    spark: SparkSession,
    source: str,
    schema: StructType,
    out: str,
    window: str = "1 day",
    files_per_batch: int = 1000,
    late: str = "7 days",
) -> DataFrame:
    """Tumbling windows over the event files at ``source``, a file or a folder; runs until all
    are read, and goes on with new files in the next run.

    Sums of the open windows of a kind are kept in the state store. A window is closed once events
    ``late`` after its end have been seen, and leaves the state with the next rows of its kind. Events of a closed window
    don't change its figures any more; they are counted in ``n_late``, so ``n`` and ``n_late`` of all windows
    add up to all events with a time. A batch writes a folder of its own, replaced if the batch is repeated; the
    result has the last figures of each window.
    """
    path = source.rstrip("/")
    events = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        # A pattern that only the path itself matches, since a stream takes no single file.
        .parquet(f"{path[:-1]}[{path[-1]}]")
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    parts = events.select(
        F.window("ts", window).alias("w"),
        "event_type",
        "ts",
        F.coalesce(_cents(), F.lit(0)).alias("value_cents"),
        F.coalesce(F.col("value") > 5, F.lit(False)).cast("long").alias("slow"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "ts", "value_cents", "slow")
    figures = (
        parts.mapInPandas(_summed, PARTS)
        .withWatermark("last", late)
        .groupBy("event_type")
        .applyInPandasWithState(_kept, FIGURES, STATE, "update", GroupStateTimeout.NoTimeout)
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/windows/batch={number}")

    spark.createDataFrame([], FIGURES).write.mode("overwrite").parquet(f"{out}/windows/batch=-1")
    query = (
        figures.writeStream.foreachBatch(keep)
        .outputMode("update")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    written = spark.read.option("basePath", f"{out}/windows").parquet(f"{out}/windows")
    last = F.max_by(F.struct(*SUMS), F.when(F.col("n") > 0, F.struct("batch", "n")))
    return (
        written.groupBy("window_start", "event_type")
        .agg(last.alias("s"), F.sum("n_late").alias("n_late"))
        .select("window_start", "event_type", *[F.coalesce(f"s.{c}", F.lit(0)).alias(c) for c in SUMS], "n_late")
    )
