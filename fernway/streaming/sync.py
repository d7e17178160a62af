"""Triggered index sync: take what is new, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from ..operators.index import Embed, index_sync


def stream_index_sync(
    spark: SparkSession,
    source: str,
    schema: StructType,
    root: str,
    key: str,
    text: str,
    embed: Embed,
    files_per_batch: int = 1000,
) -> None:
    """Apply new Parquet files of ``source`` to the index at ``root``.

    The checkpoint below ``root`` remembers which files were taken. A repeated batch finds
    its digests in the index already and writes nothing, so replays do no harm. Of a key that
    comes in several files of a batch, the row of the latest file counts.
    """
    arrivals = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .select(key, text, F.struct("_metadata.file_modification_time", "_metadata.file_path")
                .alias("_from"))
    )
    newest = W.partitionBy(key).orderBy(F.desc("_from"))

    def apply(batch: DataFrame, _: int) -> None:
        latest = batch.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1")
        index_sync(batch.sparkSession, root, latest, key, text, embed, deletes=False)

    query = (
        arrivals.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
