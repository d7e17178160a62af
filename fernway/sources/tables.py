"""Tables: creating, writing, previewing, and making nested columns plain."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

COMPLEX = (T.ArrayType, T.MapType, T.StructType)


def rows_to_df(
    spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType | str
) -> DataFrame:
    """A handful of local records as a DataFrame; the schema is stated, not guessed."""
    return spark.createDataFrame(list(rows), schema)


def write_table(
    df: DataFrame, target: str, mode: str = "error", partition_by: list[str] = ()
) -> DataFrame:
    """Write a catalog table, or Parquet files if ``target`` is a path; return its reader."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
        return df.sparkSession.read.schema(df.schema).parquet(target)
    writer.saveAsTable(target)
    return df.sparkSession.table(target)


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def create_table(
    spark: SparkSession,
    table: str,
    columns: T.StructType | str,
    location: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Create a Parquet table if it is missing."""
    ddl = columns if isinstance(columns, str) else columns.toDDL()
    place = f" LOCATION '{location}'" if location else ""
    listed = ", ".join(f"'{k}'='{v}'" for k, v in (properties or {}).items())
    settings = f" TBLPROPERTIES ({listed})" if listed else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING PARQUET{place}{settings}")


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    listed = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def trace_source(spans: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row per trace from a table of spans.

    Spans are reduced to counts, times and the first chat span while they are read, so
    a trace with very many spans costs no more memory than a short one. Where span ids are whole
    numbers the order of chat spans, by start and id, is one decimal number (starts up to 4.9e18), which is
    summed up in a hash table; otherwise spans are sorted by trace.
    """
    is_chat = F.col("span_type") == "CHAT_MODEL"
    if isinstance(spans.schema["span_id"].dataType, T.IntegralType):
        start, span = F.col("start_ns").cast("decimal(19,0)"), F.coalesce("span_id", F.lit(0)).cast("decimal(19,0)")
        place = (start * F.lit(Decimal(2 * 10**19)) + span).cast("decimal(38,0)")
    else:
        place = F.struct("start_ns", "span_id")
    place = F.when(is_chat, place)
    traces = spans.groupBy("trace_id").agg(
        F.count("*").alias("n_spans"),
        F.count_if(F.col("span_type") == "RETRIEVER").alias("n_retriever"),
        F.min("start_ns").alias("start_ns"),
        F.max("end_ns").alias("end_ns"),
        F.min(F.when(is_chat, F.col("start_ns"))).alias("chat_start_ns"),
        F.min_by("end_ns", place).alias("chat_end_ns"),
    )
    out = traces.select(
        "trace_id",
        "n_spans",
        "n_retriever",
        "start_ns",
        "end_ns",
        "chat_start_ns",
        "chat_end_ns",
    )
    return out if max_rows is None else out.orderBy("trace_id").limit(max_rows)


def to_json_text(value: Column, data_type: T.DataType) -> Column:
    """JSON text of a nested value; a plain value as text. NULL stays NULL."""
    return F.to_json(value) if isinstance(data_type, COMPLEX) else value.cast("string")


def stringify_complex(df: DataFrame) -> DataFrame:
    """Every column as text; nested columns as JSON."""
    return df.select(
        *[to_json_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)
