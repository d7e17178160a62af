"""Scalar helpers, as column expressions and as functions for SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession, functions as F

from .text import WHITESPACE

CONTEXT_TYPE = "array<struct<doc_uri:string,content:string>>"
# Layout of a trace; only the fields that are read are declared.
TRACE_TYPE = (
    "struct<request:string,response:string,spans:array<struct<span_type:string,"
    "start_time_ns:bigint,end_time_ns:bigint,"
    "outputs:array<struct<page_content:string,metadata:struct<doc_uri:string>>>>>>"
)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def in_set(value: Column, allowed: Iterable[str]) -> Column:
    """True where the value is one of a closed set; NULL counts as invalid."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def split_name(full_name: Column) -> Column:
    """``catalog.schema.table`` as a struct."""
    return F.struct(
        F.split_part(full_name, F.lit("."), F.lit(1)).alias("catalog"),
        F.split_part(full_name, F.lit("."), F.lit(2)).alias("schema"),
        F.split_part(full_name, F.lit("."), F.lit(3)).alias("table"),
    )


def endpoint_name(table: Column, suffix: str = "_endpoint") -> Column:
    return F.replace(F.concat(table, F.lit(suffix)), F.lit("_"), F.lit("-"))


def user_name(email: Column) -> Column:
    return F.replace(F.substring_index(email, "@", 1), F.lit("."), F.lit("_"))


def user_prefix(email: Column) -> Column:
    """First four characters of the user name and its length, three digits wide."""
    name = user_name(email)
    return F.concat(F.substring(name, 1, 4), F.format_string("%03d", F.length(name)))


def ns_to_seconds(start_ns: Column, end_ns: Column) -> Column:
    return (end_ns - start_ns) / F.lit(1e9)


def in_zone(timestamp: Column, zone: str) -> Column:
    """UTC timestamp shown as wall-clock time of a named zone."""
    return F.from_utc_timestamp(timestamp, zone)


def rating_values(assessments: Column) -> Column:
    return F.transform(assessments, lambda a: a["ratings"]["answer_correct"]["value"])


def kept_context(chunks: Column, ratings: Column) -> Column:
    """Retrieved chunks whose rating at the same index is ``"true"``.

    Cut to the shorter side; NULL when nothing is kept or a side is NULL.
    """
    common = F.least(F.size(chunks), F.size(ratings))
    pairs = F.slice(
        F.arrays_zip(chunks.alias("chunk"), ratings.alias("rating")), F.lit(1), common
    )
    kept = F.transform(F.filter(pairs, lambda p: p["rating"] == "true"), lambda p: p["chunk"])
    return F.when(
        chunks.isNotNull() & ratings.isNotNull() & (F.size(kept) > 0), kept
    )


def trace_context(trace_json: Column) -> Column:
    """Chunks returned by the last retriever span of a trace, in order."""
    spans = F.from_json(trace_json, TRACE_TYPE)["spans"]
    last = F.try_element_at(F.filter(spans, lambda s: s["span_type"] == "RETRIEVER"), F.lit(-1))
    return F.transform(
        last["outputs"],
        lambda o: F.struct(
            o["metadata"]["doc_uri"].alias("doc_uri"), o["page_content"].alias("content")
        ),
    )


def decode_base64(text: Column) -> Column:
    """Bytes of a base64 text; NULL where it is malformed."""
    return F.try_to_binary(text, F.lit("base64"))


def register_functions(spark: SparkSession) -> None:
    """Make the scalars callable from SQL text, as SQL functions that the optimizer sees through."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION count_words(body STRING) RETURNS INT
        COMMENT 'Words between white space'
        RETURN size(filter(split(body, r'{WHITESPACE}'), w -> w <> ''))""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION user_prefix(email STRING) RETURNS STRING
        COMMENT 'First four characters of the name part and its length'
        RETURN concat(left(replace(substring_index(email, '@', 1), '.', '_'), 4),
                      format_string('%03d', length(substring_index(email, '@', 1))))""")
