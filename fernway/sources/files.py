"""Files in folders to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_text_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, text)`` of every file below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", F.col("content").cast("string").alias("text"))


def path_fields(files: DataFrame) -> DataFrame:
    """Folder names of article and ticket files as columns.

    ``…/<type>/<category>/KB-n.txt`` and ``…/<year>/<month>/TICK-n.txt``.
    """
    kb = r"([^/]+)/([^/]+)/KB-[0-9]+\.txt$"
    ticket = r"([0-9]{4})/([0-9]{2})/TICK-[0-9]+\.txt$"

    def part(pattern: str, group: int):
        return F.nullif(F.regexp_extract("path", pattern, group), F.lit(""))

    return files.select(
        "*",
        F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("file_id"),
        part(kb, 1).alias("path_type"),
        part(kb, 2).alias("path_category"),
        part(ticket, 1).cast("int").alias("path_year"),
        part(ticket, 2).cast("int").alias("path_month"),
    )


def _header(text: Column) -> Column:
    """The lines above the first rule line."""
    return F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n---", 2)[0]


def _field(name: str) -> Column:
    """Value of the first ``name: value`` line of the header; NULL if it is missing or blank."""
    found = F.regexp_extract("_head", rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.nullif(found, F.lit(""))


def _body(text: Column) -> Column:
    cut = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\n---[ \t]*\n", 2)
    return F.trim(F.get(cut, F.lit(1)), F.lit("\n "))


def parse_article(files: DataFrame) -> DataFrame:
    """Help article: eight header fields and the markdown body."""
    return files.withColumn("_head", _header(F.col("text"))).select(
        "path",
        _field("ID").alias("id"),
        _field("Type").alias("type"),
        _field("Category").alias("category"),
        _field("Subcategory").alias("subcategory"),
        _field("Title").alias("title"),
        F.transform(F.split(_field("Tags"), ","), lambda tag: F.trim(tag)).alias("tags"),
        F.try_to_timestamp(_field("Last Updated")).alias("last_updated"),
        F.try_to_timestamp(_field("Generated")).alias("generated"),
        _body(F.col("text")).alias("body"),
    )


def parse_ticket(files: DataFrame) -> DataFrame:
    """Support ticket: nine header fields, description and resolution."""

    def section(name: str, until: str):
        pattern = rf"(?s)\n---\s*\n{name}:\s*\n---\s*\n(.*?){until}"
        found = F.regexp_extract(F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n")), pattern, 1)
        return F.nullif(F.trim(found, F.lit("\n ")), F.lit(""))

    return files.withColumn("_head", _header(F.col("text"))).select(
        "path",
        _field("Ticket ID").alias("ticket_id"),
        _field("Customer ID").alias("customer_id"),
        _field("Subscription ID").alias("subscription_id"),
        _field("Category").alias("category"),
        _field("Priority").alias("priority"),
        _field("Status").alias("status"),
        F.try_to_timestamp(_field("Created")).alias("created"),
        _field("Agent ID").alias("agent_id"),
        F.try_to_timestamp(_field("Resolved")).alias("resolved"),
        section("DESCRIPTION", r"(?:\n---\s*\nRESOLUTION:|$)").alias("description"),
        section("RESOLUTION", r"$").alias("resolution"),
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, drop: list[str] = (), **options
) -> DataFrame:
    """CSV with a header and a stated schema; unwanted columns dropped, the rest as text.

    Files are split over tasks. Values with quoted line breaks need ``multiLine="true"``,
    which makes each file one task's work."""
    settings = {"header": "true", "quote": '"', "escape": '"', **options}
    read = spark.read.schema(schema).options(**settings).csv(path).drop(*drop)
    return read.select(*[F.col(c).cast("string") for c in read.columns])
