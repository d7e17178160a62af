"""Conversations as one marked text each, and the way back, in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bind, text_or_empty

# Control strings of the template. Each begins with < or [, which stands nowhere else in one, and
# none begins another; so one can't arise where a text and a control string meet.
BEGIN, END = "<s>", "</s>"
OPEN, SAYS, ALSO, CLOSE = "[TURN]", "[SAYS]", "[ALSO]", "[/TURN]"
# Marks of the template and those of a common instruction format, with or without a slash.
TAILS = r"/?(?:s>|INST\]|TURN\]|SAYS\]|ALSO\])"

PAGE_BITS = 6  # turns that differ above these bits are sorted and merged apart
BLOCKS = "array<struct<role:string,texts:array<string>>>"
PIECES = "array<struct<text:string,loss:boolean>>"
SPANS = "array<struct<start:bigint,length:bigint>>"


def escape(text: Column) -> Column:
    """One more backslash inside whatever reads as a control string, with backslashes or without."""
    return F.regexp_replace(text, r"([<\[])(\\*)(" + TAILS + ")", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(" + TAILS + ")", "$1$2$3")


def _merged(said: Column) -> Column:
    """Sorted turns as blocks: neighbours with one role are one block of several texts."""

    def add(blocks: Column, turn: Column) -> Column:
        last = F.element_at(blocks, -1)
        longer = F.struct(turn["role"].alias("role"), F.array_append(last["texts"], turn["text"]).alias("texts"))
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return (
            F.when(
                (F.size(blocks) > 0) & (F.try_element_at(blocks, F.lit(-1))["role"] == turn["role"]),
                F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(longer)),
            )
            .otherwise(F.array_append(blocks, fresh))
            .cast(BLOCKS)
        )

    return F.aggregate(said, F.array().cast(BLOCKS), add)


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _pieces(blocks: Column, follows: Column, goes_on: Column, learned: str) -> Column:
    """Marks and escaped texts of a page in order, and which of them are learned.

    The first block has no opening mark where it goes on with the role of the page before, the
    last one no closing mark where the next page goes on with it.
    """
    no = F.lit(False)

    def block(b: Column, i: Column) -> Column:
        goes = (i == 0) & follows
        opening = F.when(goes, F.lit(ALSO)).otherwise(F.concat(F.lit(OPEN), escape(b["role"]), F.lit(SAYS)))
        closing = F.when((i == F.size(blocks) - 1) & goes_on, F.lit("")).otherwise(F.lit(CLOSE))
        texts = F.transform(
            b["texts"],
            lambda t, j: F.array(
                _piece(F.when(j == 0, opening).otherwise(F.lit(ALSO)), no),
                _piece(escape(t), b["role"] == learned),
            ).cast(PIECES),
        )
        return F.concat(F.flatten(texts), F.array(_piece(closing, no)).cast(PIECES))

    return F.flatten(F.transform(blocks, block))


def _spans(pieces: Column) -> Column:
    """First byte and number of bytes of the learned pieces."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))

    def add(state: Column, piece: Column) -> Column:
        n = F.octet_length(piece["text"]).cast("long")
        span = F.struct(state["at"].alias("start"), n.alias("length"))
        spans = F.when(piece["loss"], F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((state["at"] + n).alias("at"), spans.cast(SPANS).alias("spans"))

    return F.aggregate(pieces, start, add)["spans"]


def format_chats(turns: DataFrame, *, learned: str = "assistant") -> DataFrame:
    """One row per ``conv_id``: ``formatted`` and ``loss``, the spans of it that are learned.

    ``turns`` has ``conv_id``, ``turn`` (an integer), ``role`` and ``text``; other columns play no
    part. A conversation reads ``<s>``, its blocks, ``</s>``; a block reads
    ``[TURN]role[SAYS]text[/TURN]``, and neighbouring turns of one role are one block with
    ``[ALSO]`` between their texts. Roles and texts are escaped, so that no control string is in
    them; ``read_turns`` gets back every turn. ``loss`` holds the first byte and the number of bytes
    of each text of the role ``learned`` in the UTF-8 of ``formatted``, in order, empty texts included.

    Null roles and texts are empty. Turns with one number are ordered by role and text, null
    numbers come first, repeated rows are turns of their own, and rows with a null ``conv_id`` are
    one conversation. An empty table gives no rows.

    Turns are sorted and merged in pages of 64 turn numbers, so the parts of a long conversation
    are made in many tasks; only its finished pages meet in one, as they must in one text. Rows
    that repeat one turn number are in one page, however many they are.
    """
    said = turns.select(
        "conv_id",
        F.shiftright(F.col("turn").cast("long"), PAGE_BITS).alias("page"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            text_or_empty(F.col("role")).alias("role"),
            text_or_empty(F.col("text")).alias("text"),
        ).alias("said"),
    )
    pages = (
        said.groupBy("conv_id", "page")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .select("conv_id", "page", _merged(F.col("said")).alias("blocks"))
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.col("page").asc_nulls_first())
    first, last = F.get("blocks", F.lit(0))["role"], F.element_at("blocks", -1)["role"]
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        pages.withColumn("follows", F.coalesce(F.lag(last).over(in_order) == first, F.lit(False)))
        .withColumn("goes_on", F.coalesce(F.lead(first).over(in_order) == last, F.lit(False)))
        .select(
            "conv_id", "page", _pieces(F.col("blocks"), F.col("follows"), F.col("goes_on"), learned).alias("pieces")
        )
        .select(
            "conv_id",
            "page",
            F.array_join(F.col("pieces.text"), "").alias("body"),
            _spans(F.col("pieces")).alias("spans"),
        )
        .withColumn(
            "at",
            F.coalesce(F.sum(F.octet_length("body").cast("long")).over(before), F.lit(0).cast("long")) + len(BEGIN),
        )
    )
    spans = F.transform(
        "spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), s["length"].alias("length"))
    )
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("page", "body", spans.alias("spans")))).alias("parts")
    )
    return whole.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.col("parts.body"), ""), F.lit(END)).alias("formatted"),
        F.flatten(F.col("parts.spans")).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of ``role`` and ``text`` of all turns of a formatted conversation."""

    def block(part: Column) -> Column:
        return bind(
            F.split(part, r"\[SAYS\]"),
            lambda halves: bind(
                unescape(halves[0]),
                lambda role: F.transform(
                    F.split(F.split(halves[1], r"\[/TURN\]")[0], r"\[ALSO\]"),
                    lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
                ),
            ),
        )

    return bind(
        F.split(formatted, r"\[TURN\]"),
        lambda parts: F.flatten(F.transform(F.slice(parts, 2, F.size(parts)), block)),
    )


def read_learned(formatted: Column, loss: Column) -> Column:
    """Array of the texts that the spans cover, as they were before escaping."""
    return bind(
        formatted.cast("binary"),
        lambda data: F.transform(
            loss,
            lambda s: unescape(
                F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
            ),
        ),
    )
