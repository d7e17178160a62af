"""Document fingerprints by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.joins import fits_broadcast
from .common import bind, packed, saved, text_or_empty, words

GRAM, WINDOW = 3, 6
PIECE = 16  # code points; a longer word is all its substrings of that many
PLACES = 31  # bits for a position
LAST = (1 << PLACES) - 1
SPAN_ROWS = 2_000


def units(text: Column) -> Column:
    """Words, a word of more than ``PIECE`` code points as its substrings of that many from every
    code point on. So text without white space has units too, wherever a copy of it begins."""

    def pieces(word: Column) -> Column:
        return bind(
            F.split(word, ""),
            lambda c: F.transform(
                F.sequence(F.lit(1), F.size(c) - PIECE + 1),
                lambda i: F.array_join(F.slice(c, i, PIECE), ""),
            ),
        )

    def cut(w: Column) -> Column:
        parts = F.transform(
            w, lambda x: F.when(F.char_length(x) > PIECE, pieces(x)).otherwise(F.array(x))
        )
        return F.when(F.exists(w, lambda x: F.char_length(x) > PIECE), F.flatten(parts)).otherwise(w)

    return bind(words(text), cut)


def picks(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Chosen gram hashes with their positions, in order of position.

    The grams are runs of ``gram`` units (of all units in a shorter text), each hashed anew to 32
    bits by Spark's hash, which doesn't roll. The least hash of every ``window`` neighbouring grams
    is chosen, the rightmost among equals. Texts that share ``window + gram - 1`` units in a row share
    a choice, so do long words that share ``PIECE + window + gram - 2`` code points in a row. A choice
    is one number: the hash above, the position below and counted down, so that the least number is
    the rule.
    """

    def marked(w: Column) -> Column:
        size = F.least(F.size(w), F.lit(gram))
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - size),
            lambda i: F.hash(*[F.get(w, i + j) for j in range(gram)])
            .cast("long")
            .bitwiseAND(F.lit(0xFFFFFFFF)),
        )
        numbered = F.transform(
            hashes, lambda h, i: F.shiftleft(h, PLACES).bitwiseOR(F.lit(LAST) - i)
        )

        def least(e: Column) -> Column:
            starts = F.sequence(F.lit(0), F.greatest(F.size(e) - window, F.lit(0)))
            return F.array_distinct(
                F.transform(starts, lambda i: F.array_min(F.slice(e, i + 1, window)))
            )

        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) == 0, none).otherwise(bind(numbered, least))

    return bind(units(text), marked)


def hash_of(pick: Column) -> Column:
    return F.shiftrightunsigned(pick, PLACES)


def place_of(pick: Column) -> Column:
    """Position of the gram's first unit."""
    return F.lit(LAST) - pick.bitwiseAND(F.lit(LAST))


def hash_set(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda p: (hash_of(p) - (1 << 31)).cast("int")))


def shown(chosen: Column) -> Column:
    """Fingerprint as text: hash and position of every choice."""
    return F.array_join(
        F.transform(
            chosen,
            lambda p: F.concat(F.lower(F.hex(hash_of(p))), F.lit("@"), place_of(p).cast("string")),
        ),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes in two hash sets; 1 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of an edited text, and their likeness.

    The edited text has its last third of code points replaced by the first as many of the next
    document, by descending id, the last being followed by the first. Returns ``doc_id, n_chars,
    edited, chosen, edited_chosen, near_edited, near_next``.

    Ids are cut into ranges of equal width with about ``SPAN_ROWS`` rows. Texts are moved once, to
    the task of their range, where the next text is the next row; only the first document of
    each range is fetched for the range above it.

    Null text counts as empty. Rows of one id follow each other by text hash, equal rows are each
    other's next; null ids come last, as one range. A single document follows itself.
    """
    value = text_or_empty(F.col(f"doc.{text}"))
    source = packed(docs).select(
        F.col(f"doc.{doc_id}").alias("id"), value.alias("text"), F.xxhash64(value).alias("key")
    )
    low, high, n = source.agg(F.min("id"), F.max("id"), F.count("*")).first()
    low, high = low or 0, high or 0
    width = max(1.0, (high - low) / max(1, n // SPAN_ROWS))
    span = F.coalesce(F.floor((F.col("id").cast("double") - float(low)) / width), F.lit(-1))
    source = source.withColumn("_span", span)

    me = F.struct("id", "key")
    heads = saved(source.groupBy("_span").agg(F.max(me).alias("_head")), "winnow-heads")
    spans = W.orderBy(F.desc("_span"))
    first = F.first("_head").over(spans.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    links = saved(
        heads.select(
            F.col("_span").alias("_of"), F.coalesce(F.lead("_head").over(spans), first).alias("_h")
        ).select("_of", F.col("_h.id").alias("_id"), F.col("_h.key").alias("_key")),
        "winnow-links",
    )
    match = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    near = F.broadcast(links) if fits_broadcast(links) else links
    edges = saved(
        source.join(near, match).dropDuplicates(["_of"]).select(
            "_of", F.struct("text", hash_set(picks(F.col("text"))).alias("set")).alias("_edge")
        ),
        "winnow-edges",
    )
    inside = W.partitionBy("_span").orderBy(F.desc_nulls_last("id"), F.desc("key"))
    moved = source.repartition("_span").withColumn("set", hash_set(picks(F.col("text"))))
    donors = (
        moved.withColumn("_next", F.lead(F.struct("text", "set")).over(inside))
        .join(edges, F.col("_span") == F.col("_of"))
        .withColumn("_next", F.coalesce("_next", "_edge"))
        .withColumn("n_chars", F.char_length("text"))
        .withColumn("given", F.left(F.col("_next.text"), F.floor(F.col("n_chars") / 3).cast("int")))
        .withColumn("next_set", F.col("_next.set"))
    )
    keep = F.left("text", F.col("n_chars") - F.floor(F.col("n_chars") / 3).cast("int"))
    return (
        donors.select("id", "n_chars", "text", F.concat(keep, "given").alias("edited"), "next_set")
        .select(
            "*",
            picks(F.col("text")).alias("chosen"),
            picks(F.col("edited")).alias("edited_chosen"),
        )
        .select(
            "*",
            hash_set(F.col("chosen")).alias("_own"),
            hash_set(F.col("edited_chosen")).alias("_edited"),
        )
        .select(
            F.col("id").alias("doc_id"),
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited",
            "chosen",
            "edited_chosen",
            likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
            likeness(F.col("_own"), F.col("next_set")).alias("near_next"),
        )
    )
