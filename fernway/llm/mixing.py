"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import packed, saved, word_count

# Fixed value: the fraction of the golden ratio, to 18 digits.
GOLDEN = Decimal("0.618033988749894848")
WEIGHTS = (5.0, 2.0, 1.0)
MAX_SOURCES = 100_000
BUCKET_ROWS = 20_000
CELLS = 4096


def fill_targets(
    sizes: list[int], weights: list[float], share: float, most: float
) -> list[float]:
    """Split ``share`` of all words by weight; a source stops at ``most`` times its own words
    and what it can't take goes to the others by weight, until none is above."""
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    targets = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] >= most * sizes[i] * total}
        for i in full or open_:
            targets[i] = most * sizes[i] if full else left * weights[i] / total
        if not full:
            break
        left -= sum(targets[i] for i in full)
        open_ -= full
    return targets


def plan_sources(sized: DataFrame, weights, share: float, most: float, slots: int, block: int):
    """One small row per source: size, target, number of blocks, and its part of [0, 1).

    The source names are a bounded list (``MAX_SOURCES``); more raise an error.
    """
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    listed = rows.limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # Strings in Python compare by code point.
    listed.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in listed]
    each = [weights[i % len(weights)] for i in range(len(listed))]
    targets = fill_targets(sizes, each, share, most)
    words = max(1, min(block, int(sum(targets)) // slots))
    blocks = [-(-s // words) for s in sizes]
    wanted = [t * b / s if s else 0.0 for t, b, s in zip(targets, blocks, sizes)]
    total, low, out = sum(wanted), 0.0, []
    for row, size, target, count, slot in zip(listed, sizes, targets, blocks, wanted):
        high = low + (slot / total if total else 0.0)
        out.append((row["source"], size, target, count, low, high))
        low = high
    n_rows = sum(r["n"] for r in listed)
    return out, round(total), max(1, n_rows // BUCKET_ROWS)


def schedule(spark, sources: list[tuple], total: int, most: float) -> DataFrame:
    """Slots with their source, block and epoch.

    Slot t stands at the fractional part of t times the golden ratio, in decimal arithmetic, so
    reruns agree. Points and sources meet on cells of [0, 1), without comparing all pairs. A slot's
    rank within its source is a count per range of slots, summed over the ranges before, plus its
    rank within the range; so one task never sorts all slots of a source. The ranks walk through
    the source's blocks, epoch after epoch; slots beyond ``most`` epochs stay unused.
    """
    live = [(k, *s[3:]) for k, s in enumerate(sources) if s[5] > s[4]]
    shape = "_source int, n_blocks long, low double, high double"
    bounds = spark.createDataFrame(live, shape).select(
        "*",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS))
            )
        ).alias("_cell"),
    )
    at = (F.col("id").cast("decimal(18,0)") * F.lit(GOLDEN)) % F.lit(1)
    points = spark.range(1, total + 1).select(F.col("id").alias("slot"), at.cast("double").alias("x"))
    points = points.withColumn("_cell", F.floor(F.col("x") * CELLS))
    placed = (
        points.join(bounds, "_cell")
        .where((F.col("x") >= F.col("low")) & (F.col("x") < F.col("high")))
        .select("slot", "_source", "n_blocks", F.floor(F.col("slot") / 65536).alias("_range"))
    )
    inside = W.partitionBy("_source", "_range").orderBy("slot")
    before = W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_source", "_range")
        .count()
        .select(
            "_source", "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
        )
    )
    rank = F.col("_start") + F.row_number().over(inside) - 1
    ranked = placed.join(starts, ["_source", "_range"]).select(
        "slot", "_source", "n_blocks", rank.alias("rank")
    )
    return ranked.where(F.col("rank") < F.floor(F.col("n_blocks") * most)).select(
        "slot",
        "_source",
        (F.col("rank") % F.col("n_blocks")).alias("block"),
        F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch"),
    )


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights=WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    min_slots: int = 1 << 18,
    max_block: int = 1 << 16,
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    Returns ``doc_id, key, occ, size, source_size, target, taken``; ``key`` and ``occ`` tell rows
    apart (hash of source and text, number among rows equal in id and hash).

    Sources weigh ``weights``, repeating, in code-point order with null last. Every source's
    documents are shuffled by a hash and cut into blocks of equally many words (at most
    ``max_block``, fewer while that leaves less than ``min_slots`` slots). The schedule says how
    often each block is used; documents meet blocks by source and block number, and a
    document takes the words that it has in used blocks. Since a block is used at most
    ``most`` times, so is a document.

    Word offsets within a source come from sums per hash bucket, so a source may hold any share
    of the rows. A document without words takes none. No rows give no rows.
    """
    spark = docs.sparkSession
    sized = saved(
        packed(docs).select(
            F.col(f"doc.{doc_id}").alias("doc_id"),
            F.col(f"doc.{source}").alias("source"),
            F.xxhash64(f"doc.{source}", f"doc.{text}").alias("key"),
            word_count(F.col(f"doc.{text}")).alias("size"),
        ),
        "mix-sizes",
    )
    plan, total, n_buckets = plan_sources(sized, weights, share, most, min_slots, max_block)
    shape = "source string, size long, target double, n_blocks long, low double, high double"
    table = spark.createDataFrame(
        [(k, *row) for k, row in enumerate(plan)], "_source int, " + shape
    ).select(
        "_source",
        F.col("source").alias("_name"),
        F.col("size").alias("source_size"),
        "target",
        "n_blocks",
    )
    # At most MAX_SOURCES rows of a name and a few numbers.
    numbered = sized.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_name"))).select(
        "doc_id",
        "key",
        "size",
        "_source",
        "source_size",
        "target",
        "n_blocks",
        F.xxhash64(F.lit(17), "key", "doc_id").alias("_order"),
    )
    bucket = F.pmod(F.col("_order"), F.lit(n_buckets))
    numbered = numbered.withColumn("_bucket", bucket)
    before = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_source", "_bucket")
        .agg(F.sum("size").alias("_sum"))
        .select(
            "_source", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
        )
    )
    inside = W.partitionBy("_source", "_bucket").orderBy("_order", "key", "doc_id", "size")
    upto = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))
    same = W.partitionBy("_source", "_bucket", "_order", "key", "doc_id").orderBy("size")
    laid = saved(
        numbered.withColumn("occ", F.row_number().over(same))
        .withColumn("_upto", upto)
        .join(offsets, ["_source", "_bucket"])
        .select(
            "doc_id",
            "key",
            "occ",
            "size",
            "_source",
            "source_size",
            "target",
            "n_blocks",
            (F.col("_offset") + F.col("_upto") - F.col("size")).alias("_from"),
        ),
        "mix-laid",
    )
    uses = schedule(spark, plan, total, most).groupBy("_source", "block").agg(
        F.count("*").alias("_uses")
    )

    # Whole-number division: a source of S words in n blocks, block b starting at word b * S div n.
    def edge(block: str) -> Column:
        return F.expr(f"(cast({block} as decimal(19,0)) * source_size) div n_blocks")

    def block_of(word: str) -> Column:
        return F.expr(f"(cast({word} + 1 as decimal(19,0)) * n_blocks - 1) div source_size")

    pieces = laid.where("size > 0").select(
        "*", F.explode(F.sequence(block_of("_from"), block_of("_from + size - 1"))).alias("block")
    )
    overlap = F.least(F.expr("_from + size"), edge("block + 1")) - F.greatest(
        F.col("_from"), edge("block")
    )
    taken = (
        pieces.withColumn("_overlap", overlap)
        .join(uses, ["_source", "block"])
        .groupBy("_source", "_from")
        .agg(F.sum(F.col("_overlap") * F.col("_uses")).alias("taken"))
    )
    # Only documents with words have a place of their own in the source.
    has = F.when(F.col("size") > 0, F.col("_from"))
    return (
        laid.withColumn("_at", F.coalesce(has, -F.col("_from") - 1))
        .join(taken.withColumnRenamed("_from", "_at"), ["_source", "_at"], "left")
        .select(
            "doc_id",
            "key",
            "occ",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mixed_rows(docs: DataFrame, doc_id="doc_id", text="text", source="source", **options):
    """The documents of the mix, each as often as the mix takes it (to the nearest whole number,
    halves upwards), with the columns of ``docs``."""
    taken = (
        mix_sources(docs, doc_id, text, source, **options)
        .where(F.col("taken") * 2 >= F.col("size"))
        .where("size > 0")
        .select(
            F.col("doc_id").alias("_id"),
            F.col("key").alias("_k"),
            F.col("occ").alias("_o"),
            F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("_times"),
        )
    )
    names = docs.columns
    keyed = packed(docs).select(
        "doc",
        F.col(f"doc.{doc_id}").alias("_doc_id"),
        F.xxhash64(f"doc.{source}", f"doc.{text}").alias("_key"),
    )
    rest = F.xxhash64("doc")
    keyed = keyed.withColumn(
        "_occ", F.row_number().over(W.partitionBy("_doc_id", "_key").orderBy(rest))
    )
    match = (
        F.col("_doc_id").eqNullSafe(F.col("_id"))
        & (F.col("_key") == F.col("_k"))
        & (F.col("_occ") == F.col("_o"))
    )
    repeated = keyed.join(taken, match).select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_n")
    )
    return repeated.select(*[F.col("doc")[n].alias(n) for n in names])
