"""MinHash near-dedup: banding, verification, connected components."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.joins import fits_broadcast, lookup_join
from .common import begin, packed, saved

WORDS = 5
BANDS, BAND_ROWS = 32, 4  # a pair at 0.75 shares no band with probability 5e-6
FUNCTIONS = BANDS * BAND_ROWS
STEP = 2048
# Pairs at 0.75 lie below this share of equal minima with probability 1e-7.
LEAST_EQUAL = 0.53
BLOCK, COLUMNS = 64, 16384

_draw = np.random.default_rng(20240607)
_BYTE = _draw.integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _draw.integers(0, 1 << 63, WORDS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_A = _draw.integers(0, 1 << 63, FUNCTIONS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, FUNCTIONS, np.int64).astype(np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over the whole."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word of the text, A-Z and a-z alike."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    data, first = data[inside], np.flatnonzero(first[inside])
    if not len(data):
        return np.empty(0, np.uint64)
    sizes = np.diff(first, append=len(data))
    power = np.full(int(sizes.max()), _BASE)
    power[0] = 1
    power = np.cumprod(power)
    place = np.arange(len(data)) - np.repeat(first, sizes)
    return scrambled(np.add.reduceat(_BYTE[data] * power[place], first) + sizes.astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the word 5-grams; of the whole sequence if it is shorter."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = min(WORDS, len(words))
    width = len(words) - n + 1
    sums = sum(words[i : i + width] * _PLACE[i] for i in range(n))
    return np.unique(scrambled(sums + np.uint64(n)))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set, upper 32 bits."""
    least = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), STEP):
        values = _A[:, None] * shingles[None, i : i + STEP] + _B[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


SKETCH = "n_shingles long, cls long, sig array<int>"


def _sketch(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        s = shingle_set(text)
        if len(s):
            digest = blake2b(s.tobytes(), digest_size=8).digest()
            rows.append((len(s), int.from_bytes(digest, "little", signed=True), minima(s)))
        else:
            rows.append((0, None, None))
    out = pd.DataFrame(rows, columns=["n_shingles", "cls", "sig"])
    return out.astype({"cls": "Int64"})


def _set(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).view(np.int64) for t in texts])


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` with the least node of each component, for all nodes with an edge.

    Alternating large-star and small-star steps over a table of edges until it stays the same,
    which takes about log(n) rounds. Every step is a minimum per node, summed per task before the
    shuffle, and a join with it; both sides are stored tables, so the partition of a node with
    very many edges is split. Equal ends are allowed; no edges give no rows.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return saved(
            pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc-least"
        )

    def mark(table: DataFrame):
        return table.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    stars = saved(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u <> v").select(high, low).distinct(),
        "cc-edges",
    )
    last = mark(stars)
    while last[0]:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: the larger neighbours of a node move to its least neighbour.
        large = saved(
            both.where("v > u").join(least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "cc-large",
        )
        # Small star: a node and its smaller neighbours move to the least of them.
        mins = least(large)
        small = saved(
            large.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(mins.select("u", F.col("m").alias("v")))
            .distinct(),
            "cc-small",
        )
        now, stars = mark(small), small
        if now == last:
            break
        last = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)


def near_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, percent: int = 75
) -> DataFrame:
    """The near-duplicate component of every row.

    Returns ``doc_id, key, n_shingles, label, component_id``: ``key`` is a hash of the text,
    ``label`` the same for all rows of a component (null for rows without words) and
    ``component_id`` the least id in it.

    Rows with equal shingle sets form one class, known by a 64-bit digest of the set; everything
    below is about classes, so copies cost nothing. The centre of a band bucket is the member
    that meets most others in all its buckets, so usually the text that the others were made
    from. Every member is compared with the centre: a bucket gives as many pairs as it has
    members. Pairs that pass the signature test are confirmed on full sets
    (``100 * both >= percent * either``). Then, in buckets of three or more, members outside the
    centre's component are compared with all members of other components, block against
    block on full sets. So every pair that shares a bucket is confirmed, or lies in one component
    already. A pair at 0.75 is lost if it shares no bucket or fails the signature test (5e-6).
    The last step is quadratic only in members that resemble their bucket without being linked.

    Null, empty and blank texts are linked with nothing. Rows may repeat ids: each row is a
    document of its own, and null ids count only where a component has no other.
    """
    begin(docs.sparkSession)
    source = packed(docs).select(
        F.col(f"doc.{doc_id}").alias("doc_id"),
        F.xxhash64(f"doc.{text}").alias("key"),
        F.col(f"doc.{text}").alias("text"),
    )
    sketches = saved(
        source.withColumn("_s", F.pandas_udf(_sketch, SKETCH)("text")).select("doc_id", "key", "_s.*"), "near-sketches"
    )
    classes = saved(
        sketches.where("cls IS NOT NULL").dropDuplicates(["cls"]), "near-classes"
    )
    bands = classes.select(
        "cls",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(BANDS - 1)),
                lambda i: F.xxhash64(i, F.slice("sig", i * BAND_ROWS + 1, BAND_ROWS)),
            )
        ).alias("band"),
    )
    buckets = saved(
        bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"),
        "near-buckets",
    )
    # Joined alike at every size, so the work grows in proportion.
    members = saved(bands.join(buckets.hint("merge"), "band"), "near-members")
    # The class that meets most others is the likeliest to be what they were copied from.
    degree = saved(members.groupBy("cls").agg(F.sum("members").alias("degree")), "near-degree")
    centre = F.max_by("cls", F.col("degree")).alias("centre")
    centres = saved(members.join(degree, "cls").groupBy("band").agg(centre), "near-centres")
    pairs = star_pairs(members, centres)
    edges = confirmed(pairs, classes, source, percent)
    labels = saved(connected_components(edges, "cls", "other"), "near-labels")
    placed, apart = apart_members(members, centres, labels)
    if not apart.isEmpty():
        found = saved(linked_in_blocks(placed, apart, classes, source, percent), "near-found")
        edges = edges.union(found)
        labels = saved(connected_components(edges, "cls", "other"), "near-labels")
    rows = (
        sketches.select("doc_id", "key", "n_shingles", "cls")
        .join(labels, F.col("cls") == F.col("node"), "left")
        .select(
            "doc_id", "key", "n_shingles", F.coalesce("label", "cls").alias("label")
        )
    )
    rows = saved(rows, "near-rows")
    least = saved(
        rows.where("label IS NOT NULL")
        .groupBy("label")
        .agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n"),
        "near-least",
    )
    return rows.join(least, "label", "left").select(
        "doc_id", "key", "n_shingles", "label", F.coalesce("_least", "doc_id").alias("component_id")
    )


def star_pairs(members: DataFrame, centres: DataFrame) -> DataFrame:
    met = lookup_join(members, centres, ["band"], "inner")
    return met.where("cls <> centre").select("cls", F.col("centre").alias("other"))


def apart_members(members: DataFrame, centres: DataFrame, labels: DataFrame):
    """Members of buckets of three or more that aren't the centre, in buckets that hold several
    components; and those of them outside the component of the centre."""
    label = F.coalesce("label", "cls").alias("label")
    placed = saved(
        lookup_join(members.where("members > 2"), centres, ["band"], "inner")
        .join(labels, F.col("cls") == F.col("node"), "left")
        .select("band", "cls", "centre", "members", label),
        "near-placed",
    )
    mains = saved(
        placed.where("cls = centre").select("band", F.col("label").alias("main")), "near-mains"
    )
    others = lookup_join(placed.where("cls <> centre"), mains, ["band"], "inner")
    apart = saved(
        others.where("label <> main").select("band", "cls", "label", "members"), "near-apart"
    )
    mixed = saved(apart.select("band").distinct(), "near-mixed")
    return lookup_join(others.drop("main", "centre"), mixed, ["band"], "left_semi"), apart


def linked_in_blocks(
    placed: DataFrame, apart: DataFrame, classes: DataFrame, source: DataFrame, percent: int
) -> DataFrame:
    """Links of the classes apart from their bucket's main component to all its other members.

    Both sides are dealt into blocks of about ``BLOCK`` members by a hash, and a task counts the
    common shingles of two blocks on full sets by one matrix product. Only links leave the task.
    """
    sets = full_sets(placed.select("cls").distinct(), classes, source)

    def blocks(side: DataFrame, prefix: str) -> DataFrame:
        n_blocks = F.ceil(F.col("members") / BLOCK)
        dealt = side.withColumn("_blk", F.pmod(F.xxhash64(F.lit(5), "cls"), n_blocks))
        grouped = dealt.join(sets, "cls").groupBy("band", "_blk").agg(
            F.collect_list(F.struct("cls", "label", "set")).alias("m")
        )
        return grouped.select(
            "band", *[F.col(f"m.{c}").alias(f"{prefix}_{c}") for c in ("cls", "label", "set")]
        )

    met = saved(blocks(apart, "a"), "near-blocks-a").join(
        saved(blocks(placed, "b"), "near-blocks-b"), "band"
    )

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            cls, other = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            side = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                a, b = (
                    [side[f"{p}_{c}"][i].values for c in ("cls", "label", "set")] for p in "ab"
                )
                x, y = linked_pairs(*map(_sets_of, (a[2], b[2])), percent)
                differ = a[1].to_numpy()[x] != b[1].to_numpy()[y]
                cls.append(a[0].to_numpy()[x[differ]])
                other.append(b[0].to_numpy()[y[differ]])
            out = [np.concatenate(cls), np.concatenate(other)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["cls", "other"])

    rows = met.drop("band").mapInArrow(compare, "cls long, other long")
    return rows.select(F.least("cls", "other"), F.greatest("cls", "other")).toDF("cls", "other").distinct()


def _sets_of(lists):
    """Values and set number of each value of an Arrow list array of sets."""
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes), sizes


def linked_pairs(a, b, percent: int):
    """Index pairs of two blocks of sets with ``100 * both >= percent * either``."""
    (a_values, a_of, a_sizes), (b_values, b_of, b_sizes) = a, b
    shared = np.intersect1d(a_values, b_values)
    both = np.zeros((len(a_sizes), len(b_sizes)))
    at_a, at_b = np.searchsorted(shared, a_values), np.searchsorted(shared, b_values)
    hit_a = np.flatnonzero(np.append(shared, 0)[at_a] == a_values) if len(shared) else []
    hit_b = np.flatnonzero(np.append(shared, 0)[at_b] == b_values) if len(shared) else []
    for low in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - low)
        left = np.zeros((len(a_sizes), width), np.float32)
        right = np.zeros((len(b_sizes), width), np.float32)
        for table, hit, at, of in ((left, hit_a, at_a, a_of), (right, hit_b, at_b, b_of)):
            inside = hit[(at[hit] >= low) & (at[hit] < low + width)]
            inside = inside[at[inside] < len(shared)]
            table[of[inside], at[inside] - low] = 1
        both += left @ right.T
    either = a_sizes[:, None] + b_sizes[None, :] - both
    return np.nonzero(both * 100 >= either * percent)


def full_sets(needed: DataFrame, classes: DataFrame, source: DataFrame) -> DataFrame:
    """``cls, set``: the shingles of the asked classes, again from a whole text of each."""
    rows = classes.join(needed, "cls", "left_semi").select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_k"), "cls"
    )
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_k"))
    rows = saved(rows, "near-needed")
    # Texts stay where they are while the asked classes are measured to be few.
    texts = source.join(F.broadcast(rows) if fits_broadcast(rows) else rows, match)
    return saved(
        texts.select("cls", F.pandas_udf(_set, "array<long>")("text").alias("set")), "near-sets"
    )


def confirmed(pairs: DataFrame, classes: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    own = classes.select("cls", F.col("n_shingles").alias("n"), "sig")
    their = own.select(*[F.col(c).alias(f"other_{c}") for c in own.columns])
    low, high = F.least("n", "other_n"), F.greatest("n", "other_n")
    same = F.size(F.filter(F.zip_with("sig", "other_sig", lambda a, b: a == b), lambda x: x))
    likely = saved(
        pairs.distinct()
        .join(own, "cls")
        .join(their, F.col("other") == F.col("other_cls"))
        .where((low * 100 >= high * percent) & (same >= int(LEAST_EQUAL * FUNCTIONS)))
        .select("cls", "other", "n", "other_n"),
        "near-likely",
    )
    needed = likely.select("cls").union(likely.select("other")).distinct()
    sets = full_sets(needed, classes, source)
    theirs = sets.select(F.col("cls").alias("other"), F.col("set").alias("other_set"))
    both = F.size(F.array_intersect("set", "other_set"))
    return saved(
        likely.join(sets, "cls")
        .join(theirs, "other")
        .select("cls", "other", "n", "other_n", both.alias("both"))
        .where(F.col("both") * 100 >= (F.col("n") + F.col("other_n") - F.col("both")) * percent)
        .select("cls", "other")
        .distinct(),
        "near-confirmed",
    )


def near_unique(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component, that with the least id (then text hash); rows without words
    all stay. Returns the columns of ``docs``."""
    found = near_components(docs, doc_id, text, **options)
    linked = found.where("label IS NOT NULL")
    best = linked.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("_b")
    )
    rows = found.where("label IS NULL").select("doc_id", "key", F.lit(False).alias("_one")).union(
        best.select("_b.doc_id", "_b.key", F.lit(True))
    )
    rows = rows.distinct().select(F.col("doc_id").alias("_id"), F.col("key").alias("_k"), "_one")
    names = docs.columns
    keyed = packed(docs).select(
        "doc", F.col(f"doc.{doc_id}").alias("_doc_id"), F.xxhash64(f"doc.{text}").alias("_key")
    )
    again = F.row_number().over(W.partitionBy("_doc_id", "_key").orderBy(F.xxhash64("doc")))
    match = F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))
    kept = keyed.withColumn("_again", again).join(rows, match).where("NOT _one OR _again = 1")
    return kept.select(*[F.col("doc")[n].alias(n) for n in names])
