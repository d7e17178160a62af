"""Collocations: frequent phrases by sampling with a negative border, scored by their cuts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import lookup_join
from .common import begin, saved, text_or_empty
from .near import scrambled

LONGEST, LEAST, INSIDE = 3, 10, 50
SHARE = 8  # one text in so many is sampled
SAMPLED = 2  # occurrences in the sample that make a proposal
BITS = 26  # the filter of proposed phrases has 2**BITS bits, 8 MB, at any size of the corpus
TOGETHER = 1 << 18  # words that are counted at once

# Characters that end a piece; blank and tab part words.
STOPS = b".,;:!?\n\x0b\x0c\r"
_MARK = bytes.maketrans(STOPS, b"." * len(STOPS))
# A counted phrase has a name, "words<tab>language". Its key is 0 where the filters hold it. A phrase
# of the border has its key alone. The name "<tab>language" counts all words.
COUNTS = "key long, name string, c long"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def _word_keys(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False)


class _Words:
    """Words of several texts in one row, with a mark after each piece, as numbers."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        flat = split.flatten().dictionary_encode()
        self.code = flat.indices.to_numpy().astype(np.int64)
        self.words = flat.dictionary
        named = pa.array(langs, pa.large_string()).dictionary_encode()
        self.langs = named.dictionary
        self.lang = np.repeat(named.indices.to_numpy().astype(np.int64), pc.list_value_length(split).to_numpy())
        self.is_word = self.code != self.words.index(pa.scalar(".", pa.large_string())).as_py()
        self.own = _word_keys(self.words.view(pa.large_binary()))[self.code]
        self.start = _word_keys(self.langs.view(pa.large_binary()))[self.lang]

    def keys(self, shorter: np.ndarray, size: int) -> np.ndarray:
        """Keys of the phrases of ``size`` words that begin at each place, from those one word shorter."""
        n = len(self.code) - size + 1
        longer = scrambled(shorter[:n] * _MIX + self.own[size - 1 :])
        return np.concatenate([longer, np.zeros(size - 1, np.uint64)])

    def distinct(self, at: np.ndarray, size: int):
        """One place of each different phrase among those at ``at``, and how often it is there."""
        v, ids, top = len(self.words), self.lang[at], len(self.langs)
        for k in range(size):
            if top > (1 << 62) // v:
                ids = np.unique(ids, return_inverse=True)[1]
                top = len(at)
            ids, top = ids * v + self.code[at + k], top * v
        _, where, c = np.unique(ids, return_index=True, return_counts=True)
        return at[where], c

    def names(self, at: np.ndarray, size: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.code[at + k])) for k in range(size)]
        blank, tab = (pa.scalar(x, pa.large_string()) for x in (" ", "\t"))
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, blank)
        return pc.binary_join_element_wise(phrase, self.langs.take(pa.array(self.lang[at])), tab)


def _rows(key: np.ndarray | None, names: pa.Array | None, c: np.ndarray) -> pa.RecordBatch:
    key = pa.array(np.zeros(len(c), np.int64) if key is None else key.view(np.int64))
    names = pa.nulls(len(c), pa.string()) if names is None else names.cast(pa.string())
    return pa.RecordBatch.from_arrays([key, names, pa.array(c, pa.int64())], ["key", "name", "c"])


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter holds the keys; a phrase not proposed may pass, a proposed one always does."""
    at = (keys >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _summed(keys: np.ndarray):
    """Distinct keys and their numbers."""
    return np.unique(keys | _ONE, return_counts=True)


def _sampled(w: _Words, longest: int):
    """All phrases by key."""
    keys, at = w.start, np.flatnonzero(w.is_word)
    for size in range(1, longest + 1):
        keys = w.keys(keys, size)
        found, c = _summed(keys[at])
        yield _rows(found, None, c)
        at = at[w.is_word[at + size]]


def _first_pass(w: _Words, longest: int, bits: np.ndarray):
    """Proposed phrases by name; by key those not proposed whose parts are, the negative border."""
    keys, at = w.start, np.flatnonzero(w.is_word)
    n = np.bincount(w.lang[at], minlength=len(w.langs))
    yield _rows(None, pa.array(["\t" + x for x in w.langs.to_pylist()], pa.string()), n)
    for size in range(1, longest + 1):
        keys = w.keys(keys, size)
        held = _held(bits, keys[at])
        border, c = _summed(keys[at[~held]])
        yield _rows(border, None, c)
        at = at[held]
        some, c = w.distinct(at, size)
        yield _rows(None, w.names(some, size), c)
        chain = np.zeros(len(w.code) + 1, bool)
        chain[at] = True
        at = at[chain[at + 1] & w.is_word[at + size]] if size < longest else at


def _next_pass(w: _Words, longest: int, old: np.ndarray, new: np.ndarray, keyed: bool):
    """Phrases that join the proposals or their border as the filter ``new`` comes to ``old``, by name.

    Phrases that the old filter brought up were counted, by name or (``keyed``) by key. The latter
    are counted by name now if the new filter holds them, for it was made of such that are frequent.
    """
    keys, at = w.start, np.flatnonzero(w.is_word)
    known = np.ones(len(at), bool)  # whether the old filter brought it up
    for size in range(1, longest + 1):
        keys = w.keys(keys, size)
        was = _held(old, keys[at])
        held = was | _held(new, keys[at])
        count = ~known
        if keyed:
            count |= held & ~was
        some, c = w.distinct(at[count], size)
        outside = ~(_held(old, keys[some]) | _held(new, keys[some]))
        yield _rows(np.where(outside, keys[some] | _ONE, np.uint64(0)), w.names(some, size), c)
        if size < longest:
            chain, before = (np.zeros(len(w.code) + 1, bool) for _ in range(2))
            chain[at], before[at] = held, held & was & known
            at = at[held]
            at = at[chain[at + 1] & w.is_word[at + size]]
            known = before[at] & before[at + 1]


def _count(step, longest: int, *filters, **options):
    """Arrow function that hands the texts to ``step``, some 2**18 words at a time."""

    def count(batches):
        bits = [np.frombuffer(f.value, np.uint8) for f in filters]
        texts, langs, held = [], [], 0
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"].to_pylist()):
                # Only blanks and tabs are left of the white space of ASCII.
                marked = text.as_py().lower().translate(_MARK) + b"."
                texts.append(marked.replace(b".", b" . ").strip())
                langs.append(lang)
                held += len(texts[-1])
                if held >= 6 * TOGETHER:
                    yield from step(_Words(texts, langs), longest, *bits, **options)
                    texts, langs, held = [], [], 0
        if texts:
            yield from step(_Words(texts, langs), longest, *bits, **options)

    return count


def _filter(keys: DataFrame) -> bytes:
    """The keys as one bit array of fixed size."""
    place = F.shiftrightunsigned("key", 64 - BITS)
    rows = (
        keys.groupBy(F.shiftright(place, 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        .collect()  # at most 2**(BITS - 15) rows of 4 KB
    )
    bits = bytearray(1 << BITS - 3)
    for row in rows:
        bits[row["bucket"] << 12 : (row["bucket"] + 1) << 12] = row["bits"]
    return bytes(bits)


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    sampled: int = SAMPLED,
) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all phrases of up to ``longest`` words that occur ``least`` times in a language.

    Returns ``lang, size, phrase, c`` (words joined by a blank), and ``lang, n`` with the number
    of all words. Toivonen's method: one row in ``share`` is searched for phrases, and those
    found ``sampled`` times are proposed. One pass over all texts counts the proposed phrases and
    their negative border: words that aren't proposed, and longer phrases that aren't but whose
    parts are. Border phrases are many and mostly rare; they are counted by 64-bit key, which can only
    overstate. Those that reach ``least`` join the proposals; another pass counts them by name, and what
    they add to the border, until that brings up no frequent phrase. What the sample holds decides
    about work, never about results. The proposals lie in a bit array of fixed size; phrases that pass
    it by chance are counted too.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and those at blanks
    and tabs into words. Phrases don't cross pieces. Null texts are empty, null languages ``und``;
    repeated rows count each time; an empty table gives no rows.
    """
    spark = begin(docs.sparkSession)
    texts = docs.select(
        text_or_empty(F.col(text)).cast("binary").alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang")
    )

    def counts(step, *filters, **options) -> DataFrame:
        """Phrases, and keys of the border, that reach ``least``, and the numbers of words."""
        found = texts.mapInArrow(_count(step, longest, *filters, **options), COUNTS)
        totals = found.groupBy("key", "name").agg(F.sum("c").alias("c"))
        often = totals.where((F.col("c") >= least) | F.col("name").startswith("\t"))
        phrase = F.substring_index("name", "\t", 1)
        size = F.when(phrase == "", 0).otherwise(F.regexp_count(phrase, F.lit(" ")) + 1)
        named = F.substring("name", F.char_length(phrase) + 2, F.char_length("name"))
        return saved(
            often.select("key", named.alias("lang"), size.alias("size"), phrase.alias("phrase"), "c"), "phrases-counted"
        )

    sample = texts.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(share)) == 0)
    proposed = (
        sample.mapInArrow(_count(_sampled, longest), COUNTS)
        .groupBy("key")
        .agg(F.sum("c").alias("c"))
        .where(F.col("c") >= sampled)
    )
    old = spark.sparkContext.broadcast(_filter(proposed))
    first = counts(_first_pass, old)
    numbers = first.where("size = 0").select("lang", F.col("c").alias("n"))
    counted = first.where("size > 0")
    failed, keyed = first.where("phrase IS NULL"), True
    while not failed.isEmpty():
        new = spark.sparkContext.broadcast(_filter(failed))
        fresh = counts(_next_pass, old, new, keyed=keyed)
        counted = counted.union(fresh)
        failed, keyed = fresh.where((F.col("key") != 0) & (F.col("size") < longest)), False
        both = np.frombuffer(old.value, np.uint8) | np.frombuffer(new.value, np.uint8)
        old = spark.sparkContext.broadcast(both.tobytes())
    return counted.select("lang", "size", "phrase", "c"), numbers


def _part(words: Column, low, n) -> Column:
    return F.array_join(F.slice(words, low, n), " ")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    longest: int = LONGEST,
    least: int = LEAST,
    inside: int = INSIDE,
    **sampling,
) -> DataFrame:
    """Frequent phrases of 2 to ``longest`` words with the score of their weakest cut.

    Returns ``lang, phrase, a, l, r, n, score``: occurrences ``a`` of the phrase, ``l`` and ``r`` of the two
    parts at the cut, ``n`` of all words, and ``floor(1000000 * a * a / (l * r))`` in decimal numbers of 38
    digits, exact for counts below 10**14. The lowest score counts, ties go to the shorter first part.
    A phrase inside a longer one that has at least ``inside`` percent of its occurrences is dropped.

    The rest is as in ``frequent_phrases``.
    """
    counted, numbers = frequent_phrases(docs, text, lang, longest=longest, least=least, **sampling)
    words = F.split("phrase", " ")
    size = F.col("size")
    longer = counted.where(size > 1)
    # Every shorter phrase inside a longer one, with the most occurrences of such.
    inner = longer.where(size > 2).select(
        "lang",
        F.col("c").alias("outer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), size - 1),
                    lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: _part(words, i, k)),
                )
            )
        ).alias("phrase"),
    )
    most = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    own = longer.join(most, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (F.col("outer") * 100 < F.col("c") * inside)
    )
    cuts = own.select(
        "lang",
        "phrase",
        F.col("c").alias("a"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), size - 1),
                lambda k: F.struct(
                    k.alias("k"), _part(words, F.lit(1), k).alias("left"), _part(words, k + 1, size - k).alias("right")
                ),
            )
        ).alias("cut"),
    )
    left = counted.select("lang", F.col("phrase").alias("_left"), F.col("c").alias("l"))
    right = counted.select("lang", F.col("phrase").alias("_right"), F.col("c").alias("r"))
    a, l, r = (F.col(c).cast("decimal(14,0)") for c in "alr")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    scored = (
        cuts.select("lang", "phrase", "a", "cut.k", F.col("cut.left").alias("_left"), F.col("cut.right").alias("_right"))
        .join(left, ["lang", "_left"])
        .join(right, ["lang", "_right"])
        .withColumns({"_up": million * a * a, "_down": l * r})
        .withColumn("score", F.expr("_up div _down"))
    )
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lookup_join(weakest, numbers, ["lang"], "inner").select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
