"""Quality rules as weak supervision: rules vote, EM weighs them."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, bind, packed, saved, text_or_empty, words

# Fixed value: the symbols of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
ROUNDS = 25
VOTES = (-1, 0, 1)
# Probabilities of the votes of a rule for good and for bad texts, before anything is learned.
START = ({-1: 0.02, 0: 0.38, 1: 0.6}, {-1: 0.4, 0: 0.3, 1: 0.3})
RULES = ("length", "word_size", "symbols", "dup_lines", "repeats", "capitals", "letters")


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words inside windows that are found twice or more in the text, the first one included.

    Windows are hashed and sorted with their positions, so equal ones are neighbours; nothing
    compares all pairs. A text whose windows all differ, the usual case, isn't sorted.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        twice = bind(
            pairs,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda p, k: F.when(
                        F.coalesce(F.get(s, k - 1)["h"] == p["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == p["h"], F.lit(False)),
                        p["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        return F.aggregate(
            F.array_sort(twice),
            F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i + 1, window)))
        counted = bind(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                covered(h)
            ),
        )
        return F.when(F.size(w) <= window, F.lit(0)).otherwise(counted)

    return bind(tokens, of_words)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc`` (the input row) and the counts that the rules use, all as longs."""
    value = F.col("_text")

    def without(chars: str) -> Column:
        return F.char_length(F.translate(value, chars, ""))

    with_word = F.filter(
        F.split(value, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != ""
    )
    counts = {
        "n_words": F.size("_words"),
        "word_chars": without(SPACE),
        "n_symbols": F.char_length(value) - without(SYMBOLS),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_capitals": F.regexp_count(value, F.lit(r"\p{Lu}")),
        "n_letters": F.regexp_count(value, F.lit(r"\p{L}")),
    }
    return (
        packed(docs)
        .withColumn("_text", text_or_empty(F.col(f"doc.{text}")))
        .select("doc", "_text", words(value).alias("_words"), with_word.alias("_lines"))
        .select("doc", *[c.cast("long").alias(n) for n, c in counts.items()])
    )


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 for a good text, -1 for a bad one, 0 to abstain."""

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    n, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    lines_, letters = F.greatest(F.col("n_lines"), F.lit(1)), F.greatest(F.col("n_letters"), F.lit(1))
    size = F.col("word_chars") / F.greatest(n, F.lit(1))
    return {
        "length": rule(n >= 50, n < 20),
        "word_size": rule(size.between(3.5, 9), ~size.between(3, 10.5)),
        "symbols": rule(F.col("n_symbols") * 100 <= n, F.col("n_symbols") * 10 >= n),
        "dup_lines": rule(F.col("n_dup_lines") == 0, F.col("n_dup_lines") * 2 >= lines_),
        "repeats": rule(F.col("n_repeat_words") * 20 <= n, F.col("n_repeat_words") * 5 >= n),
        "capitals": rule(F.col("n_capitals") * 8 <= letters, F.col("n_capitals") * 3 >= letters),
        "letters": rule(F.col("n_letters") * 100 >= chars * 92, F.col("n_letters") * 100 < chars * 75),
    }


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 20) | (F.col("n_repeat_words") * 100 > n * 30)


def posterior(model: dict) -> Column:
    """Probability that a text is good, given its votes; abstentions say nothing.

    A bad vote never counts for a text, nor a good vote against it."""

    def odds(name: str) -> Column:
        good, bad = model[name]
        ratio = {v: math.log(good[v] / bad[v]) for v in VOTES}
        return (
            F.when(F.col(name) == 1, max(0.0, ratio[1]))
            .when(F.col(name) == -1, min(0.0, ratio[-1]))
            .otherwise(0.0)
        )

    prior = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, map(odds, RULES), prior)))


def fit_rules(voted: DataFrame, rounds: int = ROUNDS) -> dict:
    """Share of good texts and, per rule, how good and bad texts make it vote or abstain.

    Expectation-maximisation over the counts of vote patterns, of which there are at most
    3 to the number of rules whatever the corpus; the counts cover all rows. It starts from rules
    that are mostly right (``START``) and ends when nothing moves.
    """
    patterns = saved(voted.groupBy(*RULES).agg(F.count("*").alias("_n")), "vote-patterns")
    model: dict = {"prior": 0.8, **{name: START for name in RULES}}
    for _ in range(rounds):
        good = F.col("_n") * F.col("_p")
        bad = F.col("_n") * (1 - F.col("_p"))
        sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
        for name in RULES:
            for v in VOTES:
                voted_so = F.col(name) == v
                sums.append(F.sum(F.when(voted_so, good).otherwise(0)).alias(f"{name}_good_{v}"))
                sums.append(F.sum(F.when(voted_so, bad).otherwise(0)).alias(f"{name}_bad_{v}"))
        row = patterns.withColumn("_p", posterior(model)).agg(*sums).first()
        if row["good"] is None:  # no rows
            break
        new = {"prior": (row["good"] + 1) / (row["good"] + row["bad"] + 2)}
        for name in RULES:
            new[name] = tuple(
                {v: (row[f"{name}_{c}_{v}"] + 1) / (row[c] + 3) for v in VOTES}
                for c in ("good", "bad")
            )
        still = abs(new["prior"] - model["prior"]) < 1e-5
        model = new
        if still:
            break
    return model


def judge_quality(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Statistics, quality probability and verdict of every document.

    Returns ``doc`` (the input row), the counts of ``statistics``, ``base_failed``, ``quality`` (0
    to 1) and ``kept``: false where the base rule fails, else whether ``quality`` is at least
    ``least``. Null and empty texts have no words and fail. All rows vote, so equal texts
    always get equal results. No rows give no rows. No shuffle but for the pattern counts.
    """
    voted = saved(statistics(docs, text).select("*", *[v.alias(n) for n, v in votes().items()]), "votes")
    model = fit_rules(voted)
    quality = posterior(model)
    return voted.select(
        "doc",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        quality.alias("quality"),
        (~base_failed() & (quality >= least)).alias("kept"),
    )
