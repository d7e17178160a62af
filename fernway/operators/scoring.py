"""Scorers: columns computed from an example and a model's output.

Rule scorers are rules. They stand where a hosted judge would be asked and do not claim
to agree with one.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.joins import lookup_join
from ..functions.scalars import ns_to_seconds
from ..functions.text import bind, exploded, literal_map, ngrams, terms, word_count

# Labels, ratings, weights and limits the results must agree on.
PRODUCT_LABELS = [
    "Mortgage Loan",
    "Credit Card",
    "Auto Loan",
    "Checking Account",
    "Wealth Management Product",
    "None",
]
CONFIDENCE = {
    "correct_and_well_reasoned": 1.0,
    "correct_but_poorly_reasoned": 0.6,
    "incorrect": 0.3,
    "unclear": 0.0,
}
GRADES = {"High": 100.0, "Medium": 50.0, "Low": 0.0}
TOOL_WEIGHT, FORMAT_WEIGHT = 0.65, 0.35
MAX_SECONDS = 5.0
ROUTES = ["text_processing_agent", "patient_lookup_agent", "final_agent"]
STOP_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "mit", "von", "den", "ein"],
    "en": ["the", "and", "of", "to", "in", "that", "is", "it", "for", "was"],
    "es": ["el", "los", "las", "y", "que", "en", "por", "con", "una", "no"],
    "fr": ["le", "les", "et", "est", "des", "une", "du", "dans", "pour", "qui"],
}
UNSAFE_TERMS = [
    "idiot",
    "moron",
    "scum",
    "trash",
    "pathetic",
    "worthless",
    "disgusting",
    "loser",
    "clown",
    "stupid",
]

Scorer = Callable[[], Column]
SCORERS: dict[str, Scorer] = {}


def scorer(name: str) -> Callable[[Scorer], Scorer]:
    """Register a function returning a column as a scorer for ``run_scorers``."""

    def register(function: Scorer) -> Scorer:
        SCORERS[name] = function
        return function

    return register


def yes_no(passed: Column) -> Column:
    return F.when(passed, "yes").otherwise("no")


def named_label(response: Column, labels: list[str]) -> Column:
    """The first label of the list that the response names, if any."""
    text = F.lower(response)
    found = F.lit(None).cast("string")
    for label in reversed(labels):
        found = F.when(F.contains(text, F.lit(label.lower())), label).otherwise(found)
    return found


def score_label_guideline(response: Column, labels: list[str] = PRODUCT_LABELS) -> Column:
    """Passes when the response names a permitted label."""
    return yes_no(named_label(response, labels).isNotNull())


def score_rationale(response: Column, max_words: int = 60) -> Column:
    """Passes when exactly one sentence follows the label and it is not too long."""
    parts = F.filter(
        F.transform(F.split(response, r"[.!?]+(\s+|$)"), lambda s: F.trim(s)), lambda s: s != ""
    )
    reason = F.get(parts, F.lit(1))
    return yes_no((F.size(parts) == 2) & (word_count(reason) <= max_words))


def learned_terms(
    train: DataFrame, text: str, flag: str, least: float = 20.0, most: int = 1_000
) -> list[tuple[str, float]]:
    """Terms that flagged texts hold more often than others, with their log-odds, strongest evidence
    first.

    Texts are counted, not uses. The evidence is the log-likelihood ratio of the two by two counts (Dunning:
    Computational Linguistics 19(1), 1993), which stays sound for rare terms; a term counts from
    ``least`` on, and the ``most`` with the greatest evidence reach the driver. Learn on a train split and
    judge on other rows: a low bound finds many terms by chance. ``flag`` is 0 or 1; rows without it
    are left out.
    """
    rows = train.where(F.col(flag).isNotNull())
    n, flagged = rows.agg(F.count("*"), F.coalesce(F.sum(flag), F.lit(0))).first()
    seen = exploded(rows, [F.col(flag).alias("f")], F.array_distinct(terms(F.col(text))), "term")
    counts = seen.groupBy("term").agg(F.sum("f").alias("a"), F.sum(1 - F.col("f")).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    cells = [(a, flagged, a + b), (b, n - flagged, a + b)]
    cells += [(flagged - a, flagged, n - a - b), (n - flagged - b, n - flagged, n - a - b)]
    ratio = sum(
        (F.when(held > 0, held * F.log(held * n / (F.lit(column) * row))).otherwise(0.0) for held, column, row in cells),
        start=F.lit(0.0),
    )
    odds = F.log((a + 0.5) / (flagged - a + 0.5)) - F.log((b + 0.5) / (n - flagged - b + 0.5))
    found = counts.where(a * (n - flagged) > b * flagged).select(
        "term", odds.alias("odds"), F.round(2 * ratio, 6).alias("evidence")
    )
    best = found.where(F.col("evidence") >= least).orderBy(F.desc("evidence"), "term").limit(most)
    return [(r.term, r.odds) for r in best.collect()]


def score_safety(text: Column, unsafe: list[str] = UNSAFE_TERMS) -> Column:
    return yes_no(~F.exists(terms(text), lambda t: t.isin(unsafe)))


def term_coverage(request: Column, context: Column) -> Column:
    """Share of the request's distinct terms that the context holds."""
    wanted = F.array_distinct(terms(request))
    held = F.array_intersect(wanted, terms(context))
    return F.when(F.size(wanted) > 0, F.size(held) / F.size(wanted))


def score_relevance(request: Column, context: Column, threshold: float = 0.2) -> Column:
    return yes_no(term_coverage(request, context) >= threshold)


def score_latency(traces: DataFrame, max_seconds: float = MAX_SECONDS) -> DataFrame:
    """Yes/no and a rationale on the first chat span of each trace; NULL without one."""
    seconds = ns_to_seconds(F.col("chat_start_ns"), F.col("chat_end_ns"))
    passed = seconds <= max_seconds
    text = F.format_string("LLM response time %.2fs ", seconds)
    within = F.concat(text, F.lit(f"is within the {max_seconds}s limit."))
    exceeds = F.concat(text, F.lit(f"exceeds the {max_seconds}s limit."))
    return traces.select(
        "trace_id",
        F.when(seconds.isNotNull(), yes_no(passed)).alias("value"),
        F.when(passed, within).when(~passed, exceeds).alias("rationale"),
    )


def score_length(response: Column) -> Column:
    return word_count(response)


def map_rating_numeric(rating: Column, values: dict[str, float] = CONFIDENCE) -> Column:
    """Number of a rating; NULL for one outside the list."""
    return literal_map(values)[rating]


def composite_score(tool: Column, formatting: Column) -> Column:
    """Weighted grades, 0 to 1; NULL when a grade is none of High, Medium, Low."""
    weighted = (
        map_rating_numeric(tool, GRADES) * TOOL_WEIGHT
        + map_rating_numeric(formatting, GRADES) * FORMAT_WEIGHT
    )
    return weighted / 100


def composite_feedback(tool_reason: Column, format_reason: Column) -> Column:
    return F.concat(
        F.lit("Tool Calling feedback: "), tool_reason,
        F.lit("\nFormatting feedback: "), format_reason,
    )


def score_correctness(verdict: Column, target: Column, prediction: Column) -> Column:
    """1 or 0 by the judge's verdict; by exact match where there is none."""
    judged = F.when(verdict.isNotNull(), verdict == "YES")
    return F.coalesce(judged, target == prediction, F.lit(False)).cast("int")


def learned_stop_words(train: DataFrame, text: str, language: str, most: int = 25) -> dict[str, list[str]]:
    """The ``most`` terms of each language that set it apart, best first, for ``score_language``.

    A term belongs to the language where the greatest share of texts holds it, and is worth its lead over the next
    language, in whole millionths; ties of lead go by term. Texts are counted, not uses, before anything is
    exchanged. Rows without a language are left out; languages must be few, their words reach the driver.
    """
    rows = train.where(F.col(language).isNotNull())
    texts = rows.groupBy(F.col(language).alias("language")).agg(F.count("*").alias("n"))
    held = exploded(rows, [F.col(language).alias("language")], F.array_distinct(terms(F.col(text))), "term")
    counts = held.groupBy("term", "language").agg(F.count("*").alias("c"))
    shares = lookup_join(counts, texts, ["language"], "inner").select(
        "term", F.struct(F.expr("c * 1000000 div n").alias("share"), "language").alias("s")
    )
    # One entry a language in each list.
    ranked = shares.groupBy("term").agg(F.sort_array(F.collect_list("s"), asc=False).alias("s"))
    first, second = F.get("s", F.lit(0)), F.get("s", F.lit(1))
    leads = ranked.select(
        "term", first["language"].alias("language"),
        (first["share"] - F.coalesce(second["share"], F.lit(0))).alias("lead"),
    ).where("lead > 0")
    order = W.partitionBy("language").orderBy(F.desc("lead"), "term")
    best = leads.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    found = {r.language: [] for r in texts.collect()}
    for row in best.orderBy("language", "rank").collect():
        found[row.language].append(row.term)
    return found


def score_language(text: Column, stop_words: dict[str, list[str]] = STOP_WORDS) -> Column:
    """``(language, share)``: most stop words among the tokens; first name on a tie. Without any
    language NULLs."""
    if not stop_words:
        return F.struct(F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("share"))
    known = sorted({w for words in stop_words.values() for w in words})

    def hits(held: Column, words: list[str]) -> Column:
        return F.size(F.filter(held, lambda t: t.isin(words)))

    def best(held: Column) -> Column:
        return F.array_min(
            F.array(
                *[
                    F.struct((-hits(held, stop_words[name])).alias("n"), F.lit(name).alias("name"))
                    for name in sorted(stop_words)
                ]
            )
        )

    def judge(tokens: Column) -> Column:
        stops = F.filter(tokens, lambda t: t.isin(known))
        return bind(
            F.struct(
                bind(stops, lambda held: best(held)).alias("top"), F.size(tokens).alias("total")
            ),
            lambda r: F.struct(
                F.when(r["top"]["n"] < 0, r["top"]["name"]).alias("language"),
                F.when(r["total"] > 0, F.round(-r["top"]["n"] / r["total"], 6)).alias("share"),
            ),
        )

    return bind(terms(text), lambda tokens: judge(tokens))


def score_out_of_scope(expected: Column, response: Column) -> Column:
    """Passes when "None" is answered exactly where it is expected."""
    answered = F.coalesce(named_label(response, PRODUCT_LABELS), F.lit("")) == "None"
    return yes_no(answered == (expected == "None"))


def score_overlap(
    pairs: DataFrame, key: str, candidate: str, reference: str, sizes: tuple[int, ...] = (1, 2)
) -> DataFrame:
    """Clipped n-gram precision (BLEU-n part) and recall (ROUGE-n) per pair and n.

    N-grams of both texts and of all sizes are counted in one aggregate, so nothing is
    joined, and map tasks combine counts before the exchange.
    """

    def grams(column: str, side: int, n: int) -> Column:
        found = F.coalesce(ngrams(terms(F.col(column)), n), F.array().cast("array<string>"))
        return F.transform(
            found, lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram"), F.lit(side).alias("s"))
        )

    # A marker per size keeps pairs without any n-gram in the result.
    marks = F.array(
        *[
            F.struct(F.lit(n).alias("n"), F.lit(None).cast("string").alias("gram"), F.lit(2).alias("s"))
            for n in sizes
        ]
    )
    every = [grams(c, side, n) for n in sizes for side, c in ((0, candidate), (1, reference))]
    rows = pairs.select(key, F.explode(F.concat(marks, *every)).alias("g"))
    counts = rows.groupBy(key, F.col("g.n").alias("n"), F.col("g.gram").alias("gram")).agg(
        F.count_if(F.col("g.s") == 0).alias("c"), F.count_if(F.col("g.s") == 1).alias("r")
    )
    totals = counts.groupBy(key, "n").agg(
        F.sum(F.least("c", "r")).alias("hits"), F.sum("c").alias("c"), F.sum("r").alias("r")
    )
    return totals.select(
        key,
        "n",
        F.round(F.when(F.col("c") > 0, F.col("hits") / F.col("c")), 6).alias("precision"),
        F.round(F.when(F.col("r") > 0, F.col("hits") / F.col("r")), 6).alias("recall"),
    )


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence; a row of the table is the bits of one number
    (Hyyro: AWOCA 2004), so memory is linear in the shorter list."""
    if len(a) > len(b):
        a, b = b, a
    places: dict = {}
    for i, item in enumerate(a):
        places[item] = places.get(item, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for item in b:
        if match := row & places.get(item, 0):
            row = (row + match | row - match) & every
    return len(a) - row.bit_count()


def score_lcs(pairs: DataFrame, key: str, candidate: str, reference: str) -> DataFrame:
    """ROUGE-L: the longest common subsequence of words as share of the candidate (``precision``) and of
    the reference (``recall``), and their harmonic mean ``f1``.

    Words are split by Spark and compared on Arrow batches, row by row without a shuffle. NULL texts have no
    words; a share of no words is NULL.
    """

    def lengths(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist())
        return pa.array([common_subsequence(a, b) for a, b in pairs], pa.int32())

    none = F.array().cast("array<string>")
    words = [F.coalesce(terms(F.col(c)), none) for c in (candidate, reference)]
    rows = pairs.select(key, words[0].alias("_c"), words[1].alias("_r"))
    rows = rows.withColumn("lcs", F.arrow_udf(lengths, "int")("_c", "_r"))
    precision, recall = (F.when(F.size(c) > 0, F.col("lcs") / F.size(c)) for c in ("_c", "_r"))
    both = F.size("_c") + F.size("_r")
    f1 = F.when((F.size("_c") > 0) & (F.size("_r") > 0), 2 * F.col("lcs") / both)
    return rows.select(
        key, "lcs", *[F.round(x, 6).alias(n) for n, x in (("precision", precision), ("recall", recall), ("f1", f1))]
    )


def score_cost(
    request: Column, response: Column, model: Column, prices: dict[str, tuple[float, float]]
) -> Column:
    """Token counts times the model's (input, output) price per 1,000 tokens."""
    paid_in = literal_map({m: p[0] for m, p in prices.items()})[model]
    paid_out = literal_map({m: p[1] for m, p in prices.items()})[model]
    return F.round((word_count(request) * paid_in + word_count(response) * paid_out) / 1000, 9)


def normalize_synonyms(label: Column, aliases: dict[str, str]) -> Column:
    """Canonical name of a label; unknown labels stay."""
    return F.coalesce(literal_map(aliases)[F.lower(F.trim(label))], F.trim(label))


def tool_calls(trajectory: Column) -> Column:
    """Tools of a run in call order, from the ``tool_name_<n>`` entries of its JSON."""
    named = F.map_filter(
        F.from_json(trajectory, "map<string,string>"),
        lambda k, v: k.rlike(r"^tool_name_[0-9]+$"),
    )
    ordered = F.array_sort(
        F.transform(
            F.map_entries(named),
            lambda e: F.struct(
                F.regexp_extract(e["key"], r"([0-9]+)$", 1).try_cast("int").alias("step"),
                e["value"].alias("tool"),
            ),
        )
    )
    return F.transform(ordered, lambda e: e["tool"])


def next_step_route(kind: Column, routes: dict[str, str], default: str) -> Column:
    """Next handler of a row, always one of the permitted ones."""
    unknown = set(routes.values()) | {default}
    if not unknown <= set(ROUTES):
        raise ValueError(f"routes must be among {ROUTES}")
    return F.coalesce(literal_map(routes)[kind], F.lit(default))


def run_scorers(examples: DataFrame, key: str, scorers: dict[str, Scorer]) -> DataFrame:
    """All scorers in one pass over the table, as ``(key, scorer, value_str, value_num)``.

    A numeric score fills ``value_num``; yes/no fills ``value_str``.
    """
    scored = examples.select(key, *[make().alias(name) for name, make in scorers.items()])
    rows = []
    for name in scorers:
        is_text = scored.schema[name].dataType.typeName() == "string"
        value = F.col(f"`{name}`")
        rows.append(
            F.struct(
                F.lit(name).alias("scorer"),
                (value if is_text else F.lit(None).cast("string")).alias("value_str"),
                (F.lit(None) if is_text else value).cast("double").alias("value_num"),
            )
        )
    return scored.select(key, F.explode(F.array(*rows)).alias("s")).select(key, "s.*")


def score_summary(scores: DataFrame) -> DataFrame:
    """Per scorer: rows, mean of numbers, pass rate of yes/no, rows without a score."""
    judged = F.count_if(F.col("value_str").isin("yes", "no"))
    return scores.groupBy("scorer").agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg("value_num"), 6).alias("mean"),
        F.round(
            F.when(judged > 0, F.count_if(F.col("value_str") == "yes") / judged), 6
        ).alias("pass_rate"),
        F.count_if(F.col("value_str").isNull() & F.col("value_num").isNull()).alias("n_unscored"),
    )


def mean_score(scores: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    return scores.groupBy(*by).agg(F.round(F.avg(value), 6).alias("mean_score"))


def variant_grid(examples: DataFrame, variants: list[str], column: str = "variant") -> DataFrame:
    """Every example once per variant. The variants are a constant list, so each row is
    simply repeated where it is."""
    return examples.withColumn(column, F.explode(F.array(*map(F.lit, variants))))


def rank_variants(scores: DataFrame, variant: str, value: str, base: str) -> DataFrame:
    """Variants by mean score, with the gain over ``base`` in points.

    Scores are first reduced to one row per variant, so the rank sees a handful of rows.
    """
    from pyspark.sql import Window as W

    means = scores.groupBy(variant).agg(F.avg(value).alias("_m"))
    everything = W.partitionBy(F.lit(1))
    base_mean = F.max(F.when(F.col(variant) == base, F.col("_m"))).over(everything)
    return means.select(
        variant,
        F.round("_m", 6).alias("mean_score"),
        F.rank().over(W.partitionBy(F.lit(1)).orderBy(F.desc(F.round("_m", 6)))).alias("rank"),
        F.round((F.col("_m") - base_mean) * 100, 6).alias("gain_points"),
    )
