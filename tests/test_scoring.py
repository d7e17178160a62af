import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from fernway.functions import text as tx
from fernway.operators import keywords as kw, predict as pr, scoring as sc, tables as tb
from fernway.operators.generators import INSURERS, gen_practices, gen_visits
from fernway.plans.catalog import QUERIES
from fernway.plans.fixtures import Tables


def one(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_words_and_ngrams(spark):
    df = one(spark, "t string", (" a  b\nc ",), ("",), (None,), ("x　y z",))
    assert [r[0] for r in df.select(tx.word_count(df.t)).collect()] == [3, 0, None, 3]
    grams = df.select(tx.ngrams(tx.terms(df.t), 2)).collect()
    assert [r[0] for r in grams] == [["a b", "b c"], [], None, ["x y", "y z"]]


def test_latency_needs_a_chat_span_and_includes_the_limit(spark):
    traces = one(
        spark,
        "trace_id int, chat_start_ns long, chat_end_ns long",
        (1, 0, 5_000_000_000), (2, 0, 5_004_000_000), (3, None, None),
    )
    got = {r.trace_id: (r.value, r.rationale) for r in sc.score_latency(traces).collect()}
    assert got[1] == ("yes", "LLM response time 5.00s is within the 5.0s limit.")
    assert got[2] == ("no", "LLM response time 5.00s exceeds the 5.0s limit.")
    assert got[3] == (None, None)


def test_grades_outside_the_scale_give_no_score(spark):
    df = one(spark, "a string, b string", ("High", "Low"), ("Medium", "High"), ("High", "n/a"))
    got = [r[0] for r in df.select(sc.composite_score(df.a, df.b)).collect()]
    assert got == [pytest.approx(0.65), pytest.approx(0.675), None]


def test_correctness_falls_back_to_exact_match(spark):
    df = one(
        spark, "v string, t string, p string",
        ("YES", "a", "b"), ("NO", "a", "a"), (None, "a", "a"), (None, "a", "b"), (None, "a", None),
    )
    got = [r[0] for r in df.select(sc.score_correctness(df.v, df.t, df.p)).collect()]
    assert got == [1, 0, 1, 0, 0]


def test_rationale_and_label(spark):
    df = one(
        spark, "r string",
        ("Credit Card. It earns miles.",), ("Credit Card.",), ("A. B. C.",),
        ("Auto loan. " + "x " * 80,),
    )
    got = [tuple(r) for r in df.select(sc.score_label_guideline(df.r), sc.score_rationale(df.r)).collect()]
    assert got == [("yes", "yes"), ("yes", "no"), ("no", "no"), ("yes", "no")]


def test_tool_order_is_numeric(spark):
    df = one(
        spark, "t string",
        ('{"tool_name_10":"z","tool_name_2":"b","tool_args_2":"x","tool_name_1":"a"}',), ("bad",),
    )
    assert [r[0] for r in df.select(sc.tool_calls(df.t)).collect()] == [["a", "b", "z"], None]


def test_overlap_is_clipped_and_handles_empty(spark):
    df = one(
        spark, "k int, c string, r string", (1, "the the the cat", "the cat sat"), (2, "", "a"),
        (3, None, None),
    )
    got = {(r.k, r.n): (r.precision, r.recall) for r in sc.score_overlap(df, "k", "c", "r").collect()}
    assert got[(1, 1)] == (0.5, 0.666667)
    assert got[(1, 2)] == (0.333333, 0.5)
    assert got[(2, 1)] == (None, 0.0) and got[(2, 2)] == (None, None)
    assert got[(3, 1)] == (None, None)


def test_own_scorer_runs_with_the_others(spark):
    @sc.scorer("shouts")
    def shouts():
        return sc.yes_no(F.col("r") == F.upper("r"))

    df = one(spark, "k int, r string", (1, "HI"), (2, "hi there"))
    rows = sc.run_scorers(df, "k", {**sc.SCORERS, "length": lambda: sc.score_length(F.col("r"))})
    got = {(r.k, r.scorer): (r.value_str, r.value_num) for r in rows.collect()}
    assert got[(1, "shouts")] == ("yes", None) and got[(2, "length")] == (None, 2.0)
    summary = {r.scorer: r for r in sc.score_summary(rows).collect()}
    assert summary["shouts"].pass_rate == 0.5 and summary["length"].mean == 1.5


def test_routes_must_be_permitted(spark):
    with pytest.raises(ValueError):
        sc.next_step_route(F.lit("x"), {"x": "elsewhere"}, "final_agent")


def test_equal_prompts_are_predicted_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def load():
        def model(texts: pd.Series) -> pd.Series:
            seen.add(len(texts))
            return texts.str.upper()

        return model

    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 > 0, "same").otherwise(F.concat(F.lit("t"), F.col("id") % 9)).alias("t")
    ).unionByName(one(spark, "id long, t string", (999, None)))
    out = pr.batch_predict(df, "t", load).collect()
    assert len(out) == 301
    assert all(r.prediction == (r.t.upper() if r.t else None) for r in out)
    assert seen.value == 4


def test_typed_output_flags_bad_rows(spark):
    schema = T.StructType(
        [
            T.StructField("label", T.StringType(), False),
            T.StructField("score", T.IntegerType(), False),
            T.StructField("note", T.StringType()),
        ]
    )
    df = one(
        spark, "raw string",
        ('{"label":"a","score":1}',), ('{"label":"a","score":"high"}',), ('{"label":"a"}',),
        ("no json",), (None,), ('{"label":"b","score":2,"note":"n"}',),
    )
    rows = pr.parse_typed_output(df, "raw", schema).collect()
    assert [r.valid for r in rows] == [True, False, False, False, False, True]
    assert [r.label for r in rows] == ["a", None, None, None, None, "b"]
    assert rows[5].note == "n"


def test_classifier_learns_separable_classes(spark):
    rows = [(f"{'cat purr' if i % 2 else 'dog bark'} w{i}", "cat" if i % 2 else "dog") for i in range(40)]
    rows = [(i, *r) for i, r in enumerate(rows)] + [(50, None, "cat"), (51, "...", "dog"), (52, "bark", None)]
    df = one(spark, "id int, text string, label string", *rows)
    model = pr.train_classifier(df.where("id % 4 < 2 OR id > 40"), "text", "label")
    got = pr.classify(model, df, "id", "text")
    assert got.where("id < 40 AND label = prediction").count() == 40
    # A tie of the priors goes to the first label; unknown words say nothing.
    assert {r.id: r.prediction for r in got.where("id >= 50").collect()} == {50: "cat", 51: "cat", 52: "dog"}
    assert pr.classify(pr.train_classifier(df.limit(0), "text", "label"), df, "id", "text").count() == 43


def test_language_by_stop_words(spark):
    df = one(spark, "t string", ("The cat and the dog",), ("le chat est dans une boîte",), ("zzz",), ("",))
    got = [r[0] for r in df.select(sc.score_language(df.t)).collect()]
    assert [g.language for g in got] == ["en", "fr", None, None]
    assert got[0].share == 0.6 and got[2].share == 0.0 and got[3].share is None


def test_stop_words_are_what_sets_a_language_apart(spark):
    rows = [("a x both", "en"), ("a a y both", "en"), ("b x both", "fr"), ("b z", "fr"), (None, "fr"), ("a b", None), ("", "de")]
    df = one(spark, "t string, lang string", *rows)
    # a: both texts of en. y: one of two; both: two of two against one of three; x: half against a third.
    got = sc.learned_stop_words(df, "t", "lang", 10)
    assert got == {"en": ["a", "both", "y", "x"], "fr": ["b", "z"], "de": []}
    assert sc.learned_stop_words(df, "t", "lang", 1) == {"en": ["a"], "fr": ["b"], "de": []}
    nothing = sc.learned_stop_words(df.limit(0), "t", "lang")
    assert nothing == {}
    judged = df.select(sc.score_language(F.col("t"), nothing).alias("f")).distinct().collect()
    assert [tuple(r.f) for r in judged] == [(None, None)]


def test_learned_stop_words_name_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("half", F.crc32(F.col("doc_id").cast("string")) % 2)
    learned = sc.learned_stop_words(docs.where("half = 0"), "text", "lang")
    guess = docs.where("half = 1").select("lang", sc.score_language(F.col("text"), learned)["language"].alias("g"))
    assert guess.where("lang = g").count() / guess.count() >= 0.95


def test_generated_visits(spark):
    visits = gen_visits(spark.range(3000), "id")
    again = gen_visits(spark.range(3000).repartition(7), "id")
    assert visits.exceptAll(again).isEmpty()
    people = visits.groupBy("first_name", "last_name").agg(
        F.count_distinct("insurance_provider_name").alias("i"), F.count_distinct("insurance_type").alias("p")
    ).collect()
    assert len(people) == 15 and all(r.i == r.p == 1 for r in people)
    share = visits.where("insurance_policy_number IS NULL").count() / 3000
    assert 0.15 < share < 0.25
    assert {r[0] for r in visits.select("insurance_provider_name").distinct().collect()} <= set(INSURERS)
    practices = gen_practices(spark.range(50), "id").collect()
    assert practices[0].practice_name == "Medical Center 1"
    assert practices[9].contact == "(555) 555-1209"


def test_duplicate_lookup_keys_are_reported(spark):
    features = one(spark, "k int, v string", (1, "a"), (1, "b"), (2, "c"))
    asked = one(spark, "k int", (1,), (2,), (3,))
    assert [r.k for r in tb.duplicate_keys(features, ["k"]).collect()] == [1]
    with pytest.raises(ValueError):
        tb.feature_lookup(asked, features, ["k"], check=True)
    assert tb.feature_lookup(asked, features.where("v <> 'b'"), ["k"], check=True).count() == 3


def test_history_crosses_pages(spark):
    turns = one(spark, "conv_id int, turn long, role string, text string",
                *[(1, i, "user", f"m{i}") for i in (0, 1, 2, 5, 9)])
    history, pages = tb.conversation_history(turns, page_turns=3)
    got = {r.turn: (r.page, [h.text for h in r.page_history], r.last_message) for r in history.collect()}
    assert got == {
        0: (0, [], None), 1: (0, ["m0"], "m0"), 2: (0, ["m0", "m1"], "m1"),
        5: (1, [], "m2"), 9: (3, [], "m5"),
    }
    assert {r.page: [t.text for t in r.turns] for r in pages.collect()} == {
        0: ["m0", "m1", "m2"], 1: ["m5"], 3: ["m9"],
    }
    whole = tb.full_history(turns.where("turn IN (2, 9)"), turns, page_turns=3).collect()
    assert {r.turn: [h.text for h in r.history] for r in whole} == {
        2: ["m0", "m1"], 9: ["m0", "m1", "m2", "m5"],
    }


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_common_subsequence_equals_the_table():
    rnd = random.Random(6)
    for _ in range(300):
        a, b = ([rnd.randrange(rnd.choice([2, 9])) for _ in range(rnd.randint(0, 70))] for _ in range(2))
        assert sc.common_subsequence(a, b) == brute_lcs(a, b)
    a, b = ([rnd.randrange(20) for _ in range(1000)] for _ in range(2))
    assert sc.common_subsequence(a, b) == brute_lcs(a, b)


def test_rouge_l_of_the_request_log(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    tokens = lambda x: [w for w in re.split(r"[\W_]+", (x or "").lower()) if w]
    want = {r.req_no: (tokens(r.response), tokens(r.request)) for r in t.request_log.collect()}
    got = {r.req_no: r for r in QUERIES["score_rouge_l"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == want.keys()
    for k, (c, r) in want.items():
        n = brute_lcs(c, r)
        assert got[k].lcs == n
        assert got[k].precision == (round(n / len(c), 6) if c else None)
        assert got[k].recall == (round(n / len(r), 6) if r else None)
    odd = one(spark, "k int, c string, r string", (1, None, "a b"), (2, "", ""), (3, "b a b", "a b a"))
    assert {r.k: (r.lcs, r.precision, r.f1) for r in sc.score_lcs(odd, "k", "c", "r").collect()} == {
        1: (0, None, None), 2: (0, None, None), 3: (2, 0.666667, 0.666667)}


def test_learned_terms_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    learned = [term for term, _ in sc.learned_terms(rows.where(half == 0), "text", "toxic")]
    found = rows.where(half == 1).select("toxic", sc.score_safety(F.col("text"), learned).alias("s"))
    counts = {(r.toxic, r.s): r["count"] for r in found.groupBy("toxic", "s").count().collect()}
    caught, missed, wrong = (counts.get(x, 0) for x in ((1, "no"), (1, "yes"), (0, "no")))
    assert caught / (caught + wrong) >= 0.8 and caught / (caught + missed) >= 0.5
    assert sc.learned_terms(rows.limit(0), "text", "toxic") == []
    assert sc.learned_terms(rows.where("toxic = 0"), "text", "toxic") == []


def test_rules_beside_the_labels_they_stand_for(spark):
    # A term list misses labelled texts that hold none of its terms: 18 of 51 here. It was
    # chosen by looking at these labels, so this is a regression check and no estimate.
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flagged = docs.join(labels, "doc_id").select("toxic", sc.score_safety(F.col("text")).alias("s"))
    counts = {(r.toxic, r.s): r["count"] for r in flagged.groupBy("toxic", "s").count().collect()}
    assert counts == {(0, "yes"): 348, (1, "no"): 33, (1, "yes"): 18}
    guess = docs.select("lang", sc.score_language(F.col("text"))["language"].alias("g"))
    assert guess.where("lang = g").count() / guess.count() >= 0.9


def test_first_chat_span_needs_no_sort(spark):
    from fernway.sources.tables import trace_source

    rows = [(1, 5, "CHAT_MODEL", 10, 12), (1, 4, "CHAT_MODEL", 10, 11), (1, 9, "TOOL", 3, 40), (1, 1, "CHAT_MODEL", 11, 99),
            (2, -3, "CHAT_MODEL", 7, 8), (2, 3, "CHAT_MODEL", 7, 9), (3, 1, "RETRIEVER", 1, 2), (4, None, "CHAT_MODEL", None, 5)]
    shape = "trace_id long, span_id {}, span_type string, start_ns long, end_ns long"
    for kind in ("long", "string"):
        spans = one(spark, shape.format("long"), *rows).withColumn("span_id", F.col("span_id").cast(kind))
        got = {r.trace_id: (r.start_ns, r.end_ns, r.chat_start_ns, r.chat_end_ns) for r in trace_source(spans).collect()}
        assert got[1] == (3, 99, 10, 11) and got[2] == (7, 9, 7, 8) and got[3] == (1, 2, None, None)
    plan = trace_source(one(spark, shape.format("long"), *rows))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_classifier_holds_one_entry_a_row(spark):
    """Terms of the rows to predict are not grouped by row and term: a task held an entry for each."""
    train = spark.createDataFrame([("red red apple", "a"), ("blue sky sky", "b"), ("blue", "b")], "text string, label string")
    rows = [(1, "red red sky"), (2, "sky sky red blue"), (3, "unknown"), (4, None), (5, "apple apple blue sky")]
    model = pr.train_classifier(train, "text", "label")
    got = pr.classify(model, spark.createDataFrame(rows, "id int, text string"), "id", "text")
    assert {r.id: r.prediction for r in got.collect()} == {1: "a", 2: "b", 3: "b", 4: "b", 5: "b"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and not re.search(r"Aggregate\(keys=\[id#\d+, term", plan)


@pytest.mark.parametrize("repeated", [False, True])
def test_keywords_exchange_only_the_best_terms(spark, repeated):
    rows = [(i, f"common word{i % 3} word{i % 3} own{i}, Own{i} x{i % 7}") for i in range(40)] + [(50, ""), (51, None)]
    if repeated:
        rows += [(3, "own3 word1 late"), (3, None), (None, "null key common"), (None, "null key twice twice")]
    docs = spark.createDataFrame(rows, "id int, t string")
    uses, held = {}, {}
    for key, text in rows:
        for term in re.findall("[a-z0-9]+", (text or "").lower()):
            uses[key, term] = uses.get((key, term), 0) + 1
    for _, term in uses:
        held[term] = held.get(term, 0) + 1
    total, want = sum(text is not None for _, text in rows), {}
    for (key, term), tf in uses.items():
        want.setdefault(key, []).append((-round(tf * math.log((total + 1) / (held[term] + 1)), 6), term))
    want = {key: [(term, -weight) for weight, term in sorted(found)[:3]] for key, found in want.items()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        if not repeated:
            plan = kw._term_counts(docs, "id", "t")._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan
        df = kw.extract_keywords(docs, "id", "t", 3)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["id"] and "WindowGroupLimit" in plan
        got = {}
        for r in sorted(df.collect(), key=lambda r: r["rank"]):
            got.setdefault(r.id, []).append((r.term, pytest.approx(r.weight)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == want


def test_keywords_of_a_large_vocabulary(spark, monkeypatch):
    """Whatever terms count as common, the result is that of one join."""
    rows = [(i, f"all half{i % 2} third{i % 3} own{i} own{i} x{i % 7} all") for i in range(30)] + [(None, "all x1 own3")]
    docs = spark.createDataFrame(rows, "id int, t string")
    want = sorted(map(str, kw.extract_keywords(docs, "id", "t", 3).collect()))
    monkeypatch.setattr(kw, "fits_broadcast", lambda df: False)
    for common in (2, 9, 1000):
        got = kw.extract_keywords(docs, "id", "t", 3, common_terms=common)
        assert sorted(map(str, got.collect())) == want
