"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import scalars, text as tx
from ..operators import (
    ann as an,
    assessments as ev,
    chunking as ch,
    generators as gen,
    index as ix,
    keywords as kw,
    predict as pr,
    sampling as sa,
    scoring as sc,
    tables as tb,
    vectors as ve,
)
from ..session import new_work_path
from ..sources import changes, files, html, tables as st
from ..streaming import monitor, sync
from .fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters that queries and their SQL share.
AS_OF = "1998-06-30"
CITY_ALIASES = {"los angeles": "CITY_0", "la": "CITY_0", "new york": "CITY_1", "ny": "CITY_1"}
FILES = [f"src{i}" for i in range(20)]
CLIENTS = [f"client_{i // 5}" for i in range(20)]
QUERY_VECTOR = [0.125] * 64
LABEL_ALIASES = {"home loan": "Mortgage Loan", "mortgage": "Mortgage Loan", "car loan": "Auto Loan"}
PRICES = {"small": (0.05, 0.2), "large": (3.0, 15.0)}
ROUTE_OF = {
    "view": "text_processing_agent",
    "click": "patient_lookup_agent",
    "purchase": "final_agent",
}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
    return function


def joined(array, by: str = "|"):
    """Array of text as one text, for comparison by value."""
    return F.array_join(array, by, "NULL")


def flat_rated(df: DataFrame) -> DataFrame:
    """Nested assessment columns as plain ones."""
    answer = F.col("text_assessment.ratings.answer_correct.value")
    return df.select(
        "request_id",
        F.col("source.id").alias("source_id"),
        "step_id",
        F.col("timestamp").cast("string").alias("ts"),
        answer.alias("is_correct"),
        F.col("text_assessment.suggested_output").alias("suggested_output"),
        joined(
            F.transform(
                "retrieval_assessment",
                lambda a: F.concat_ws("=", a["position"], a["ratings"]["answer_correct"]["value"]),
            )
        ).alias("chunk_ratings"),
    )


# Sources and sinks ---------------------------------------------------------------------


@query
def read_text_files(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "text-files")
    lines = t.documents.select(F.translate("text", "\r\n", "  ").alias("value"), "lang", "source")
    lines.write.option("maxRecordsPerFile", 1_000).partitionBy("lang", "source").text(path)
    read = files.read_text_files(t.spark, path, "*.txt")
    rows = read.select(
        F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang"),
        F.regexp_extract("path", "source=([^/]+)", 1).alias("source"),
        F.explode(F.split("text", "\n")).alias("line"),
    ).where("line <> ''")
    return rows.groupBy("lang", "source").agg(
        F.count("*").alias("n_documents"), F.sum(F.length("line")).alias("n_chars")
    )


@query
def path_fields(t: Tables) -> DataFrame:
    both = t.article_files.select("path").unionByName(t.ticket_files.select("path"))
    return files.path_fields(both)


@query
def parse_article(t: Tables) -> DataFrame:
    parsed = files.parse_article(t.article_files)
    return parsed.withColumn("tags", joined("tags")).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("last_updated", "generated")}
    )


@query
def parse_ticket(t: Tables) -> DataFrame:
    return files.parse_ticket(t.ticket_files).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("created", "resolved")}
    )


@query
def read_csv(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "csv")
    rows = t.examples.select(
        F.col("template").alias("description"),
        F.lower("template").alias("description_cln"),
        "target",
        F.col("example_id"),
    )
    rows.write.option("header", "true").option("escape", '"').csv(path)
    return files.read_csv(
        t.spark,
        path,
        "description string, description_cln string, target string, example_id bigint",
        multiLine="true",  # the descriptions have line breaks
        drop=["description_cln"],
        lineSep="\n",
    )


@query
def html_to_text(t: Tables) -> DataFrame:
    return html.read_pages(t.pages, "page_id", "html")


TEAMS = [
    {"segment": "AUTOMOBILE", "team": "north"},
    {"segment": "BUILDING", "team": "south"},
    {"segment": "MACHINERY", "team": None},
]


@query
def rows_to_df(t: Tables) -> DataFrame:
    teams = st.rows_to_df(t.spark, TEAMS, "segment string, team string")
    found = t.customer.join(F.broadcast(teams), F.col("c_mktsegment") == F.col("segment"))
    return found.groupBy("segment", "team").agg(
        F.count("*").alias("n_customers"), F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents")
    )


@query
def write_table(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "visits")
    st.write_table(t.visits, path, partition_by=["city"])
    again = st.write_table(t.visits.where("status <> 'O'"), path, "overwrite", ["city"])
    return again.groupBy("city", "status").agg(
        F.count("*").alias("n_visits"), F.max("visit_id").alias("last_visit")
    )


@query
def table_ddl(t: Tables) -> DataFrame:
    place = new_work_path(t.spark, "ddl")
    name = "fernway_" + place.rsplit("-", 1)[1]
    st.create_schema(t.spark, "default")
    st.drop_table(t.spark, name)
    columns = "practice_id bigint, practice_name string, network_status string"
    st.create_table(t.spark, name, columns, place, {"purpose": "check"})
    st.create_table(t.spark, name, columns, place)
    st.set_properties(t.spark, name, {"synced": "true"})
    t.practices.select("practice_id", "practice_name", "network_status").write.insertInto(name)
    rows = t.spark.table(name)
    counted = rows.groupBy("network_status").agg(F.count("*").alias("n_practices"))
    out = st.write_table(counted, new_work_path(t.spark, "ddl-result"))
    st.drop_table(t.spark, name)
    return out


@query
def trace_source(t: Tables) -> DataFrame:
    return st.trace_source(t.spans)


@query
def stringify_complex(t: Tables) -> DataFrame:
    calm = F.col("event_type") != "view"
    nested = t.events.select(
        "event_id",
        "event_type",
        F.when(calm, F.struct("event_type", "user_id")).alias("tags"),
        F.when(calm, F.array("event_id", "user_id")).alias("spans"),
    )
    return st.stringify_complex(nested)


@query
def to_json_text(t: Tables) -> DataFrame:
    row = F.struct("o_orderkey", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        st.to_json_text(row, T.StructType()).alias("as_json"),
        st.to_json_text(key, T.LongType()).alias("as_text"),
    )


@query
def preview(t: Tables) -> DataFrame:
    return st.preview(t.visits.select("visit_id", "patient", "city"), "visit_id", 10)


@query
def table_snapshot_changes(t: Tables) -> DataFrame:
    return changes.table_snapshot_changes(
        t.snapshot_old, t.snapshot_new, "doc_id", ["text"]
    ).select("doc_id", "change")


@query
def delete_detect(t: Tables) -> DataFrame:
    return changes.delete_detect(t.snapshot_old, t.snapshot_new, "doc_id")


# Projections and filters ---------------------------------------------------------------


@query
def project_rename_drop(t: Tables) -> DataFrame:
    return (
        t.assessment_log.withColumnRenamed("req_no", "request_id")
        .withColumn("day", F.to_date("ts").cast("string"))
        .drop("ts", "step_id", "suggested_output")
    )


@query
def filter_not_null(t: Tables) -> DataFrame:
    return t.nested_assessments.where(F.col("text_assessment").isNotNull()).select(
        "event_id", "request_id"
    )


@query
def blank_to_null(t: Tables) -> DataFrame:
    return t.assessment_log.select(
        "event_id", scalars.blank_to_null(F.col("suggested_output")).alias("suggested_output")
    )


@query
def nested_field(t: Tables) -> DataFrame:
    return t.nested_assessments.select(
        "event_id",
        F.col("source.id").alias("source_id"),
        F.col("text_assessment.ratings.answer_correct.value").alias("answer"),
        F.col("retrieval_assessment.position").alias("position"),
    )


def rated_requests(t: Tables) -> DataFrame:
    return ev.attach_ground_truth(
        t.traced_requests, ev.dedup_assessment_log(t.nested_assessments)
    )


@query
def attach_ground_truth(t: Tables) -> DataFrame:
    return rated_requests(t).select(
        F.col("log_request_id").alias("request_id"),
        "request",
        "is_correct",
        "suggested_output",
        "source_user",
    )


def tagged(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("log_request_id").alias("request_id"),
        "source_user",
        "source_tag",
        "expected_response",
    )


@query
def feedback_partition(t: Tables) -> DataFrame:
    return tagged(ev.feedback_partition(rated_requests(t)))


@query
def union_feedback(t: Tables) -> DataFrame:
    # Three branches read the rated requests, so what they need of them is written once.
    needed = rated_requests(t).select(
        "log_request_id", "source_user", "is_correct", "suggested_output", "response"
    )
    rated = st.write_table(needed, new_work_path(t.spark, "rated"))
    return tagged(ev.union_feedback(rated))


@query
def enum_check(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", "lang", scalars.in_set(F.col("lang"), ["en", "fr", "de"]).alias("valid")
    )


@query
def client_enrich(t: Tables) -> DataFrame:
    return tb.client_enrich(t.documents.select("doc_id", "source"), "source", FILES, CLIENTS)


@query
def city_insurer_filter(t: Tables) -> DataFrame:
    return tb.city_insurer_filter(
        t.visits, CITY_ALIASES, city="Los Angeles", insurer="BUILDING"
    ).select("visit_id", "patient", "city", "insurer")


@query
def range_filter(t: Tables) -> DataFrame:
    return tb.range_filter(
        t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", low=6500.0, high=9000.0
    )


def half_of(key):
    """0 or 1 by hash, about half each."""
    return F.conv(F.left(F.md5(F.concat(key.cast("string"), F.lit("-1"))), F.lit(7)), 16, 10).cast("int") % 2


def toxic_terms(t: Tables) -> tuple[list[tuple[str, float]], DataFrame]:
    """Terms learned from about half of the labelled documents, and all other documents."""
    ids = t.labels.where(half_of(F.col("doc_id")) == 0).select("doc_id", "toxic")
    texts = t.documents.select("doc_id", "text")
    return sc.learned_terms(texts.join(ids, "doc_id"), "text", "toxic"), texts.join(ids, "doc_id", "left_anti")


@query
def note_severity(t: Tables) -> DataFrame:
    learned, rest = toxic_terms(t)
    weights = {term: round(odds * 10) for term, odds in learned}
    return tb.note_severity(rest, "doc_id", "text", weights, 25)


@query
def recency_filter(t: Tables) -> DataFrame:
    visits = t.visits
    people = t.customer.select(F.col("c_name").alias("patient"))

    def kind(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("kind"), "patient")

    return (
        kind(tb.visits_within(visits, AS_OF, 30), "last_30_days")
        .unionByName(kind(tb.visits_within(visits, AS_OF, -7), "next_7_days"))
        .unionByName(kind(tb.not_seen_since(people, visits, "patient", AS_OF, 6), "overdue"))
    )


# Joins ---------------------------------------------------------------------------------


@query
def merge_assessments(t: Tables) -> DataFrame:
    log = t.nested_assessments
    return flat_rated(
        ev.merge_assessments(
            ev.latest_text_assessment(log), ev.nest_retrieval(ev.latest_retrieval_assessment(log))
        )
    )


@query
def dedup_assessment_log(t: Tables) -> DataFrame:
    return flat_rated(ev.dedup_assessment_log(t.nested_assessments))


@query
def feature_lookup(t: Tables) -> DataFrame:
    line = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("flag"), "l_quantity"
    )
    features = line.groupBy("o_orderkey", "flag").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
    asked = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", "N").otherwise("R").alias("flag"),
    )
    return tb.feature_lookup(asked, features, ["o_orderkey", "flag"])


def labelled(t: Tables) -> DataFrame:
    joined_label = F.concat_ws("-", "quality", "toxic")
    return t.labels.select("doc_id", joined_label.alias("label"))


@query
def label_coverage(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.concat_ws("-", "lang", F.length("source")).alias("label"))
    train = rows.join(t.labels.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    covered = sa.label_coverage(train, rows, "label").withColumn("covered", F.lit(True))
    gaps = sa.label_gaps(train, rows, "label").withColumn("covered", F.lit(False))
    return covered.unionByName(gaps)


@query
def variant_grid(t: Tables) -> DataFrame:
    return sc.variant_grid(t.examples.select("example_id", "target"), ["small", "tuned", "large"])


@query
def company_profile(t: Tables) -> DataFrame:
    articles = t.documents.select(
        F.upper(F.replace("source", F.lit("src"), F.lit("s"))).alias("symbol"),
        F.concat(F.lit("Company "), "source").alias("company_name"),
        F.col("doc_id").alias("article_id"),
        "n_chars",
    )
    profile = tb.company_profile(t.quotes, articles)
    return st.write_table(profile, new_work_path(t.spark, "company-profile"))


@query
def visit_practice_join(t: Tables) -> DataFrame:
    return tb.visit_practice_join(t.visits, t.practices)


# Aggregates and windows ----------------------------------------------------------------


@query
def latest_text_assessment(t: Tables) -> DataFrame:
    return ev.latest_text_assessment(t.nested_assessments).select(
        "request_id", F.col("source.id").alias("source_id"), "event_id"
    )


@query
def latest_retrieval_assessment(t: Tables) -> DataFrame:
    return ev.latest_retrieval_assessment(t.nested_assessments).select(
        "request_id",
        F.col("source.id").alias("source_id"),
        F.col("retrieval_assessment.position").alias("position"),
        "event_id",
    )


@query
def nest_retrieval(t: Tables) -> DataFrame:
    nested = ev.nest_retrieval(ev.latest_retrieval_assessment(t.nested_assessments))
    return nested.select(
        "request_id",
        F.col("source.id").alias("source_id"),
        "step_id",
        F.col("timestamp").cast("string").alias("ts"),
        joined(scalars.rating_values(F.col("retrieval_assessments"))).alias("ratings"),
    )


@query
def mean_score(t: Tables) -> DataFrame:
    scored = t.examples.select(
        "target",
        sc.score_correctness(F.col("verdict"), F.col("target"), F.col("prediction")).alias("s"),
    )
    return sc.mean_score(scored, "s", ["target"])


@query
def distinct_labels(t: Tables) -> DataFrame:
    return sa.distinct_labels(labelled(t), "label")


@query
def visits_per_patient(t: Tables) -> DataFrame:
    return tb.visits_per_patient(t.visits).withColumn("reasons", joined("reasons"))


@query
def mode_per_key(t: Tables) -> DataFrame:
    return tb.mode_per_key(t.visits, "patient", "city")


@query
def missed_more_than(t: Tables) -> DataFrame:
    year = (F.col("visit_date") > F.lit("1997-06-30").cast("date")) & (
        F.col("visit_date") <= F.lit(AS_OF).cast("date")
    )
    return tb.more_than(t.visits, "patient", 2, year & (F.col("status") == "F"))


@query
def attribute_per_key(t: Tables) -> DataFrame:
    return tb.attribute_per_key(t.visits, "patient", ["insurer", "city"])


@query
def latest_note(t: Tables) -> DataFrame:
    return tb.latest_note(t.visits, "patient", "reason").withColumn(
        "visit_date", F.col("visit_date").cast("string")
    )


@query
def latest_per_key(t: Tables) -> DataFrame:
    return tb.latest_quote(t.quotes)


@query
def latest_version(t: Tables) -> DataFrame:
    models = t.part.select(
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 5 == 0, "draft").otherwise(F.col("p_size").cast("string")).alias(
            "version"
        ),
    )
    return tb.latest_version(models, "name", "version")


@query
def stratified_sample(t: Tables) -> DataFrame:
    return sa.stratified_sample(labelled(t), "label", "doc_id", 20)


@query
def train_test_split(t: Tables) -> DataFrame:
    return sa.train_test_split(labelled(t), "label", "doc_id", 3, 10)


@query
def pct_drop(t: Tables) -> DataFrame:
    return tb.pct_drop(t.quotes, 5.0).withColumn("day", F.col("day").cast("string"))


@query
def conversation_history(t: Tables) -> DataFrame:
    history, _ = tb.conversation_history(t.conversations)
    return history.withColumn(
        "page_history",
        joined(F.transform("page_history", lambda h: F.concat_ws(":", h["turn"], h["role"], h["text"]))),
    )


@query
def full_history(t: Tables) -> DataFrame:
    last = t.conversations.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    found = tb.full_history(last, t.conversations, page_turns=4)
    lines = F.transform("history", lambda h: F.concat_ws(":", h["turn"], h["role"], h["text"]))
    return found.select("conv_id", "turn", joined(lines).alias("history"))


@query
def history_pages(t: Tables) -> DataFrame:
    _, pages = tb.conversation_history(t.conversations, page_turns=4)
    return pages.withColumn(
        "turns", joined(F.transform("turns", lambda h: F.concat_ws(":", h["turn"], h["text"])))
    )


@query
def top_k_global(t: Tables) -> DataFrame:
    counted = t.visits.groupBy("patient").agg(F.count("*").alias("n_visits"))
    return tb.top_k(counted, [F.desc("n_visits"), F.col("patient")], 10)


@query
def rank_variants(t: Tables) -> DataFrame:
    grid = sc.variant_grid(t.examples, ["small", "tuned", "large"])
    hit = (
        F.when(F.col("variant") == "small", F.col("target") == F.col("prediction"))
        .when(F.col("variant") == "tuned", F.col("verdict") == "YES")
        .otherwise(F.col("tool_rating") != "Low")
    )
    scored = grid.select("variant", F.coalesce(hit, F.lit(False)).cast("int").alias("score"))
    return sc.rank_variants(scored, "variant", "score", "small")


# Scalars -------------------------------------------------------------------------------


@query
def sql_functions(t: Tables) -> DataFrame:
    scalars.register_functions(t.spark)
    t.documents.createOrReplaceTempView("fernway_documents")
    return t.spark.sql("""
        SELECT doc_id, count_words(text) AS n_words, user_prefix(concat(source, '.', lang, '@x.org')) AS prefix
        FROM fernway_documents""")


@query
def word_count(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query
def render_template(t: Tables) -> DataFrame:
    prompt = tx.render(
        "Document {id} from {source}:\n{text}\nWhich language is it?",
        {"id": F.col("doc_id"), "source": F.col("source"), "text": F.col("text")},
    )
    return t.documents.select("doc_id", prompt.alias("prompt"))


@query
def row_to_sentence(t: Tables) -> DataFrame:
    sentence = F.format_string(
        "If you need a %s, for %s you will pay $%d In Network and %d%% coinsurance Out of Network.",
        "p_type",
        "p_name",
        F.col("p_retailprice").cast("long"),
        "p_size",
    )
    return t.part.select("p_partkey", sentence.alias("sentence"))


@query
def name_parts(t: Tables) -> DataFrame:
    full = F.concat_ws(".", F.lit("main"), "lang", F.concat(F.lit("tbl_"), "source"))
    parts = scalars.split_name(full)
    return t.documents.select(
        "doc_id",
        parts["catalog"].alias("catalog"),
        parts["schema"].alias("schema"),
        parts["table"].alias("table_name"),
        scalars.endpoint_name(parts["table"]).alias("endpoint"),
        F.concat(full, F.lit("_index")).alias("index_name"),
    )


@query
def user_prefix(t: Tables) -> DataFrame:
    email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    return t.customer.select(
        "c_custkey",
        scalars.user_name(email).alias("user_name"),
        scalars.user_prefix(email).alias("prefix"),
    )


@query
def upper_round(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("name"),
        F.round(F.col("p_retailprice") / 7, 2).alias("price"),
    )


@query
def ns_to_seconds(t: Tables) -> DataFrame:
    seconds = scalars.ns_to_seconds(F.col("start_ns"), F.col("end_ns"))
    return t.spans.select("span_id", F.round(seconds, 6).alias("seconds"))


@query
def zone_shift(t: Tables) -> DataFrame:
    shown = scalars.in_zone(F.col("ts").cast("timestamp"), "US/Eastern")
    return t.events.select(
        "event_id", F.date_format(shown, "yyyy-MM-dd HH:mm:ss").alias("local_time")
    )


@query
def transform_ratings(t: Tables) -> DataFrame:
    log = ev.dedup_assessment_log(t.nested_assessments)
    return log.select(
        "request_id",
        F.col("source.id").alias("source_id"),
        joined(scalars.rating_values(F.col("retrieval_assessment"))).alias("ratings"),
    )


def context_text(column: str):
    return joined(
        F.transform(column, lambda c: F.concat_ws("=", c["doc_uri"], c["content"])), "\n"
    )


@query
def zip_filter(t: Tables) -> DataFrame:
    records = ev.identify_eval_records(rated_requests(t))
    return records.select(
        "request_id", "source_user", context_text("expected_retrieved_context").alias("kept")
    )


@query
def json_extract_context(t: Tables) -> DataFrame:
    traced = t.traced_requests.select(
        F.col("log_request_id").alias("request_id"),
        scalars.trace_context(F.col("trace")).alias("chunks"),
    )
    return traced.select("request_id", context_text("chunks").alias("chunks"))


@query
def decode_base64(t: Tables) -> DataFrame:
    decoded = scalars.decode_base64(F.base64(F.encode("text", "UTF-8")))
    return t.documents.select(
        "doc_id",
        F.octet_length(decoded).alias("n_bytes"),
        F.decode(decoded, "UTF-8").alias("decoded"),
    )


@query
def extract_emails(t: Tables) -> DataFrame:
    return kw.extract_emails(t.documents, "doc_id", "text")


@query
def extract_codes(t: Tables) -> DataFrame:
    return kw.extract_codes(t.ticket_files, "text")


@query
def extract_keywords(t: Tables) -> DataFrame:
    return kw.extract_keywords(t.documents, "doc_id", "text", 5)


# Chunks, vectors, retrieval ------------------------------------------------------------


@query
def recursive_chunk(t: Tables) -> DataFrame:
    return ch.recursive_chunk(t.documents, "doc_id", "text")


@query
def window_chunk(t: Tables) -> DataFrame:
    return ch.window_chunk(t.documents, "doc_id", "text")


@query
def chunk_index(t: Tables) -> DataFrame:
    return ch.window_chunk(t.documents, "doc_id", "text").select("doc_id", "chunk_index")


@query
def structural_chunk(t: Tables) -> DataFrame:
    return ch.structural_chunk(t.pages, "page_id", "html")


@query
def chunk_ids(t: Tables) -> DataFrame:
    chunks = ch.window_chunk(t.documents, "doc_id", "text")
    return chunks.select(
        "doc_id", "chunk_index", ch.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("chunk_id")
    )


@query
def union_documents(t: Tables) -> DataFrame:
    def named(df: DataFrame, prefix: str, key: str) -> DataFrame:
        name = F.concat(F.lit(prefix), F.col(key).cast("string"))
        return ch.window_chunk(
            df.select(name.alias("document_name"), "text"), "document_name", "text"
        )

    return ch.union_documents(
        named(t.documents, "doc_", "doc_id"), named(t.benchmark, "item_", "item_id")
    )


@query
def embed_text(t: Tables) -> DataFrame:
    model = ve.fit_embedder(t.documents.select("text"), "text")
    embedded = ve.embed_text(model, t.documents.select("doc_id", "text"))
    slots = embedded.select("doc_id", F.posexplode_outer("embedding").alias("slot", "x"))
    return slots.select(
        "doc_id", "slot", F.round(F.col("x").cast("double") * 1_000_000).cast("long").alias("millionths")
    ).where("millionths <> 0")


@query
def vector_top_k(t: Tables) -> DataFrame:
    return ve.vector_top_k(t.embeddings, "vec_id", "embedding", QUERY_VECTOR, 10, ["label"])


@query
def filtered_top_k(t: Tables) -> DataFrame:
    return ve.vector_top_k(
        t.embeddings, "vec_id", "embedding", QUERY_VECTOR, 3, where=F.col("label") == 3
    )


def neighbours(t: Tables, k: int = 3) -> DataFrame:
    return ve.knn_join(
        t.embeddings, "vec_id", "embedding", t.embeddings, "vec_id", "embedding", k
    )


@query
def knn_join(t: Tables) -> DataFrame:
    return neighbours(t)


@query
def top_k_per_query(t: Tables) -> DataFrame:
    return neighbours(t, 1)


@query
def ann_top_k(t: Tables) -> DataFrame:
    path = new_work_path(t.spark, "ann-index")
    an.build_ann_index(t.embeddings, "vec_id", "embedding", path, k=3)
    return an.ann_search(t.embeddings, "vec_id", "embedding", path, 3)


@query
def retrieve_context(t: Tables) -> DataFrame:
    return ve.retrieve_context(neighbours(t), t.documents, "doc_id", "text")


@query
def index_sync(t: Tables) -> DataFrame:
    root = new_work_path(t.spark, "index")
    model = ve.fit_embedder(t.snapshot_old.select("text"), "text")

    def embed(rows: DataFrame) -> DataFrame:
        return ve.embed_text(model, rows)

    ix.index_sync(t.spark, root, t.snapshot_old, "doc_id", "text", embed)
    ix.index_sync(t.spark, root, t.snapshot_new, "doc_id", "text", embed)
    return ix.read_index(t.spark, root).select(
        "id", F.sha2("text", 256).alias("text_hash"), F.col("v").cast("int").alias("version")
    )


@query
def lookup_then_retrieve(t: Tables) -> DataFrame:
    questions = t.benchmark.select("item_id", "text")
    model = ve.fit_embedder(t.documents.select("text"), "text")
    # Searched several times, so embedded once and kept as a table.
    documents = st.write_table(
        ve.embed_text(model, t.documents.select("doc_id", "text")).select("doc_id", "embedding"),
        new_work_path(t.spark, "embedded"),
    )
    words = kw.extract_keywords(questions, "item_id", "text", 5)
    asked = st.write_table(
        ve.embed_text(model, questions).select("item_id", "embedding"),
        new_work_path(t.spark, "asked"),
    )
    near = ve.knn_join(asked, "item_id", "embedding", documents, "doc_id", "embedding", 3)
    customers = t.customer.select(
        F.col("c_custkey").alias("item_id"),
        F.concat_ws(" is insured by ", "c_name", "c_mktsegment").alias("answer"),
    )
    found = tb.feature_lookup(questions.select("item_id"), customers, ["item_id"])
    passages = t.documents.select(F.col("doc_id").alias("id"), "text")
    return kw.lookup_then_retrieve(found, words, near, passages, "item_id")


# Models and scores ---------------------------------------------------------------------


def load_echo_model():
    """A stand-in with a known answer: capital letters and the number of words."""

    def model(texts: pd.Series) -> pd.Series:
        return texts.str.len().astype(str) + ":" + texts.str.count(" ").astype(str)

    return model


@query
def batch_predict(t: Tables) -> DataFrame:
    return pr.batch_predict(t.documents.select("doc_id", "text"), "text", load_echo_model).select(
        "doc_id", "prediction"
    )


TYPED = T.StructType(
    [
        T.StructField("label", T.StringType(), False),
        T.StructField("score", T.IntegerType(), False),
        T.StructField("ok", T.BooleanType(), False),
    ]
)


@query
def parse_typed_output(t: Tables) -> DataFrame:
    return pr.parse_typed_output(t.model_texts, "raw", TYPED)


@query
def text_classifier(t: Tables) -> DataFrame:
    # Ids are sampled before their texts are fetched; what isn't in the sample is predicted.
    docs = t.documents.select("doc_id", "text", F.col("lang").alias("label"))
    ids = docs.select("doc_id", "label")
    split = sa.train_test_split(ids, "label", "doc_id", 40, 40).where("split = 'train'").select("doc_id")
    model = pr.train_classifier(docs.join(split, "doc_id"), "text", "label")
    held_out = docs.join(split, "doc_id", "left_anti")
    return pr.classify(model, held_out, "doc_id", "text").select("doc_id", "label", "prediction")


@query
def score_label_guideline(t: Tables) -> DataFrame:
    response = F.col("response")
    return t.answers.select(
        "example_id",
        sc.named_label(response, sc.PRODUCT_LABELS).alias("label"),
        sc.score_label_guideline(response).alias("value"),
    )


@query
def score_rationale(t: Tables) -> DataFrame:
    return t.answers.select("example_id", sc.score_rationale(F.col("response")).alias("value"))


@query
def score_safety(t: Tables) -> DataFrame:
    learned, rest = toxic_terms(t)
    return rest.select("doc_id", sc.score_safety(F.col("text"), [term for term, _ in learned]).alias("value"))


@query
def score_relevance(t: Tables) -> DataFrame:
    request, response = F.col("request"), F.col("response")
    return t.request_log.select(
        "req_no",
        F.round(sc.term_coverage(request, response), 6).alias("coverage"),
        sc.score_relevance(request, response).alias("value"),
    )


@query
def score_latency(t: Tables) -> DataFrame:
    return sc.score_latency(st.trace_source(t.spans))


@query
def score_length(t: Tables) -> DataFrame:
    return t.answers.select("example_id", sc.score_length(F.col("response")).alias("value"))


@query
def map_rating_numeric(t: Tables) -> DataFrame:
    return t.answers.select("example_id", sc.map_rating_numeric(F.col("rating")).alias("value"))


@query
def composite_score(t: Tables) -> DataFrame:
    tool, form = F.col("tool_rating"), F.col("format_rating")
    return t.examples.select(
        "example_id",
        F.round(sc.composite_score(tool, form), 6).alias("value"),
        sc.composite_feedback(tool, form).alias("feedback"),
    )


@query
def score_correctness(t: Tables) -> DataFrame:
    score = sc.score_correctness(F.col("verdict"), F.col("target"), F.col("prediction"))
    return t.examples.select("example_id", score.alias("value"))


def example_scorers() -> dict[str, sc.Scorer]:
    text = F.col("template")
    return {
        "safety": lambda: sc.score_safety(text),
        "length": lambda: sc.score_length(text),
        "correctness": lambda: sc.score_correctness(
            F.col("verdict"), F.col("target"), F.col("prediction")
        ),
        "tool_grade": lambda: sc.map_rating_numeric(F.col("tool_rating"), sc.GRADES),
    }


@query
def run_scorers(t: Tables) -> DataFrame:
    return sc.run_scorers(t.examples, "example_id", example_scorers())


@query
def score_summary(t: Tables) -> DataFrame:
    return sc.score_summary(sc.run_scorers(t.examples, "example_id", example_scorers()))


@query
def score_language(t: Tables) -> DataFrame:
    # Stop words are learned from about half of the documents, and all others are judged.
    docs = t.documents.withColumn("half", half_of(F.col("doc_id")))
    learned = sc.learned_stop_words(docs.where("half = 0"), "text", "lang")
    found = sc.score_language(F.col("text"), learned)
    rows = docs.where("half = 1").select("doc_id", "lang", found.alias("f"))
    return rows.select(
        "doc_id",
        F.col("f.language").alias("language"),
        F.col("f.share").alias("share"),
        F.equal_null(F.col("f.language"), F.col("lang")).alias("agrees"),
    )


@query
def score_out_of_scope(t: Tables) -> DataFrame:
    return t.answers.select(
        "example_id", sc.score_out_of_scope(F.col("expected"), F.col("response")).alias("value")
    )


@query
def score_overlap(t: Tables) -> DataFrame:
    return sc.score_overlap(t.request_log, "req_no", "response", "request")


@query
def score_rouge_l(t: Tables) -> DataFrame:
    return sc.score_lcs(t.request_log, "req_no", "response", "request")


@query
def score_cost(t: Tables) -> DataFrame:
    model = F.when(F.col("req_no") % 2 == 0, "small").otherwise("large")
    cost = sc.score_cost(F.col("request"), F.col("response"), model, PRICES)
    return t.request_log.select("req_no", F.round(cost, 6).alias("cost"))


@query
def normalize_synonyms(t: Tables) -> DataFrame:
    named = F.substring_index("response", ".", 1)
    return t.answers.select(
        "example_id", sc.normalize_synonyms(named, LABEL_ALIASES).alias("label")
    )


@query
def trajectory_tools(t: Tables) -> DataFrame:
    tools = sc.tool_calls(F.col("trajectory"))
    return t.trajectories.select(
        "req_no",
        joined(tools, ",").alias("tools"),
        F.size(tools).alias("n_calls"),
        F.array_contains(tools, "web_search").alias("has_mandatory"),
    )


@query
def next_step_route(t: Tables) -> DataFrame:
    route = sc.next_step_route(F.col("event_type"), ROUTE_OF, "final_agent")
    return t.events.select(
        "event_id", route.alias("route"), scalars.in_set(route, sc.ROUTES).alias("valid")
    )


# Evaluation sets -----------------------------------------------------------------------


def flat_records(records: DataFrame) -> DataFrame:
    return records.select(
        "request_id",
        "request",
        "is_correct",
        "suggested_output",
        "source_user",
        "expected_response",
        "source_tag",
        joined("chunk_at_i_relevance").alias("chunk_at_i_relevance"),
        context_text("expected_retrieved_context").alias("expected_retrieved_context"),
    )


@query
def identify_eval_records(t: Tables) -> DataFrame:
    return flat_records(ev.identify_eval_records(rated_requests(t)))


@query
def potential_eval_set(t: Tables) -> DataFrame:
    return flat_records(
        ev.potential_eval_set(t.traced_requests, ev.dedup_assessment_log(t.nested_assessments))
    )


@query
def eval_from_traces(t: Tables) -> DataFrame:
    return ev.eval_from_traces(t.traced_requests).select(
        "request_id", F.col("inputs.template").alias("template"), "outputs", "n_chunks"
    )


@query
def synthetic_questions(t: Tables) -> DataFrame:
    return ch.synthetic_questions(ch.window_chunk(t.documents, "doc_id", "text"), "doc_id")


# Generators and streams ----------------------------------------------------------------


@query
def gen_visits(t: Tables) -> DataFrame:
    return gen.gen_visits(t.orders, "o_orderkey")


@query
def gen_practices(t: Tables) -> DataFrame:
    return gen.gen_practices(t.supplier, "s_suppkey")


@query
def stream_index_sync(t: Tables) -> DataFrame:
    root = new_work_path(t.spark, "stream-index")
    arrivals = new_work_path(t.spark, "arrivals")
    model = ve.fit_embedder(t.snapshot_old.select("text"), "text")

    def embed(rows: DataFrame) -> DataFrame:
        return ve.embed_text(model, rows)

    for batch in (t.snapshot_old, t.snapshot_new):
        batch.write.mode("append").parquet(arrivals)
        sync.stream_index_sync(
            t.spark, arrivals, batch.schema, root, "doc_id", "text", embed
        )
    return ix.read_index(t.spark, root).select("id", F.sha2("text", 256).alias("text_hash"))


@query
def stream_quality_monitor(t: Tables) -> DataFrame:
    figures = monitor.stream_quality_monitor(
        t.spark,
        f"{t.sf_dir}/events.parquet",
        t.events.schema,
        new_work_path(t.spark, "monitor"),
    )
    return figures.withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    )
