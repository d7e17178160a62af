"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from . import chat, langid, lines, mixing, near, periods, phrases, pieces, quality, suffix, urls, warc, winnow
from .common import begin, bind, sha256, words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    begin(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc.doc_id", "n_lines", "n_dropped", sha256(F.col("kept")).alias("kept_sha256")
    )


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.near_components(docs, percent=75).select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@query
def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, length=400).select(
        "doc.doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        suffix.digest(F.col("kept")).alias("kept_sha256"),
    )


def list_entries(captures: DataFrame) -> DataFrame:
    """Dated entries of a block list, made from the hosts of the captures and the domains above
    them: a hash of the name says whether and when it is added, removed and added again."""
    names = (
        captures.select(F.explode(urls.parents(urls.host_of(F.col("url")))).alias("pattern"))
        .where("pattern <> ''")
        .distinct()
    )
    v = F.conv(F.left(F.md5("pattern"), F.lit(7)), 16, 10).cast("int")
    first = F.lit(19723) + F.floor(v / 16) % 300  # from 2024-01-01 on
    dated = {
        "add": (v % 5 == 0, first),
        "remove": (v % 10 == 0, first + 20 + v % 50),
        "again": (v % 20 == 0, first + 100),
    }
    rows = [
        F.when(on, F.struct(day.cast("int").alias("day"), F.lit(a.replace("again", "add")).alias("action")))
        for a, (on, day) in dated.items()
    ]
    return names.select("pattern", F.inline(F.filter(F.array(*rows), lambda e: e.isNotNull())))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit(19723) + F.conv(F.left(F.md5(F.col("page_id").cast("string")), F.lit(7)), 16, 10).cast("int") % 366
    captures = table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetch_day"))
    found = urls.filter_urls(captures, list_entries(captures))
    return found.select("doc.page_id", "host", "doc.fetch_day", "listed", "matched", "since")


@query
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnow.fingerprint_edits(docs).select(
        "doc_id",
        "n_chars",
        sha256(F.col("edited")).alias("edited_sha256"),
        winnow.shown(F.col("chosen")).alias("fingerprint"),
        winnow.shown(F.col("edited_chosen")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    profiles = langid.learn_profiles(docs.where(~held))
    found = langid.predict_languages(docs.select("doc_id", "text"), profiles)
    return found.select(
        "doc.doc_id",
        langid.held_out(F.col("doc.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_pieces(docs, piece_model()).select(
        "doc.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge_quality(docs).select(
        "doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).drop("key", "occ")


# Conversation -7: texts that consist of control strings.
TRICKY = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    found = chat.format_chats(turns.unionByName(tricky)).select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_learned(F.col("formatted"), F.col("loss")), "").alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256(F.array_join(line, "")).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        sha256(F.col("learned")).alias("loss_sha256"),
        "formatted_chars",
    )


def with_planted_periods(doc_id: Column, text: Column) -> Column:
    """Every tenth text, by the checksum of its id, goes on with a period from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        old = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, old(i).cast("int"))), " ")

    changed = bind(words(text), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))
    return F.when(h % 10 == 0, changed).otherwise(text)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", with_planted_periods(F.col("doc_id"), F.col("text")).alias("text")
    )
    found = periods.periodic_runs(docs)
    # Fractions are compared by cross multiplication; runs come by start, then period.
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha256(F.array_join(line, "")).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        phrases.collocations(docs)
        .withColumn("rank", F.row_number().over(best))
        .where("rank <= 2000")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
