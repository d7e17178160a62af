import pytest
from pyspark.sql import functions as F

from fernway.operators import index as ix
from fernway.session import new_work_path
from fernway.streaming.monitor import stream_quality_monitor, windowed_quality
from fernway.streaming.sync import stream_index_sync

SCHEMA = "doc int, body string"


def embedder(spark):
    """An embedder that counts the rows it sees."""
    seen = spark.sparkContext.accumulator(0)

    def embed(rows):
        def run(batches):
            for batch in batches:
                seen.add(len(batch))
                batch["embedding"] = [[float(len(t))] for t in batch["text"]]
                yield batch

        return rows.mapInPandas(run, "id int, text string, hash string, embedding array<float>")

    return embed, seen


def content(spark, root, version=None):
    rows = ix.read_index(spark, root, version).collect()
    return {r.id: (r.text, r.embedding[0]) for r in rows}


def test_sync_embeds_changed_rows_only(spark):
    root = new_work_path(spark, "index")
    embed, seen = embedder(spark)
    first = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "ccc")], SCHEMA)
    second = spark.createDataFrame([(1, "a"), (2, "BBBB"), (4, "d")], SCHEMA)
    assert ix.committed_version(spark, root) == 0
    assert ix.index_sync(spark, root, first, "doc", "body", embed) == 1
    assert seen.value == 3
    assert ix.index_sync(spark, root, second, "doc", "body", embed) == 2
    assert seen.value == 5
    assert content(spark, root) == {1: ("a", 1.0), 2: ("BBBB", 4.0), 4: ("d", 1.0)}
    assert content(spark, root, 1) == {1: ("a", 1.0), 2: ("bb", 2.0), 3: ("ccc", 3.0)}
    assert ix.index_sync(spark, root, second, "doc", "body", embed) == 2
    assert seen.value == 5
    assert ix.compact(spark, root) == 3
    assert content(spark, root) == {1: ("a", 1.0), 2: ("BBBB", 4.0), 4: ("d", 1.0)}
    assert ix.index_sync(spark, root, first, "doc", "body", embed) == 4
    assert content(spark, root) == {1: ("a", 1.0), 2: ("bb", 2.0), 3: ("ccc", 3.0)}


def test_keys_must_be_unique(spark):
    root = new_work_path(spark, "index")
    embed, _ = embedder(spark)
    for rows in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError):
            ix.index_sync(spark, root, spark.createDataFrame(rows, SCHEMA), "doc", "body", embed)


def test_the_base_is_not_moved_when_read(spark):
    root = new_work_path(spark, "index")
    embed, _ = embedder(spark)
    for rows in ([(1, "a"), (2, "b")], [(1, "a"), (2, "c")]):
        ix.index_sync(spark, root, spark.createDataFrame(rows, SCHEMA), "doc", "body", embed)
    plan = ix.read_index(spark, root)._jdf.queryExecution().executedPlan().toString()
    anti = plan[plan.index("BroadcastHashJoin") :]
    assert "LeftAnti" in anti.splitlines()[0] and "SortMergeJoin" not in plan


def test_rows_of_a_failed_sync_are_not_read(spark):
    root = new_work_path(spark, "index")
    embed, _ = embedder(spark)
    first = spark.createDataFrame([(1, "a")], SCHEMA)
    ix.index_sync(spark, root, first, "doc", "body", embed)
    torn = spark.read.parquet(f"{root}/rows/v=1").withColumn("text", F.lit("torn"))
    torn.write.parquet(f"{root}/rows/v=2")
    assert content(spark, root) == {1: ("a", 1.0)}
    second = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    assert ix.index_sync(spark, root, second, "doc", "body", embed) == 2
    assert content(spark, root) == {1: ("a", 1.0), 2: ("b", 1.0)}


def test_stream_sync_ends_like_the_batch(spark):
    root, inbox = new_work_path(spark, "stream"), new_work_path(spark, "inbox")
    embed, seen = embedder(spark)
    for rows in ([(1, "a"), (2, "bb")], [(2, "BBB"), (3, "c")], [(3, "c")]):
        df = spark.createDataFrame(rows, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(inbox)
        stream_index_sync(spark, inbox, df.schema, root, "doc", "body", embed)
    assert content(spark, root) == {1: ("a", 1.0), 2: ("BBB", 3.0), 3: ("c", 1.0)}
    assert seen.value == 4


def test_monitor_stream_equals_batch_over_several_runs(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox, out = new_work_path(spark, "events"), new_work_path(spark, "monitor")
    middle = events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    for part in (events.where(f"event_id <= {middle}"), events.where(f"event_id > {middle}")):
        part.write.mode("append").parquet(inbox)
        got = stream_quality_monitor(spark, inbox, events.schema, out)
    want = windowed_quality(events.withColumn("ts", F.col("ts").cast("timestamp")))
    assert got.select(want.columns).exceptAll(want).isEmpty()
    assert got.count() == want.count() > 1


def test_monitor_counts_events_of_any_order(spark):
    # A table of several files, the newest events in the first batch.
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox, out = new_work_path(spark, "events.parquet"), new_work_path(spark, "monitor")
    rows = events.orderBy(F.desc("ts")).collect()
    for i in range(0, len(rows), 350):
        part = spark.createDataFrame(rows[i : i + 350], events.schema)
        part.coalesce(1).write.mode("append").parquet(inbox)
    got = stream_quality_monitor(spark, inbox, events.schema, out, files_per_batch=1, late="1 day")
    n, late = got.agg(F.sum("n"), F.sum("n_late")).first()
    assert n + late == len(rows) and late > 0
    # Where nothing counts as late, the order of the files doesn't matter.
    slow = stream_quality_monitor(
        spark, inbox, events.schema, new_work_path(spark, "monitor"), files_per_batch=1, late="4000 days"
    )
    want = windowed_quality(events.withColumn("ts", F.col("ts").cast("timestamp")))
    assert slow.select(want.columns).exceptAll(want).isEmpty() and slow.count() == want.count()
    assert slow.agg(F.sum("n_late")).first()[0] == 0


def test_monitor_reads_one_file_and_not_its_neighbours(spark, tmp_path):
    import shutil

    for name in ("events.parquet", "events.parquet_old", "events.parquet2"):
        shutil.copy("/root/testdata/sf0.001/events.parquet", tmp_path / name)
    events = spark.read.parquet(str(tmp_path / "events.parquet"))
    got = stream_quality_monitor(spark, str(tmp_path / "events.parquet"), events.schema, new_work_path(spark, "monitor"))
    assert got.agg(F.sum("n")).first()[0] == events.where("ts IS NOT NULL").count()


def test_latest_file_of_a_batch_wins(spark):
    root, inbox = new_work_path(spark, "stream"), new_work_path(spark, "inbox")
    embed, _ = embedder(spark)
    for body in ("old", "newer!"):
        df = spark.createDataFrame([(1, body), (2, "same")], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(inbox)
    stream_index_sync(spark, inbox, df.schema, root, "doc", "body", embed)
    assert content(spark, root) == {1: ("newer!", 6.0), 2: ("same", 4.0)}
