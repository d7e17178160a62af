"""Range-wise computations equal plain windows, also when one key holds most rows."""

from pyspark.sql import Window as W, functions as F

from fernway.functions import joins
from fernway.functions.ordered import dense_number, neighbour_value


def skewed(spark):
    # Key 0 holds two thirds of all rows; numbers leave gaps.
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 17).alias("k"),
        (F.col("id") * 7 % 9000).alias("turn"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), "id")).alias("text"),
    )


def test_neighbours_equal_lag_and_lead(spark):
    df = skewed(spark)
    by = W.partitionBy("k").orderBy("turn")
    for following, step in ((False, F.lag), (True, F.lead)):
        want = df.withColumn("n", step("text").over(by))
        got = neighbour_value(
            df, ["k"], "turn", F.expr("turn div 64"), {"n": "text"}, following=following
        )
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_dense_number_equals_row_number(spark):
    df = skewed(spark)
    want = df.withColumn("n", (F.row_number().over(W.orderBy("k", "turn")) - 1).cast("long"))
    got = dense_number(df, ["k", "turn"], "n")
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert dense_number(df.limit(0), ["k", "turn"], "n").isEmpty()


def test_lookup_is_broadcast_only_within_the_limit(spark, monkeypatch):
    small = spark.range(17).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert joins.fits_broadcast(small)
    assert not joins.fits_broadcast(small, max_rows=16)
    assert not joins.fits_broadcast(small, max_bytes=100)
    big = skewed(spark)
    near = joins.lookup_join(big, small, ["k"])
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    far = joins.lookup_join(big, small, ["k"])
    assert "rightHint=(strategy=broadcast)" in near._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in far._jdf.queryExecution().optimizedPlan().toString()
    assert near.exceptAll(far).isEmpty() and near.count() == far.count() == 3000


def test_top_rows_are_cut_before_the_exchange(spark):
    from fernway.operators.sampling import stratified_sample

    df = skewed(spark).withColumnRenamed("turn", "id")
    plan = stratified_sample(df, "k", "id", 5)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 5, Partial")
    assert plan.index("Exchange hashpartitioning") < partial
