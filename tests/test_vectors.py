import re

import numpy as np
import pytest

from fernway.operators import ann as an, vectors as ve

SF = "/root/testdata/sf0.001"


def frame(spark, matrix, start=0):
    rows = [(start + i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, v array<float>")


def brute(queries, index, k):
    def unit(m):
        m = np.asarray(m, dtype=np.float32).astype(float)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n > 0, n, 1)

    scores = np.round(unit(queries) @ unit(index).T, 6)
    out = {}
    for q, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        out[q] = [(i, row[i]) for i in order]
    return out


def result(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.id, r.score))
    return got


def clustered(rng, n, width=8, clusters=6):
    centres = rng.normal(size=(clusters, width)) * 5
    return centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, width)) * 0.05


@pytest.mark.parametrize("few", [0, 100])
@pytest.mark.parametrize("kind", ["clustered", "random", "copies"])
def test_exact_join_equals_brute_force(spark, kind, few):
    rng = np.random.default_rng(5)
    index = clustered(rng, 300) if kind == "clustered" else rng.normal(size=(300, 8))
    if kind == "copies":
        index[100:220] = index[7]  # a third and more of all rows is one vector
        index[250] = 0.0
    queries = np.vstack([index[::15], rng.normal(size=(5, 8)), np.zeros((1, 8))])
    want = brute(queries, index, 4)
    got = ve.knn_join(
        frame(spark, queries), "id", "v", frame(spark, index), "id", "v", 4,
        pivots=7, slice_rows=40, query_rows=10, few=few,
    )
    got = result(got)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-6)


def test_fewer_rows_than_k(spark):
    index = np.eye(3)
    got = result(
        ve.knn_join(frame(spark, index), "id", "v", frame(spark, index), "id", "v", 5, pivots=2, few=0)
    )
    assert all(len(rows) == 3 and rows[0][0] == q for q, rows in got.items())


def shares(exact, near):
    exact, near = ({(r.query_id, r.id) for r in d.collect()} for d in (exact, near))
    return len(exact & near) / len(exact)


@pytest.mark.parametrize("apart", [False, True])
def test_stored_index_finds_nine_tenths(spark, tmp_path, apart):
    """On vectors without clusters: recall, and full vectors of at most a tenth of the rows a query."""
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries, index = (emb.where("vec_id % 4 = 0"), emb.where("vec_id % 4 > 0")) if apart else (emb, emb)
    path = str(tmp_path / "ann")
    model = an.build_ann_index(index, "vec_id", "embedding", path, k=3)
    assert 0 < model.shortlist * 3 <= index.count() / 10
    exact = ve.knn_join(queries, "vec_id", "embedding", index, "vec_id", "embedding", 3)
    assert shares(exact, an.ann_search(queries, "vec_id", "embedding", path, 3)) >= 0.9
    many = an.ann_search(queries, "vec_id", "embedding", path, 3, few=0, slice_rows=30, query_rows=300)
    assert shares(exact, many) >= 0.9
    codes = spark.read.parquet(f"{path}/rows")
    assert codes.count() == index.count()
    assert {len(r.code) for r in codes.select("code").limit(50).collect()} == {16}


def test_clustered_vectors_open_few_partitions(spark, tmp_path):
    rng = np.random.default_rng(7)
    index = frame(spark, clustered(rng, 4000, width=10, clusters=60))
    path = str(tmp_path / "ann")
    model = an.build_ann_index(index, "id", "v", path, k=5)
    assert model.probes <= len(model.coarse) / 10
    assert an.load_model(spark, path).probes == model.probes
    queries = index.where("id % 20 = 0")
    exact = ve.knn_join(queries, "id", "v", index, "id", "v", 5)
    assert shares(exact, an.ann_search(queries, "id", "v", path, 5)) >= 0.9
    # One question reads the partitions it opens and no other.
    opened = spark.read.parquet(f"{path}/rows").where(
        f"cell in ({','.join(str(c) for c in range(model.probes))})"
    )
    assert opened.count() <= index.count() / 5
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell", plan)


def test_stored_index_of_awkward_vectors(spark, tmp_path):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(40, [0.0, 0.0, 0.0]), (41, None), (42, [3.0, -1.0, 0.5])]
    index = spark.createDataFrame(rows, "id long, v array<double>")
    path = str(tmp_path / "ann")
    an.build_ann_index(index, "id", "v", path, k=2)
    got = result(an.ann_search(index.where("id > 38"), "id", "v", path, 2))
    assert got.keys() == {39, 40, 42} and got[42][0] == (42, 1.0) and [s for _, s in got[39]] == [1.0, 1.0]
    assert not result(an.ann_search(index.limit(0), "id", "v", path, 2))
    with pytest.raises(ValueError):
        an.build_ann_index(index.limit(0), "id", "v", str(tmp_path / "none"))


def test_few_queries_leave_the_index_where_it_is(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(5)
    df = ve.knn_join(emb.limit(40), "vec_id", "embedding", emb, "vec_id", "embedding", 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(query_id") == 1
    assert df.count() == 120


def exchanges(df):
    return re.findall(r"Exchange (\w+\(\w+)", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("many", [1, 3])
def test_many_queries_exchange_only_what_they_found(spark, many):
    """Of a join of many queries no vector is exchanged, however many blocks of queries there are."""
    rng = np.random.default_rng(9)
    index = frame(spark, np.repeat(clustered(rng, 60), many, axis=0))
    df = ve.knn_join(index, "id", "v", index, "id", "v", 4, pivots=5, slice_rows=16, query_rows=7, few=0)
    assert exchanges(df) == ["hashpartitioning(query_id"]
    want = brute([r.v for r in index.collect()], [r.v for r in index.collect()], 4)
    assert {q: [i for i, _ in x] for q, x in result(df).items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_many_searches_exchange_only_what_they_found(spark, tmp_path):
    index = frame(spark, clustered(np.random.default_rng(3), 600, width=10, clusters=20))
    path = str(tmp_path / "ann")
    an.build_ann_index(index, "id", "v", path, k=5)
    df = an.ann_search(index, "id", "v", path, 5, few=0, slice_rows=16, query_rows=70)
    assert exchanges(df) == ["hashpartitioning(query_id"]
    assert shares(ve.knn_join(index, "id", "v", index, "id", "v", 5), df) >= 0.9


def test_null_vectors_neither_ask_nor_are_found(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for few in (10, 0):
        got = result(ve.knn_join(df, "id", "v", df, "id", "v", 3, few=few))
        assert {q: [i for i, _ in x] for q, x in got.items()} == {1: [1, 3], 3: [3, 1]}
        assert ve.knn_join(df, "id", "v", df.limit(0), "id", "v", 3, few=few).count() == 0
        assert ve.knn_join(df.limit(0), "id", "v", df, "id", "v", 3, few=few).count() == 0
    assert [r.id for r in ve.vector_top_k(df, "id", "v", [1.0, 0.0], 3).collect()] == [1, 3]


def test_single_query_with_filter_and_zero_vector(spark):
    df = frame(spark, [[1, 0], [0, 1], [1, 1], [0, 0]]).selectExpr("*", "id % 2 AS odd")
    got = ve.vector_top_k(df, "id", "v", [1.0, 0.0], 2).collect()
    assert [(r.id, r.score) for r in got] == [(0, 1.0), (2, 0.707107)]
    got = ve.vector_top_k(df, "id", "v", [1.0, 0.0], 5, where=df.odd == 1).collect()
    assert [(r.id, r.score) for r in got] == [(1, 0.0), (3, 0.0)]


def test_embeddings_are_unit_vectors_and_equal_for_equal_text(spark):
    docs = spark.createDataFrame(
        [(1, "red apple"), (2, "red apple"), (3, "blue sky over the sea"), (4, "...")],
        "id int, text string",
    )
    model = ve.fit_embedder(docs, "text", 64)
    rows = {r.id: r.embedding for r in ve.embed_text(model, docs).collect()}
    assert rows[1] == rows[2] != rows[3]
    assert abs(np.linalg.norm(rows[3]) - 1) < 1e-5
    assert np.linalg.norm(rows[4]) == 0


def context_tables(spark, n=40):
    found = spark.createDataFrame(
        [(q, (q * 7 + r) % 12, 0.5, r) for q in range(6) for r in (1, 2, 3)], "query_id long, id long, score double, rank int"
    )
    texts = [(i, f"text {i}") for i in range(n)] + [(3, "again"), (4, None), (None, "nobody")]
    return found, spark.createDataFrame(texts, "doc_id long, text string")


@pytest.mark.parametrize("most", [ve.ASKED_IDS, 0])
def test_context_takes_every_passage_with_an_asked_id(spark, monkeypatch, most):
    monkeypatch.setattr(ve, "ASKED_IDS", most)
    found, passages = context_tables(spark)
    got = {r.query_id: (r.n_passages, r.context) for r in ve.retrieve_context(found, passages, "doc_id", "text").collect()}
    held = {}
    for p in passages.collect():
        held.setdefault(p.doc_id, []).append(p.text)
    want = {}
    for f in sorted(found.collect(), key=lambda f: f["rank"]):
        # Nulls come first and count, but are not joined.
        want.setdefault(f.query_id, []).extend(sorted(held[f.id], key=lambda t: t or ""))
    assert got == {q: (len(x), "\n\n".join(t for t in x if t is not None)) for q, x in want.items()}


def test_context_exchanges_no_passage_that_nobody_asked_for(spark):
    """The passages meet the asked ids where they lie, before their exchange."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, passages = context_tables(spark)
        plan = ve.retrieve_context(found, passages, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    moved = [i for i, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(id", x)]
    below = [lines[i + 1] + lines[i + 2] for i in moved]
    assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in below), plan
