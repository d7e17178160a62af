"""Approximate nearest neighbours on a stored inverted file with product-quantised codes.

The index is a folder with two tables. ``rows`` has ids, codes and vectors, partitioned by ``cell``, the
nearest of the coarse centroids; a code takes one byte for every four numbers of a vector and
quantises what is left after the centroid (Jegou, Douze, Schmid: TPAMI 33(1), 2011). ``model`` holds the
trained numbers and what was measured when the index was built: how many cells a query opens
and how many candidates it keeps, so that the wanted share of true neighbours is found.

A search opens the partitions of the cells that its queries probe and reads the column of their
codes; vectors are compared for the best candidates only. With many queries the vectors of the opened cells
are compared at once, without codes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.joins import lookup_join
from ..session import stored
from .vectors import (
    DIGITS,
    FEW_QUERIES,
    QUERY_ROWS,
    SCANNED_AT_ONCE,
    SCORED_AT_ONCE,
    SLICE_ROWS,
    Best,
    blocks_of,
    few_queries,
    knn_join,
    matrix_of,
    number_type,
    paired_blocks,
    sampled_vectors,
    scan_pairs,
    scan_top_k,
)

PART = 4  # numbers of a vector that share one byte of its code
TRAIN_ROWS = 16_384  # vectors that centroids are trained on
CELLS = (16, 4_096)
ROUNDS = 8
# Index vectors asked for when the index is built, and the standard errors held in reserve.
HELD_QUERIES = 256
Z = 2.0
SHORTLISTS = (2, 4, 8, 16, 32, 64, 128)  # times k
ROWS = "id long, code binary, vec array<double>, cell int"
CANDIDATES = "query_id long, id long, score double"


@dataclass
class Model:
    coarse: np.ndarray  # cells x width, unit vectors
    books: np.ndarray  # parts x 256 x PART
    width: int
    probes: int = 0  # cells a query opens
    shortlist: int = 0  # candidates a query keeps, for every neighbour wanted; 0: the search is exact

    def padded(self, unit: np.ndarray) -> np.ndarray:
        return np.pad(unit, ((0, 0), (0, len(self.books) * PART - unit.shape[1])))

    def cells_of(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.coarse.T).argmax(axis=1)

    def probed(self, unit: np.ndarray, probes: int) -> np.ndarray:
        """The cells that each query opens, nearest first."""
        return (-(unit @ self.coarse.T)).argsort(axis=1, kind="stable")[:, :probes]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = self.cells_of(unit)
        rest = self.padded(unit - self.coarse[cells])
        codes = np.empty((len(unit), len(self.books)), np.uint8)
        for m, book in enumerate(self.books):
            codes[:, m] = _nearest(rest[:, m * PART : (m + 1) * PART], book)
        return cells, codes

    def decode(self, cells, codes: np.ndarray) -> np.ndarray:
        """Vectors that the codes stand for; a query's product with one is its estimated cosine."""
        parts = self.books[np.arange(len(self.books)), codes]
        return self.coarse[cells] + parts.reshape(len(codes), -1)[:, : self.width]


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)


def _means(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """``n`` centroids of the rows by Lloyd's rounds; those that nothing is near to stay put."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.choice(len(rows), n, replace=len(rows) < n)].copy()
    for _ in range(ROUNDS):
        of = _nearest(rows, centres)
        sizes = np.bincount(of, minlength=n)
        sums = np.stack([np.bincount(of, rows[:, d], n) for d in range(rows.shape[1])], axis=1)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def train_model(unit: np.ndarray, cells: int) -> Model:
    """Coarse centroids, scaled to length 1, and one code book for each part of what they leave."""
    width = unit.shape[1]
    coarse = _means(unit, min(cells, len(unit)), 1)
    length = np.linalg.norm(coarse, axis=1, keepdims=True)
    model = Model(coarse / np.where(length > 0, length, 1.0), np.zeros((-(-width // PART), 256, PART)), width)
    rest = model.padded(unit - model.coarse[model.cells_of(unit)])
    model.books = np.stack(
        [_means(rest[:, m * PART : (m + 1) * PART], 256, m + 2) for m in range(len(model.books))]
    )
    return model


def _save_model(spark: SparkSession, model: Model, path: str) -> None:
    rows = [("coarse", i, row.tolist()) for i, row in enumerate(model.coarse)]
    rows += [("books", i, book.ravel().tolist()) for i, book in enumerate(model.books)]
    rows += [("measured", 0, [float(model.width), float(model.probes), float(model.shortlist)])]
    spark.createDataFrame(rows, "kind string, no int, numbers array<double>").coalesce(1).write.parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> Model:
    rows = sorted(spark.read.parquet(f"{path}/model").collect())  # CELLS[1] and a few hundred rows at most
    of = {kind: [r.numbers for r in rows if r.kind == kind] for kind in ("coarse", "books", "measured")}
    width, probes, shortlist = (int(x) for x in of["measured"][0])
    return Model(
        np.array(of["coarse"]), np.array(of["books"]).reshape(len(of["books"]), 256, PART), width, probes, shortlist
    )


def _write_rows(index: DataFrame, key: str, vector: str, model: Model, path: str) -> None:
    """Codes and vectors, partitioned by cell; a cell of very many rows is split into files."""
    sent = index.sparkSession.sparkContext.broadcast(model)

    def encode(batches):
        for batch in batches:
            cells, codes = sent.value.encode(matrix_of(batch["vec"]))
            code = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], code, batch["vec"], pa.array(cells.astype(np.int32))], ["id", "code", "vec", "cell"]
            )

    rows = index.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    rows.mapInArrow(encode, ROWS).hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/rows")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(f"{path}/rows")


def _rank_codes(sent, k: int):
    """Arrow function: for each query the ``k`` best codes of a task among the cells it opens."""

    def rank(batches):
        model, ids, wanted, opens = sent.value
        best = Best(len(ids), k)
        for batch in batches:
            cells, own = batch["cell"].to_numpy(), batch["id"].to_numpy()
            codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(own), -1)
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                asks = np.flatnonzero(opens[:, cell])
                for low in range(0, len(at), SCANNED_AT_ONCE):
                    some = at[low : low + SCANNED_AT_ONCE]
                    matrix = model.decode(cell, codes[some]).T
                    for start in range(0, len(asks), SCORED_AT_ONCE):
                        q = asks[start : start + SCORED_AT_ONCE]
                        best.add(q, wanted[q] @ matrix, own[some])
        yield best.rows(ids)

    return rank


def _best_of(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.col("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _opened(model: Model, unit: np.ndarray, probes: int) -> np.ndarray:
    opens = np.zeros((len(unit), len(model.coarse)), bool)
    np.put_along_axis(opens, model.probed(unit, probes), True, axis=1)
    return opens


def _candidates_few(spark, path: str, model: Model, few, k: int, probes: int) -> DataFrame:
    """Codes are ranked where they lie; only partitions of opened cells are read."""
    ids, unit = few
    opens = _opened(model, unit, probes)
    codes = _read(spark, path).select("id", "code", "cell")
    codes = codes.where(F.col("cell").isin([int(c) for c in np.flatnonzero(opens.any(axis=0))]))
    sent = spark.sparkContext.broadcast((model, ids, unit, opens))
    return _best_of(codes.mapInArrow(_rank_codes(sent, k), CANDIDATES), k)


def _search_many(
    model: Model, queries: DataFrame, vectors: DataFrame, k: int, slice_rows: int, query_rows: int
) -> DataFrame:
    """Blocks of queries meet blocks of the cells' vectors, and a query is compared with those it opens.

    A cell is read for very many queries at once, so its vectors are compared right there: candidates by code would
    have to be exchanged, several for every query and cell."""
    sent = queries.sparkSession.sparkContext.broadcast(model)

    def opened(unit: np.ndarray, known: dict, best: Best, row: dict) -> np.ndarray:
        if "cells" not in known:
            known["cells"] = _opened(sent.value, unit, sent.value.probes)
        return np.flatnonzero(known["cells"][:, row["cell"]])

    asked = queries.select(F.col("query_id").alias("id"), "vec", F.lit(0).alias("cell"), F.lit(0.0).alias("angle"))
    cells = vectors.select("id", "vec", "cell", F.lit(0.0).alias("angle"))
    pairs = paired_blocks(blocks_of(asked, query_rows, "ann-asked"), blocks_of(cells, slice_rows, "ann-cells"))
    return scan_pairs(pairs, (number_type(asked, "vec"), number_type(cells, "vec")), opened, k)


def _reranked(vectors: DataFrame, candidates: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """True cosines of the candidates, from their full vectors."""

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        a, b = (matrix_of(pa.array(x.to_list(), pa.list_(pa.float64()))) for x in (a, b))
        return pd.Series(np.round((a * b).sum(axis=1), DIGITS))

    pairs = stored(candidates.select("query_id", "id"), "ann-candidates")
    full = lookup_join(vectors.select("id", "vec"), pairs, ["id"], "inner")
    scored = lookup_join(full, asked.select("query_id", F.col("vec").alias("_asked")), ["query_id"], "inner")
    return _best_of(scored.select("query_id", "id", cosine("vec", "_asked").alias("score")), k)


def build_ann_index(
    index: DataFrame, key: str, vector: str, path: str, *, k: int = 10, recall: float = 0.9, cells: int | None = None
) -> Model:
    """Write an index of all rows below ``path``, a new folder all executors reach.

    Centroids and code books are trained on about ``TRAIN_ROWS`` vectors by hash of the key; every row is
    coded. Then about ``HELD_QUERIES`` vectors of the index ask for their ``k`` true neighbours but themselves,
    by one scan, and for what the codes say. The least shortlist and number of cells are stored with
    which the mean share of true neighbours found reaches ``recall`` by two standard errors. If no
    shortlist does, searches are exact.

    Keys must be integers that differ. Rows without a vector are left out. An index without rows
    can't be trained and is refused.
    """
    spark = index.sparkSession
    index = index.where(F.col(vector).isNotNull())
    total = index.count()
    if not total:
        raise ValueError("an index needs at least one vector")
    if cells is None:
        cells = min(max(math.isqrt(total), CELLS[0]), CELLS[1])
    train = sampled_vectors(index, key, vector, TRAIN_ROWS, total, 5)
    train = train or [tuple(r) for r in index.select(key, vector).limit(1).collect()]
    model = train_model(matrix_of(pa.array([v for _, v in train], pa.list_(pa.float64()))), cells)
    _write_rows(index, key, vector, model, path)
    held = sampled_vectors(index, key, vector, HELD_QUERIES, total, 11)
    if held:
        few = (
            np.array([i for i, _ in held], np.int64),
            matrix_of(pa.array([v for _, v in held], pa.list_(pa.float64()))),
        )
        model.probes, model.shortlist = _measured(spark, path, index, key, vector, model, few, k, recall)
    _save_model(spark, model, path)
    return model


def _measured(spark, path, index, key, vector, model, few, k, recall) -> tuple[int, int]:
    every = len(model.coarse)
    ids, unit = few
    longest = min(SHORTLISTS[-1] * k, 1_024)
    # Each asks for one more, itself.
    true = scan_top_k(few, index, key, vector, k + 1).where("query_id <> id")
    true = true.withColumn("_n", F.row_number().over(W.partitionBy("query_id").orderBy("rank"))).where(f"_n <= {k}")
    true = true.select("query_id", "id").toPandas()
    if true.empty:
        return every, SHORTLISTS[0]
    near = _candidates_few(spark, path, model, few, longest + 1, every).where("query_id <> id")
    codes = _read(spark, path).select("id", "cell")
    near = lookup_join(codes, stored(near.select("query_id", "id", "rank"), "ann-held"), ["id"], "inner").toPandas()
    place = np.empty((len(ids), every), np.int64)
    np.put_along_axis(place, model.probed(unit, every), np.arange(every)[None, :], axis=1)
    near["place"] = place[np.searchsorted(ids, near["query_id"]), near["cell"]]
    near = near.sort_values(["query_id", "rank"], ignore_index=True)
    near = near.merge(true.assign(true=1), how="left", on=["query_id", "id"])
    wanted = true.groupby("query_id").size()

    def reached(probes: int, shortlist: int) -> bool:
        rows = near[near["place"] < probes]
        found = rows[rows.groupby("query_id").cumcount() < shortlist * k].groupby("query_id")["true"].count()
        shares = (found.reindex(wanted.index, fill_value=0) / wanted).clip(upper=1.0)
        return shares.mean() - Z * shares.std(ddof=0) / math.sqrt(len(shares)) >= recall

    for shortlist in SHORTLISTS:
        if shortlist * k <= longest and reached(every, shortlist):
            # The least number of cells by halving: more cells seldom find less.
            low, high = 1, every
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if reached(middle, shortlist) else (middle + 1, high)
            return low, shortlist
    return every, 0


def ann_search(
    queries: DataFrame,
    query_key: str,
    query_vector: str,
    path: str,
    k: int,
    *,
    few: int = FEW_QUERIES,
    slice_rows: int = SLICE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, id, score, rank)``: about the ``k`` nearest rows of a stored index for every query.

    Scores are true cosines. Up to ``few`` queries are sent to the codes of the opened cells, which stay in their
    tasks, and then only the vectors of the candidates are read. More queries are compared with all vectors of the
    cells that they open, as pairs of stored blocks. Rows without a vector don't ask.
    """
    spark = queries.sparkSession
    model = load_model(spark, path)
    asked = queries.where(F.col(query_vector).isNotNull()).select(
        F.col(query_key).cast("long").alias("query_id"), F.col(query_vector).cast("array<double>").alias("vec")
    )
    vectors = _read(spark, path)
    sent = few_queries(asked, "query_id", "vec", few) if few else None
    if sent is not None and not len(sent[0]):
        return spark.createDataFrame([], CANDIDATES + ", rank int")
    if not model.shortlist:
        return knn_join(asked, "query_id", "vec", vectors, "id", "vec", k, few=few)
    if sent is None:
        return _search_many(model, asked, vectors, k, slice_rows, query_rows)
    opens = _opened(model, sent[1], model.probes)
    vectors = vectors.where(F.col("cell").isin([int(c) for c in np.flatnonzero(opens.any(axis=0))]))
    found = _candidates_few(spark, path, model, sent, model.shortlist * k, model.probes)
    return _reranked(vectors, found, asked, k)
