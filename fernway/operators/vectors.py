"""Embedding text and finding nearest vectors by cosine.

A few queries go to the index: every task scans its rows where they lie and returns the k best
for each query. For joins of many queries to an index both are stored as packed blocks of bounded size, and
tasks read pairs of blocks, so no vector is exchanged for another block's sake. Index vectors are put
into cells around pivot vectors; a query is compared only with
blocks that can still hold one of its k nearest, and a task returns at most k
rows per query. The bounds are those of pivot-based nearest-neighbour joins for
MapReduce (Lu, Shen, Chen, Ooi: PVLDB 5(10), 2012), with angles as the metric.
``ann`` has the approximate search of a stored index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.joins import fits_broadcast
from ..functions.text import bind, terms
from ..session import stored

DIGITS = 6
SLICE_ROWS = 20_000
QUERY_ROWS = 4_096
SCORED_AT_ONCE = 256
# Queries up to this many, and up to this many bytes, are sent to the index rows.
FEW_QUERIES = 4_096
FEW_BYTES = 32 << 20
SCANNED_AT_ONCE = 8_192
# Queries whose best rows a task holds at a time.
HELD_ROWS = 1 << 18
# Pivots are the root of the number of index rows, within these bounds.
PIVOTS = (64, 1 << 16)
# Distinct ids of passages up to this many are sent to the passages.
ASKED_IDS = 1 << 20
# Slack on bounds between float64 angles, far above their rounding error.
EPSILON = 1e-6


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where one is all zeros."""
    scale = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(scale > 0, dot(a, b) / scale).otherwise(0.0)


def vector_top_k(
    index: DataFrame,
    key: str,
    vector: str,
    query: list[float],
    k: int,
    columns: list[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` rows nearest to one query vector, with score and rank.

    ``where`` filters on metadata before anything is scored. The query is a constant of
    the plan; each task keeps k rows and only those are merged. Rows without a vector are not found.
    """
    rows = (index if where is None else index.where(where)).where(F.col(vector).isNotNull())
    target = F.array(*[F.lit(float(x)) for x in query])
    scored = rows.select(
        key, *columns, F.round(cosine(F.col(vector), target), DIGITS).alias("score")
    )
    best = scored.orderBy(F.desc("score"), key).limit(k)
    # At most k rows are left here, so ranking them in one task is bounded.
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("score"), F.col(key))))


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.vstack(vectors.to_numpy()).astype(np.float64)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length > 0, length, 1.0)


def sampled_vectors(index: DataFrame, key: str, vector: str, n: int, total: int, salt: int) -> list:
    """About ``n`` of ``total`` rows by hash of the key, collected as ``(key, vector)``."""
    grain = 1 << 40
    part = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(grain))
    rows = index.where(part < math.ceil(grain * min(1.0, n / max(total, 1)))).select(key, vector)
    return sorted(tuple(r) for r in rows.limit(2 * n).collect())


def choose_pivots(index: DataFrame, key: str, vector: str, n: int, total: int) -> np.ndarray:
    """About ``n`` index vectors picked by hash of the key, collected; at least one."""
    rows = sampled_vectors(index, key, vector, n, total, 3) or [
        tuple(r) for r in index.select(key, vector).limit(1).collect()
    ]
    return _unit(pd.Series([np.asarray(v, np.float64) for _, v in rows]))


def _angles(vectors: pd.Series, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ pivots.T, -1.0, 1.0))


def assign_cells(index: DataFrame, key: str, vector: str, pivots: np.ndarray) -> DataFrame:
    """``(id, vec, cell, angle)``: nearest pivot of every vector; no shuffle."""

    @F.pandas_udf("struct<cell:int,angle:double>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            angles = _angles(batch, pivots)
            cell = angles.argmin(axis=1)
            yield pd.DataFrame(
                {"cell": cell.astype("int32"), "angle": angles[np.arange(len(cell)), cell]}
            )

    # Marked so that a pushed-down filter on the cell does not run the function again.
    nearest = nearest.asNondeterministic()
    return index.select(
        F.col(key).alias("id"), F.col(vector).alias("vec"), nearest(F.col(vector)).alias("c")
    ).select("id", "vec", "c.cell", "c.angle")


SCHEMA = "query_id long, id long, score double"
BLOCK = "cell int, near double, far double, ids binary, vectors binary"


def number_type(rows: DataFrame, vector: str):
    return np.float32 if rows.schema[vector].dataType.elementType == T.FloatType() else np.float64


def blocks_of(rows: DataFrame, most: int, name: str) -> DataFrame:
    """``(id, vec, cell, angle)`` packed, up to ``most`` neighbouring rows of one cell to a row, and stored.
    Angles may be null."""
    number = number_type(rows, "vec")

    def pack(batches):
        def packed(cell, parts):
            ids, vectors, angles = (np.concatenate(x) for x in zip(*parts))
            row = cell, angles.min(), angles.max(), ids.tobytes(), vectors.tobytes()
            return pa.RecordBatch.from_pylist([dict(zip(fields.names, row))], fields)

        fields = pa.schema(
            [("cell", pa.int32()), ("near", pa.float64()), ("far", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())]
        )
        held, n, of = [], 0, None
        for batch in batches:
            cells, ids = batch["cell"].to_numpy(), batch["id"].to_numpy()
            angles = batch["angle"].to_numpy(zero_copy_only=False)
            vectors = batch["vec"].flatten().to_numpy(zero_copy_only=False).astype(number).reshape(len(ids), -1)
            ends = [*(np.flatnonzero(cells[1:] != cells[:-1]) + 1), len(ids)]
            low = 0
            for end in ends:
                while low < end:
                    if held and (cells[low] != of or n >= most):
                        yield packed(of, held)
                        held, n = [], 0
                    of, high = int(cells[low]), min(end, low + most - n)
                    held.append((ids[low:high], vectors[low:high], angles[low:high]))
                    n, low = n + high - low, high
        if held:
            yield packed(of, held)

    return stored(rows.select("id", "vec", "cell", "angle").mapInArrow(pack, BLOCK), name)


def paired_blocks(asked: DataFrame, index: DataFrame) -> DataFrame:
    """Every block of queries beside every block of the index.

    Both are stored tables, which tasks read again and again, and nothing is exchanged. As far as all
    cores stay busy, a task takes all index blocks for its query blocks, so that few tasks return rows
    for one query.
    """
    context = asked.sparkSession.sparkContext
    left = asked.select(F.xxhash64("ids", "vectors").alias("block"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "vectors")])
    pairs = left.crossJoin(index.hint("shuffle_replicate_nl"))
    n, all_pairs = (d.rdd.getNumPartitions() for d in (asked, pairs))
    wanted = max(n, 4 * context.defaultParallelism)
    # Pairs of one part of the queries follow each other.
    return pairs.coalesce(wanted) if wanted < all_pairs else pairs


def scan_pairs(pairs: DataFrame, number, asks, k: int) -> DataFrame:
    """The ``k`` best of each task for its queries. ``asks(unit, known, best, row)`` gives the places of the queries
    that have to see an index block; ``known`` is a dict that it may keep things in for the query block."""

    def unit_of(buffer: bytes, n: int, kind) -> np.ndarray:
        matrix = np.frombuffer(buffer, kind).reshape(n, -1).astype(np.float64)
        length = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(length > 0, length, 1.0)

    def scan(batches):
        held, rows = {}, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in held:
                    ids = np.frombuffer(row["q_ids"], np.int64)
                    if rows + len(ids) > HELD_ROWS and held:
                        yield from (best.rows(ids) for ids, _, _, best in held.values())
                        held, rows = {}, 0
                    rows += len(ids)
                    held[row["block"]] = ids, unit_of(row["q_vectors"], len(ids), number[0]), {}, Best(len(ids), k)
                _, unit, known, best = held[row["block"]]
                some = asks(unit, known, best, row)
                if not len(some):
                    continue
                own = np.frombuffer(row["ids"], np.int64)
                matrix = unit_of(row["vectors"], len(own), number[1]).T
                for start in range(0, len(some), SCORED_AT_ONCE):
                    q = some[start : start + SCORED_AT_ONCE]
                    scores = unit[q] @ matrix
                    # Only rows that can hold a better one are rounded and sorted.
                    live = scores.max(axis=1) >= best.score[q, -1] - 10.0**-DIGITS
                    best.add(q[live], np.round(scores[live], DIGITS), own)
        yield from (best.rows(ids) for ids, _, _, best in held.values())

    return _ranked(pairs.mapInArrow(scan, SCHEMA), k)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.col("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Best:
    """The ``k`` best ids of each of ``n`` queries so far: greatest score, then least id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in the scores of some queries (rows) for some ids (columns)."""
        least = self.score[queries, -1]
        if len(ids) > self.k and np.isneginf(least).any():
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, column = np.nonzero(scores >= least[:, None])
        # Of copies, those with greater ids than a full list's last can't enter.
        enters = scores[row, column] > self.score[queries[row], -1]
        enters |= ids[column] < self.id[queries[row], -1]
        row, column = row[enters], column[enters]
        live = np.unique(row)
        if not len(live):
            return
        at = queries[live]
        q = np.concatenate([np.repeat(live, self.k), row])
        s = np.concatenate([self.score[at].ravel(), scores[row, column]])
        i = np.concatenate([self.id[at].ravel(), ids[column]])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        # Every live query has at least k entries; the first k of each stay.
        first = np.searchsorted(q, live)
        take = first[:, None] + np.arange(self.k)
        self.score[at], self.id[at] = s[take], i[take]

    def rows(self, query_ids: np.ndarray) -> pa.RecordBatch:
        row, column = np.nonzero(~np.isneginf(self.score))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (query_ids[row], self.id[row, column], self.score[row, column])],
            ["query_id", "id", "score"],
        )


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """Rows of an Arrow array of equally long lists, scaled to length 1."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(vectors), -1)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length > 0, length, 1.0)


def few_queries(queries: DataFrame, key: str, vector: str, most: int):
    """``(ids, unit vectors)`` of the queries, sorted by id, or None if they are more than ``most``."""
    rows = queries.select(F.col(key).cast("long"), vector).limit(most + 1).collect()
    if len(rows) > most or sum(len(r[1]) for r in rows) * 8 > FEW_BYTES:
        return None
    rows = sorted(rows, key=lambda r: r[0])
    ids = np.array([r[0] for r in rows], np.int64)
    return ids, _unit(pd.Series([np.asarray(r[1], np.float64) for r in rows])) if rows else np.zeros((0, 1))


def _scan_rows(sent, k: int):
    """Arrow function: the ``k`` best index rows of a task for every query."""

    def scan(batches):
        ids, wanted = sent.value
        best, every = Best(len(ids), k), np.arange(len(ids))
        for batch in batches:
            for low in range(0, batch.num_rows, SCANNED_AT_ONCE):
                part = batch.slice(low, SCANNED_AT_ONCE)
                matrix, own = matrix_of(part["vec"]).T, part["id"].to_numpy()
                for start in range(0, len(ids), SCORED_AT_ONCE):
                    some = every[start : start + SCORED_AT_ONCE]
                    best.add(some, np.round(wanted[some] @ matrix, DIGITS), own)
        yield best.rows(ids)

    return scan


def scan_top_k(few, index: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``knn_join`` for queries that ``few_queries`` returned: index rows stay in their tasks, and at
    most ``k`` rows a query and task are exchanged."""
    spark = index.sparkSession
    ids, _ = few
    if not len(ids):
        return spark.createDataFrame([], SCHEMA + ", rank int")
    sent = spark.sparkContext.broadcast(few)
    rows = index.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"))
    return _ranked(rows.mapInArrow(_scan_rows(sent, k), SCHEMA), k)


def knn_join(
    queries: DataFrame,
    query_key: str,
    query_vector: str,
    index: DataFrame,
    key: str,
    vector: str,
    k: int,
    *,
    pivots: int | None = None,
    slice_rows: int = SLICE_ROWS,
    query_rows: int = QUERY_ROWS,
    few: int = FEW_QUERIES,
) -> DataFrame:
    """``(query_id, id, score, rank)``: the ``k`` nearest index rows of every query, exactly.

    Up to ``few`` queries are sent to the index, which is scanned in place. More of them, and the rows of each
    cell of the index, are packed into stored blocks; every pair of blocks is looked at, and a query leaves out
    the index blocks that the triangle inequality rules out by its k best so far. What is
    exchanged and written grows with the rows, not with the pairs. There
    are as many ``pivots`` as the root of the number of index rows, unless given.

    Keys must be integers; query keys must differ. Rows without a vector neither ask nor are found. A
    zero vector counts as being at a right angle to every other, which keeps all bounds valid.
    """
    spark = index.sparkSession
    queries, index = (d.where(F.col(v).isNotNull()) for d, v in ((queries, query_vector), (index, vector)))
    asked_few = few_queries(queries, query_key, query_vector, few) if few else None
    if asked_few is not None:
        return scan_top_k(asked_few, index, key, vector, k)
    total = index.count()
    if not total:
        return spark.createDataFrame([], SCHEMA + ", rank int")
    if pivots is None:
        pivots = min(max(math.isqrt(total), PIVOTS[0]), PIVOTS[1])
    centres = choose_pivots(index, key, vector, pivots, total)
    cells = assign_cells(index.withColumn(key, F.col(key).cast("long")), key, vector, centres)
    cells = cells.hint("rebalance", "cell").sortWithinPartitions("cell", "id")
    asked = queries.select(
        F.col(query_key).cast("long").alias("id"),
        F.col(query_vector).alias("vec"),
        F.lit(0).alias("cell"),
        F.lit(0.0).alias("angle"),
    )
    sent = spark.sparkContext.broadcast(centres)

    def asks(unit: np.ndarray, known: dict, best: Best, row: dict) -> np.ndarray:
        angle = np.arccos(np.clip(unit @ sent.value[row["cell"]], -1.0, 1.0))
        # Scores are rounded, so the k-th may lie half a last digit further away.
        reach = np.arccos(np.clip(best.score[:, -1] - 0.5 * 10.0**-DIGITS, -1.0, 1.0)) + EPSILON
        return np.flatnonzero((angle - row["far"] <= reach) & (row["near"] - angle <= reach))

    pairs = paired_blocks(blocks_of(asked, query_rows, "knn-asked"), blocks_of(cells, slice_rows, "knn-index"))
    return scan_pairs(pairs, (number_type(asked, "vec"), number_type(cells, "vec")), asks, k)


def retrieve_context(
    neighbours: DataFrame, passages: DataFrame, key: str, text: str, separator: str = "\n\n"
) -> DataFrame:
    """Passages of each query's neighbours, best first, as one context column.

    A query has at most k neighbours, so its list is bounded by k. Neighbours are stored, as the distinct ids
    among them say which passages are asked for: where those ids fit (``ASKED_IDS``) they are sent to the passages,
    and no other text is exchanged.
    """
    found = stored(neighbours.select("query_id", "id", "rank"), "context-found")
    rows = passages.select(F.col(key).alias("id"), F.col(text).alias("_text"))
    asked = found.select("id").distinct()
    if fits_broadcast(asked, ASKED_IDS):
        rows = rows.join(F.broadcast(asked), "id", "left_semi")
    found = found.join(rows, "id")
    return found.groupBy("query_id").agg(
        F.count("*").alias("n_passages"),
        F.array_sort(F.collect_list(F.struct("rank", "_text"))).alias("_p"),
    ).select(
        "query_id",
        "n_passages",
        F.array_join(F.transform("_p", lambda p: p["_text"]), separator).alias("context"),
    )


@dataclass(frozen=True)
class Embedder:
    """Inverse document frequency of each slot that words are hashed to."""

    idf: tuple[float, ...]


def _signed_slots(text: Column, width: int) -> Column:
    """Twice the slot of each word, plus 1 where the word counts negatively; from its MD5."""
    digests = F.transform(F.coalesce(terms(text), F.array().cast("array<string>")), F.md5)

    def code(h: Column) -> Column:
        slot = F.conv(F.left(h, F.lit(7)), 16, 10).cast("int") % width
        return slot * 2 + (F.substring(h, 8, 1) >= "8").cast("int")

    return F.transform(digests, code)


def _slot_sums(codes: Column, width: int) -> Column:
    """Signed numbers of words by slot, as an array of ``width``.

    Every code is added once and all are sorted; then the code ``c`` ends the run number ``c``, and
    the lengths of the runs, less one, are the counts."""
    every = F.sequence(F.lit(0), F.lit(2 * width - 1))

    def ends(ordered: Column) -> Column:
        size = F.size(ordered)
        return F.filter(
            F.sequence(F.lit(1), size),
            lambda i: (i == size) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

    def lengths(end: Column) -> Column:
        return F.transform(end, lambda at, i: at - F.coalesce(F.get(end, i - 1), F.lit(0)))

    def signed(count: Column) -> Column:
        slots = F.sequence(F.lit(0), F.lit(width - 1))
        return F.transform(slots, lambda slot: F.get(count, slot * 2) - F.get(count, slot * 2 + 1))

    return bind(bind(bind(F.sort_array(F.concat(codes, every)), ends), lengths), signed)


def fit_embedder(docs: DataFrame, text: str, width: int = 256) -> Embedder:
    """Count the documents that have a word in each slot; ``width`` numbers reach the driver."""
    slots = F.array_distinct(F.transform(_signed_slots(F.col(text), width), lambda c: F.shiftright(c, 1)))
    # For an inner explode Spark adds a filter that computes the array once more.
    held = dict(docs.select(F.explode_outer(slots).alias("slot")).groupBy("slot").count().collect())
    total = docs.count()
    return Embedder(tuple(math.log((total + 1) / (held.get(i, 0) + 1)) for i in range(width)))


def embed_text(model: Embedder, docs: DataFrame, text: str = "text", output: str = "embedding") -> DataFrame:
    """Add the embedding as ``array<float>``: signed hashed words, weighted by inverse document
    frequency and scaled to length 1. All in expressions of one row; texts without a word give zeros."""
    idf, width = F.array(*[F.lit(x) for x in model.idf]), len(model.idf)
    sums = _slot_sums(_signed_slots(F.col(text), width), width)
    weighted = F.zip_with(sums, idf, lambda c, w: c * w)

    def scaled(x: Column) -> Column:
        squares = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
        return bind(squares, lambda n: F.transform(x, lambda v: F.when(n > 0, v / F.sqrt(n)).otherwise(0.0).cast("float")))

    return docs.withColumn(output, bind(weighted, scaled))
