"""Exact top-k inner products: tiled matrix products and tree merging of top lists.

Components are turned into integers, floor(scale * x). Vectors and queries are packed, where
they are read, into rows of one matrix each: tiles of the vectors, blocks of the queries.
Consecutive tiles of a task are a lane. Every block meets every lane by a join on (block,
lane), which holds one block and a bounded number of tiles; there a block is multiplied with
one tile at a time, the best k of each tile are selected and merged into running lists. The
lists of the lanes are merged in rounds of ``FAN`` lanes, until one list is left. Lists hold one
row more than asked for, since a query meets its own row too: at the end one row of its id and of
its product with itself is taken out. Nothing but counts passes through the driver, and the vectors are read
once, however many queries there are.

Ranking is by (score, smaller vec_id). A tile's products are exact: they are done in
double precision when all sums stay below 2**53, and in Python integers otherwise.

Defined cases: vectors that are null, empty or hold null or non-finite components take
no part; only vectors of equal length are compared; a null vec_id is neither query nor
candidate; a query's own row alone is no candidate, so rows that repeat its vec_id are; every
query row has a list of its own, also where rows or ids repeat (a query that is no row of the
vectors takes the first row of its id and product as its own); fewer candidates than k give all of them; very long vectors make tiles of fewer
rows; an empty table gives no rows; other columns are ignored. Scores beyond 64 bits fail.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import stored, table

K = 5
SCALE = 256
EVERY = 50  # queries are the rows whose vec_id this divides
BLOCK_BYTES = 4 << 20  # of a packed matrix: a query block, a tile
TILE = 2048  # candidates multiplied at once
LANE = 8  # tiles of a lane: a join key holds LANE + 1 matrices
FAN = 16  # lists merged at once
_EXACT = 2.0**53


def _vectors(batch: pa.RecordBatch, scale: int):
    """(ids, integer matrix as doubles) per vector length, of the vectors that take part."""
    ids, lists = batch.column(0), batch.column(1)
    # List arrays may be slices: flatten() gives the values of the rows at hand only.
    values = lists.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64) if len(values) else np.zeros(0)
    sizes = np.array(lists.value_lengths().fill_null(0), dtype=np.int64)
    ends = np.cumsum(sizes)
    good = np.isfinite(np.r_[0.0, flat])[1:]
    known = np.r_[0, np.cumsum(good)]
    whole = (known[ends] - known[ends - sizes] == sizes) & (sizes > 0) & np.array(ids.is_valid())
    number = np.array(ids.fill_null(0), dtype=np.int64)
    for size in np.unique(sizes[whole]):
        rows = np.flatnonzero(whole & (sizes == size))
        matrix = flat[(ends[rows] - size)[:, None] + np.arange(size)]
        yield number[rows], np.floor(matrix * scale)


def _squares(a: np.ndarray) -> np.ndarray:
    """Exact product of every row with itself."""
    if np.abs(a).max(initial=0) ** 2 * a.shape[1] < _EXACT:
        return (a * a).sum(axis=1).astype(np.int64)
    return np.array([sum(int(x) ** 2 for x in row) for row in a], dtype=np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of integers held as doubles, as 64-bit integers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
    return np.dot(whole(a), whole(b).T).astype(np.int64)


class _Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.zeros((queries, 0), np.int64)
        self.vec = np.zeros((queries, 0), np.int64)

    def add(self, score: np.ndarray, vec: np.ndarray) -> None:
        """Merge a list per query."""
        score, vec = np.hstack([self.score, score]), np.hstack([self.vec, vec])
        order = np.lexsort((vec, -score), axis=1)[:, : self.k]
        self.score, self.vec = np.take_along_axis(score, order, axis=1), np.take_along_axis(vec, order, axis=1)


def _tile_best(score: np.ndarray, vec: np.ndarray, k: int):
    """The k best columns of a tile for every query (partial selection, ties to the left).

    vec is ascending, so among the scores at the k-th value the first columns win.
    """
    if score.shape[1] > k:
        edge = np.partition(score, score.shape[1] - k, axis=1)[:, -k][:, None]
        above, level = score > edge, score == edge
        room = k - above.sum(axis=1, keepdims=True)
        take = above | (level & (np.cumsum(level, axis=1) <= room))
        cols = np.nonzero(take)[1].reshape(len(score), k)
        return np.take_along_axis(score, cols, axis=1), vec[cols]
    return score, np.broadcast_to(vec, score.shape)


_PACKED = "number long, size int, ids binary, matrix binary"


def _pack(scale: int):
    """Task: its vectors as matrices of one length and ``BLOCK_BYTES`` at most, numbered from 0."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        number = 0

        def packed(size: int):
            nonlocal number
            ids, rows = (np.concatenate(x) for x in zip(*held.pop(size)))
            step = max(1, BLOCK_BYTES // (8 * size))
            for at in range(0, len(ids), step):
                yield pa.RecordBatch.from_pylist(
                    [{"number": number, "size": size, "ids": ids[at : at + step].tobytes(), "matrix": rows[at : at + step].tobytes()}],
                    pa.schema([("number", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())]),
                )
                number += 1

        for batch in batches:
            for ids, rows in _vectors(batch, scale):
                size = rows.shape[1]
                held.setdefault(size, []).append((ids, rows))
                if sum(len(i) for i, _ in held[size]) * size * 8 >= BLOCK_BYTES:
                    yield from packed(size)
        for size in list(held):
            yield from packed(size)

    return pack


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["matrix"], np.float64).reshape(-1, row["size"])


def _meet(k: int):
    """Task: the k best rows of a lane for every query of a block (its own row among them)."""

    def meet(block: pa.Table, lane: pa.Table) -> pa.Table:
        out = []
        for given in block.to_pylist():
            own, wanted = _matrix(given)
            best = [_Best(len(own[at : at + TILE]), k) for at in range(0, len(own), TILE)]
            for row in range(lane.num_rows):
                tile = lane.slice(row, 1).to_pylist()[0]
                if tile["size"] != given["size"]:
                    continue
                vec, matrix = _matrix(tile)
                order = np.argsort(vec, kind="stable")
                for at in range(0, len(order), TILE):
                    some = order[at : at + TILE]
                    for n, rows in enumerate(best):
                        part = slice(n * TILE, n * TILE + TILE)
                        score = _products(wanted[part], matrix[some])
                        rows.add(*_tile_best(score, vec[some], k))
            number = lane.column("lane")[0].as_py() if lane.num_rows else 0
            # A query is its block and its row there.
            query = (given["block"] << 32) + np.arange(len(own))
            square = _squares(wanted)
            for n, rows in enumerate(best):
                part = slice(n * TILE, n * TILE + TILE)
                of = [np.repeat(x[part], rows.score.shape[1]) for x in (query, own, square)]
                out.append((*of, rows.vec.ravel(), rows.score.ravel(), np.full(rows.vec.size, number)))
        none = np.zeros(0, np.int64)
        columns = [np.concatenate([none, *(x[c] for x in out)]).astype(np.int64) for c in range(6)]
        return pa.table(dict(zip(("query", "query_id", "own", "vec_id", "score", "lane"), columns)))

    return meet


def query_vectors(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    """The rows that are queries."""
    return vectors.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding")


def _best_rows(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy("query", *keys).orderBy(F.col("score").desc(), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _without_own(lists: DataFrame, k: int) -> DataFrame:
    """Ranked lists of k + 1 rows without the query's own row, the first of its id and product."""
    order = Window.partitionBy("query").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    met = lists.withColumns({"_hit": hit, "_hits": F.count_if(hit).over(order)}).filter("NOT (_hit AND _hits = 1)")
    return met.withColumn("rank", F.col("rank") - (F.col("_hits") > 0).cast("int")).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows of ``vectors`` for each query."""
    numbers = lambda df: df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    packed = lambda df: numbers(df).mapInArrow(_pack(scale), _PACKED).withColumn("part", F.spark_partition_id())
    tiles = stored(packed(vectors).withColumn("cut", F.expr(f"number div {LANE}")), "topk-tiles")
    # One row per lane and per block: small tables, numbered in one window each.
    lanes = tiles.select("part", "cut").distinct()
    lanes = lanes.withColumn("lane", F.row_number().over(Window.orderBy("part", "cut")).cast("long") - 1)
    tiles = tiles.join(F.broadcast(lanes) if lanes.count() <= _FEW else lanes, ["part", "cut"])
    blocks = stored(packed(queries), "topk-blocks")
    named = blocks.select("part", "number").withColumn(
        "block", F.row_number().over(Window.orderBy("part", "number")).cast("long") - 1
    )
    n_lanes, n_blocks = lanes.count(), named.count()
    each = lambda name, n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    if not n_lanes or not n_blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    left = blocks.join(named, ["part", "number"]).select("block", "size", "ids", "matrix", each("lane", n_lanes))
    right = tiles.select("lane", "size", "ids", "matrix", each("block", n_blocks))
    lists = left.groupBy("block", "lane").cogroup(right.groupBy("block", "lane")).applyInArrow(
        _meet(k + 1), "query long, query_id long, own long, vec_id long, score long, lane long"
    )
    while n_lanes > FAN:
        n_lanes = -(-n_lanes // FAN)
        lists = _best_rows(lists.withColumn("lane", F.expr(f"lane div {FAN}")), k + 1, "lane").drop("rank")
    return _without_own(_best_rows(lists, k + 1), k).select("query_id", "rank", "vec_id", "score")


_FEW = 100_000  # lanes whose numbers are handed to all tasks


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 50th vector's five best partners by integer inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, query_vectors(vectors))


ORACLE_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
pairs AS (
  SELECT q.rid, q.vec_id AS query_id, v.vec_id,
         list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM q JOIN v ON v.rid <> q.rid AND len(v.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
