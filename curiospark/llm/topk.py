"""Exact top-k search by distributed histogram selection.

Vectors are scaled to integers, so scores are exact. For a block of queries, every row is scored, and
each task returns histograms of the scores: how many rows fall into each bin. Their sums say in which bin a
query's kth highest score lies; the bin is refined until one value is left. A last pass keeps the scores
above that value and, of those equal to it, the smallest ids, which settles ties.

A task leaves out the bins below the one in which its own k highest scores end: the kth score of all rows
is at least that of any part of them, so those bins can't matter. Queries come in blocks of ``block``
vectors, which bounds the broadcast and a task's score matrix whatever the number of queries.

Vectors are scaled once, to packed integers of four or eight bytes in a table that all passes read.

Defined cases: vectors that are null, hold a null or a non-finite component, or differ in length from the
query take no part; null ids take no part; queries and candidates are rows: rows that repeat an id are queries of their own, each
with the others as candidates, and ties of equal ids go by an arbitrary but fixed order; fewer than k candidates give all of
them; scaled components beyond 2**61 count as 2**61, and so do scores, both with their sign; empty tables give an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import bounded_batches, keep, table

K, SCALE, BINS, BLOCK, ROWS = 5, 256, 512, 4096, 2048
EXACT, LIMIT = 1 << 53, 1 << 61


def integers(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """row (a number of its own), vec_id, n, top (the largest size of a component) and v, n packed integers, of the vectors that take part: a kept table."""
    bounded_batches(df.sparkSession)
    cast = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            bounds, values = np.asarray(lists.offsets), lists.values
            flat = np.asarray(values.fill_null(np.nan))
            with np.errstate(over="ignore"):
                scaled = np.floor(flat * scale)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            whole = np.clip(scaled, -float(LIMIT), float(LIMIT))
            whole[~np.isfinite(flat)] = 0
            rows = np.flatnonzero(bad[bounds[1:]] == bad[bounds[:-1]])
            tops = [float(np.abs(whole[a:b]).max(initial=0)) for a, b in zip(bounds[rows].tolist(), bounds[rows + 1].tolist())]
            packed = [whole[a:b].astype("<i4" if top < 1 << 31 else "<i8").tobytes() for a, b, top in zip(bounds[rows].tolist(), bounds[rows + 1].tolist(), tops)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(np.diff(bounds)[rows].astype(np.int32)), pa.array(tops, pa.float64()), pa.array(packed, pa.binary())], ["vec_id", "n", "top", "v"])

    packed = cast.mapInArrow(run, "vec_id long, n int, top double, v binary")
    return keep(packed.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")


def matrix(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, rows, ids, vectors) of a batch, at most ROWS at a time, apart by the vectors' lengths."""
    rows, ids, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "n"))
    packed = batch.column("v").to_pylist()
    width = np.array([len(v) for v in packed], np.int64) // np.maximum(sizes, 1)
    for n, wide in {*zip(sizes.tolist(), width.tolist())}:
        chosen = np.flatnonzero((sizes == n) & (width == wide))
        for at in range(0, len(chosen), ROWS):
            own = chosen[at : at + ROWS]
            yield n, rows[own], ids[own], np.frombuffer(b"".join([packed[k] for k in own.tolist()]), "<i8" if wide == 8 else "<i4").reshape(len(own), n)


class Block:
    """Queries of one length; scores as int64, exact but for the limit."""

    def __init__(self, rows: list[int], ids: list[int], vectors: list[np.ndarray]):
        self.rows, self.ids, self.q = np.array(rows, np.int64), np.array(ids, np.int64), np.array(vectors, np.int64).reshape(len(ids), -1)
        self.largest = int(np.abs(self.q).max(initial=0))
        self.doubles = self.q.astype(np.float64)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        bound = self.largest * int(np.abs(rows.astype(np.int64)).max(initial=0)) * max(1, self.q.shape[1])
        if bound < EXACT:
            return (self.doubles @ rows.T.astype(np.float64)).astype(np.int64)
        if bound < LIMIT:
            return self.q @ rows.T.astype(np.int64)
        return np.clip(self.q.astype(object) @ rows.T.astype(object), -LIMIT, LIMIT).astype(np.int64)


def scored(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(candidate rows and ids, scores by query and candidate, whether a candidate isn't the query itself)."""
    for batch in batches:
        for n, rows, ids, vectors in matrix(batch):
            if n == block.q.shape[1]:
                yield rows, ids, block.scores(vectors), block.rows[:, None] != rows[None, :]


def histograms(rows: DataFrame, shared, low: np.ndarray, span: int, width: int, above: np.ndarray, k: int) -> DataFrame:
    """Counts by query and bin of the scores in [low, low + span), in bins of ``width``; q, bin, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = shared.value, np.zeros((len(low), BINS), np.int64)
        base = np.arange(len(low))[:, None] * BINS
        for _, _, scores, other in scored(block, batches):
            past = scores - low[:, None]
            at, ok = past // width, other & (past >= 0) & (past < span)
            counts += np.bincount((at + base)[ok], minlength=counts.size).reshape(counts.shape)
        over = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts  # rows in higher bins
        keep_bin = (counts > 0) & (over < (k - above)[:, None])
        q, at = np.nonzero(keep_bin)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(at, pa.int32()), pa.array(counts[q, at], pa.int64())], ["q", "bin", "n"])

    return rows.mapInArrow(run, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def kth_scores(rows: DataFrame, shared, k: int) -> np.ndarray:
    """Each query's kth highest score; the least possible one where it has fewer candidates."""
    block = shared.value
    limit = int(rows.agg(F.max("top")).head()[0] or 0)
    reach = min(limit * block.largest * max(1, block.q.shape[1]), LIMIT) + 1
    n = len(block.ids)
    low, above = np.full(n, -reach, np.int64), np.zeros(n, np.int64)
    width = max(1, -(-(2 * reach + 1) // BINS))
    few, span = np.zeros(n, bool), width * BINS
    while True:
        found = histograms(rows, shared, low, span, width, above, k).toArrow()  # at most BINS rows a query, few in fact
        counts = np.zeros((n, BINS), np.int64)
        counts[found["q"].to_numpy(), found["bin"].to_numpy()] = found["n"].to_numpy()
        from_top = above[:, None] + np.cumsum(counts[:, ::-1], axis=1)
        reached = from_top >= k
        few |= ~reached.any(axis=1)
        first = np.where(reached.any(axis=1), reached.argmax(axis=1), BINS - 1)
        above = np.where(first > 0, from_top[np.arange(n), np.maximum(first - 1, 0)], above)
        low = low + (BINS - 1 - first) * width
        if width == 1:
            return np.where(few, np.iinfo(np.int64).min, low)
        span, width = width, -(-width // BINS)


def best(rows: DataFrame, shared, kth: np.ndarray, k: int) -> DataFrame:
    """query, query_id, vec_id, row, score: of each task, what beats the kth score and the k smallest ids that equal it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = shared.value, [np.empty((4, 0), np.int64)]
        for rows, ids, scores, other in scored(block, batches):
            q, c = np.nonzero(other & (scores >= kth[:, None]))
            held.append(np.stack([q, ids[c], scores[q, c], rows[c]]))
            if sum(x.shape[1] for x in held) > 1 << 20:
                held = [trim(np.concatenate(held, axis=1), k)]
        q, ids, scores, rows = trim(np.concatenate(held, axis=1), k)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (block.rows[q], block.ids[q], ids, rows, scores)], ["query", "query_id", "vec_id", "row", "score"])

    return rows.mapInArrow(run, "query long, query_id long, vec_id long, row long, score long")


def trim(found: np.ndarray, k: int) -> np.ndarray:
    """The first k of each query by falling score, then rising id, then row."""
    found = found[:, np.lexsort((found[3], found[1], -found[2], found[0]))]
    first = np.searchsorted(found[0], found[0])
    return found[:, np.arange(found.shape[1]) - first < k]


def query_blocks(queries: DataFrame, block: int) -> Iterator[Block]:
    """Queries of equal length, ``block`` at a time; the driver holds at most ``block`` queries of each length."""
    held: dict[int, list] = {}
    for row in queries.select("row", "vec_id", "n", "v").toLocalIterator():
        own = held.setdefault(row.n, [])
        own.append((row.row, row.vec_id, np.frombuffer(row.v, "<i4" if len(row.v) == 4 * row.n else "<i8")))
        if len(own) == block:
            yield Block(*zip(*held.pop(row.n)))
    for own in held.values():
        yield Block(*zip(*own))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest inner products; ``vectors`` as ``integers`` gives them, ``queries`` some of its rows."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    parts = []
    for own in query_blocks(queries, block):
        shared = spark.sparkContext.broadcast(own)
        same = vectors.where(F.col("n") == own.q.shape[1])
        parts.append(keep(best(same, shared, kth_scores(same, shared, k), k), "top-k"))
        shared.unpersist()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = functools.reduce(DataFrame.unionAll, parts)
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every 50th row of ``embeddings``, its 5 highest inner products with the others: see the module."""
    rows = integers(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where("vec_id % 50 = 0"))


OP10_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, row_number() OVER () AS r FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
v AS (SELECT r, vec_id, list_transform(x, lambda y: floor(256 * y)) AS v FROM e
  WHERE len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
s AS (SELECT q.r AS qr, q.vec_id AS query_id, c.r, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)),
t AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, r) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM t WHERE n <= 5"""
