"""Exact search for the largest inner products by segment statistics, from coarse to fine.

A vector is cut into 1, then 4, then 16 segments of equal length. With mean m and deviation s (the length of what is left after
the mean is taken out) of each segment, ``len * m_q * m_x + s_q * s_x``, summed over the segments, is never below the inner
product, as a sum of distances from the same statistics is never above the distance. Candidates whose bound is under the k-th best
score so far are dropped level by level; the survivors' scores are computed exactly from the integers. The bounds of some queries for
all rows left are one product of matrices.

Queries and candidates are dealt to blocks by a hash of their ids, and a task searches one block of candidates for one block of
queries. The k-th best score of each query in the first block is known to all others, which return only what reaches it.

Defined cases: a component x becomes floor(scale * x); vectors that are null, empty or have null or non-finite components take no part;
vectors of different lengths are not compared; rows that repeat an id count as one vector; ties go to the smaller id. Scores beyond
a long are set to its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urndraw.llm.common import stored
from urndraw.llm.vectors import matrix, vectors

LEVELS = (1, 4, 16)
QUERIES_PER_BLOCK, ROWS_PER_BLOCK = 4096, 4096
#: Queries of a block that are compared with its rows as one matrix.
TOGETHER = 128


class Segments:
    """Segment means and deviations of the rows of a matrix, at each level."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.norms = rows, np.sqrt((rows * rows).sum(axis=1))
        self.means, self.spreads = [], []
        for count in LEVELS:
            size = -(-rows.shape[1] // count)
            parts = np.pad(rows, ((0, 0), (0, size * count - rows.shape[1]))).reshape(len(rows), count, size)
            mean = parts.mean(axis=2)
            self.means.append(mean * np.sqrt(size))  # the product of two of these has the segment's length in it
            self.spreads.append(np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2)))

    def bounds(self, level: int, query: "Segments", q: int | np.ndarray, which: np.ndarray) -> np.ndarray:
        """A bound for each row of ``which``, for one query or as a row for each of several."""
        bound = query.means[level][q] @ self.means[level][which].T
        bound += query.spreads[level][q] @ self.spreads[level][which].T
        bound += np.multiply.outer(1e-9 * query.norms[q], self.norms[which])  # rounding never takes a bound under its score
        return bound + 1e-6


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; plain integers where doubles would round."""
    if _plain(rows, query):
        return (rows @ query).astype(np.int64)
    wide = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in rows]
    return np.array([min(max(x, -(2 ** 63)), 2 ** 63 - 1) for x in wide], np.int64)


def _plain(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Whether no sum of products of a row and a query can round."""
    return np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * max(1, rows.shape[-1]) < 2 ** 53


def _scores(rows: np.ndarray, queries: np.ndarray, q: np.ndarray, r: np.ndarray, plain: bool) -> np.ndarray:
    """The scores of pairs of a query and a row, the queries in order."""
    if not plain:
        ends = np.searchsorted(q, np.arange(len(queries) + 1))
        return np.concatenate([np.zeros(0, np.int64), *[exact(rows[r[a:b]], queries[i]) for i, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]])
    out = np.zeros(len(q), np.int64)
    for at in range(0, len(q), 1 << 15):
        out[at:at + (1 << 15)] = np.einsum("ij,ij->i", queries[q[at:at + (1 << 15)]], rows[r[at:at + (1 << 15)]])
    return out


def search(ids: np.ndarray, rows: Segments, query_ids: np.ndarray, queries: Segments, floors: np.ndarray, k: int):
    """(query ids, ids, scores) of the k best rows of each query that reach its floor, some queries at a time; ties go to the smaller id."""
    plain = _plain(rows.rows, queries.rows)
    for at in range(0, len(query_ids), TOGETHER):
        of = np.arange(at, min(at + TOGETHER, len(query_ids)))
        left, floor = np.arange(len(ids)), floors[of]
        open_pairs = ids[None, :] != query_ids[of][:, None]
        for level in range(len(LEVELS)):
            bound = rows.bounds(level, queries, of, left)
            if level + 1 == len(LEVELS):
                many = np.flatnonzero(open_pairs.sum(axis=1) > 2 * k)
                if len(many):
                    # the k best by bound give a score that the k best of all must reach
                    likely = np.argpartition(np.where(open_pairs[many], -bound[many], np.inf), k - 1, axis=1)[:, :k]
                    scores = _scores(rows.rows[left], queries.rows[of[many]], np.repeat(np.arange(len(many)), k), likely.ravel(), plain)
                    floor[many] = np.maximum(floor[many], scores.reshape(-1, k).min(axis=1))
            open_pairs &= bound >= floor[:, None]
            some = open_pairs.any(axis=0)
            left, open_pairs = left[some], open_pairs[:, some]
        if plain and len(left) > k and open_pairs.mean() > 0.1:
            # little was dropped: the k-th best of all scores is the floor
            products = np.where(open_pairs, queries.rows[of] @ rows.rows[left].T, -np.inf)
            floor = np.maximum(floor, np.partition(products, -k, axis=1)[:, -k])
            open_pairs = products >= floor[:, None]
        q, r = np.nonzero(open_pairs)
        scores = _scores(rows.rows[left], queries.rows[of], q, r, plain)
        keep = scores >= floor[q]
        q, found, scores = q[keep], ids[left[r[keep]]], scores[keep]
        best = np.lexsort((found, ~scores, q))  # the complement falls as the score grows, and never overflows
        starts = np.searchsorted(q[best], np.arange(len(of)))
        best = best[np.arange(len(best)) - starts[q[best]] < k]
        yield query_ids[of[q[best]]], found[best], scores[best]


def nearest(table: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, queries_per_block: int = QUERIES_PER_BLOCK,
            rows_per_block: int = ROWS_PER_BLOCK, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest scores for each row that ``queries`` picks by vec_id."""
    whole = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x).cast("double"))
    usable = vectors(table, id_column, vector_column).where("usable")
    rows = stored(usable.select("vec_id", F.size("vector").alias("dim"), whole.alias("vector")), "topk")
    asked = rows.where(queries)
    n_blocks = max(1, -(-rows.count() // rows_per_block))
    q_blocks = max(1, -(-asked.count() // queries_per_block))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    q_block = F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int")
    candidates = rows.select("dim", block.alias("block"), F.lit(False).alias("asks"), "vec_id", "vector", F.lit(None).cast("long").alias("floor"))
    asking = asked.select("dim", q_block.alias("q_block"), F.lit(True).alias("asks"), "vec_id", "vector")

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        ids, values = group.column("vec_id").to_numpy(), matrix(group.column("vector"))
        floors = np.array([-(2 ** 63) if f is None else f for f in group.column("floor").to_pylist()], np.int64)[asks]
        out_q, out_v, out_s = [ids[:0]], [ids[:0]], [ids[:0]]
        for q, found, scores in search(ids[~asks], Segments(values[~asks]), ids[asks], Segments(values[asks]), floors, k):
            out_q.append(q)
            out_v.append(found)
            out_s.append(scores)
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    def searched(candidates: DataFrame, asking: DataFrame) -> DataFrame:
        spread = candidates.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        names = ["dim", "block", "q_block", "asks", "vec_id", "vector", "floor"]
        both = spread.select(*names).unionAll(asking.select(*names))
        return both.groupBy("dim", "block", "q_block").applyInArrow(run, "query_id long, vec_id long, score long")

    none = F.lit(None).cast("long")
    first = stored(searched(candidates.where("block = 0"), asking.withColumn("block", F.lit(0)).withColumn("floor", none)), "topk")
    # a query's k-th best in the first block; with fewer than k rows there it has no floor
    floors = first.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("low")).alias("floor"))
    found = first
    if n_blocks > 1:
        later = asking.join(floors, "vec_id", "left").withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(n_blocks - 1))))
        found = first.unionAll(searched(candidates.where("block > 0"), later))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
