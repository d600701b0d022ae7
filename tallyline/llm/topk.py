"""Exact top-k search by columnar branch and bound over integer vectors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.session import stored

#: Vectors of a candidate block and of a query block. A task holds one block of each.
CANDIDATES, QUERIES = 16384, 2048
#: Candidates whose scores with the queries of a block are held at once.
CHUNK = 2048
#: Dimensions that are added between two rounds of pruning.
STEP = 16
#: Below this part of all pairs, those that are left go on one by one instead of as a matrix.
SPARSE = 1 / 16
SCALE = 64


def floor_scaled(vector: str = "embedding", scale: int = SCALE) -> Column:
    """The components times ``scale``, rounded down; null for vectors that take no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return F.when(F.col(vector).isNotNull() & sound & (F.size(vector) > 0), whole)


def _first_copies(vectors: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the vectors without those that ``k`` + 1 equal ones of smaller id come before.

    One of those may be the query itself, so the others cannot be among its ``k`` best.
    """
    rows = np.ascontiguousarray(vectors)
    same = np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).reshape(-1), return_inverse=True)[1].reshape(-1)
    order = np.lexsort((ids, same))
    new = np.ones(len(order), bool)
    new[1:] = same[order[1:]] != same[order[:-1]]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[rank <= k]


def _best(which: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each query, by falling score, then by id."""
    order = np.lexsort((ids, -scores, which))
    which, ids, scores = which[order], ids[order], scores[order]
    rank = np.arange(len(which)) - np.searchsorted(which, which)
    return which[rank < k], ids[rank < k], scores[rank < k]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, candidate_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, candidate id and score of the ``k`` best candidates of each query in a block.

    Candidates are walked by falling norm, a chunk at a time, in vertical layout: one row for each
    dimension. A chunk's scores grow by ``STEP`` dimensions at a time, those of the greatest mass
    first, all queries at once by a product of matrices. What is left can add at most the product of
    both remaining norms; with the ``k``-th best of the chunks before, this bound drops pairs, and the
    queries and candidates that still have some move together. Once few pairs are left, they go on one
    by one. The walk ends where the norms alone keep every query from a better score. Ties go to the
    smaller id. Scores are exact: sums beyond 2^53 are taken over Python's integers.
    """
    place = _first_copies(candidates, candidate_ids, k)
    squares = (candidates[place].astype(np.float64) ** 2).sum(axis=1)
    place = place[np.argsort(-squares, kind="stable")]
    candidates, candidate_ids = candidates[place], candidate_ids[place]
    norms = np.sqrt((candidates.astype(np.float64) ** 2).sum(axis=1))
    own = queries.astype(np.float64) ** 2
    lengths = np.sqrt(own.sum(axis=1))
    exact = lengths.max(initial=0.0) * norms.max(initial=0.0) < 2.0**52
    queries = queries.astype(np.float64 if exact else object)
    order = np.argsort(-own.sum(axis=0) * (candidates.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    dims = len(order)
    found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, queries.dtype)
    floor = np.full(len(queries), -np.inf)
    for first in range(0, len(candidates), CHUNK):
        # Floating-point bounds may be a little short; the slack covers that.
        slack = 1 + 1e-9 * lengths * norms[first]
        q = np.flatnonzero(lengths * norms[first] + slack >= floor)
        if not len(q):
            break
        part = candidates[first : first + CHUNK].T
        mass = part.astype(np.float64) ** 2
        part = np.ascontiguousarray(part).astype(queries.dtype)
        ids = candidate_ids[first : first + CHUNK]
        c = np.arange(len(ids))
        rest, left = own[q].sum(axis=1), mass.sum(axis=0)
        score = np.where(query_ids[q][:, None] == ids, -np.inf, 0.0).astype(queries.dtype)
        pairs = None
        for lo in range(0, dims, STEP):
            now = order[lo : lo + STEP]
            rest = np.maximum(rest - own[np.ix_(q, now)].sum(axis=1), 0.0)
            left = np.maximum(left - mass[np.ix_(now, c)].sum(axis=0), 0.0)
            if pairs is None:
                score += queries[np.ix_(q, now)] @ part[np.ix_(now, c)]
            else:
                i, j = pairs
                score = score + (queries[np.ix_(q, now)][i] * part[np.ix_(now, c)].T[j]).sum(axis=1)
            if lo + STEP >= dims:
                break
            if pairs is not None:
                bound = score + np.sqrt(rest)[i] * np.sqrt(left)[j]
                keep = np.flatnonzero(bound + slack[q][i] >= floor[q][i])
                pairs, score = (i[keep], j[keep]), score[keep]
                continue
            least = floor[q] - slack[q]
            if least.max() == -np.inf:
                continue
            may = score >= least[:, None] - np.sqrt(rest)[:, None] * np.sqrt(left)
            if np.count_nonzero(may) <= SPARSE * may.size:
                pairs = np.nonzero(may)
                score = score[pairs]
                continue
            rows, columns = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
            if len(rows) * len(columns) < 0.8 * may.size:
                q, c, rest, left = q[rows], c[columns], rest[rows], left[columns]
                score = score[np.ix_(rows, columns)]
        if pairs is None:
            least = floor[q]
            if len(c) > k:
                least = np.maximum(least, np.partition(score, len(c) - k, axis=1)[:, len(c) - k])
            pairs = np.nonzero((score >= least[:, None]) & (score > -np.inf))
            score = score[pairs]
        i, j = pairs
        keep = (score >= floor[q[i]]) & (score > -np.inf)
        new = q[i[keep]], ids[c[j[keep]]], score[keep]
        found = _best(*(np.concatenate(both) for both in zip(found, new, strict=True)), k)
        full = np.flatnonzero(np.bincount(found[0], minlength=len(queries)) == k)
        floor[full] = found[2][np.searchsorted(found[0], full, "right") - 1]
    return found[0], found[1], found[2].astype(np.int64)


def _searched(k: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("asks").to_numpy()
        ids = table.column("id").to_numpy()
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
        if not asks.any() or asks.all():
            return pa.table(empty)
        flat = table.column("v").chunk(0).flatten().to_numpy().reshape(len(ids), -1)
        which, other, score = search_block(flat[asks], ids[asks], flat[~asks], ids[~asks], k)
        return pa.table({"query_id": ids[asks][which], "vec_id": other, "score": score})

    return run


def exact_top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = CANDIDATES, query_block: int = QUERIES
) -> DataFrame:
    """Per query its ``k`` candidates of greatest inner product: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both tables: ``id`` long, ``v`` array of long. A candidate with the id of the query is left out; ties
    go to the smaller id; a query with fewer candidates gets all. Rows with null ids or null or empty
    vectors take no part; vectors are compared only with those of their own length. Rows repeated
    in the candidates count once for each. Scores must fit a long; others end the job with an error.

    Every query meets every candidate, block by block: each pair of blocks is a group of its own,
    of bounded size, and returns ``k`` rows for each query. Rows are dealt by a number of their own,
    so repeated ids spread as well, and components travel in the narrowest type that holds them all.
    Two jobs store the rows and two count them while the plan is made.
    """
    sound = "id is not null and v is not null and size(v) > 0"
    q, c = (
        stored(x.where(sound).select("id", "v", F.monotonically_increasing_id().alias("row")), name)
        for x, name in ((queries, "queries"), (candidates, "candidates"))
    )
    widest = F.greatest(F.max(F.array_max("v")), -F.min(F.array_min("v")))
    (n_queries, most), (n_candidates, other) = (x.agg(F.count(F.lit(1)), widest).first() for x in (q, c))
    nq, nc = max(1, -(-n_queries // query_block)), max(1, -(-n_candidates // block))
    most = max(most or 0, other or 0)
    narrow = "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "bigint"
    v = F.col("v").cast(f"array<{narrow}>").alias("v")

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    q = q.select(F.lit(True).alias("asks"), "id", v, dealt(nq).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("b"))
    c = c.select(F.lit(False).alias("asks"), "id", v, F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("a"), dealt(nc).alias("b"))
    groups = q.unionByName(c).withColumn("size", F.size("v")).groupBy("a", "b", "size")
    found = groups.applyInArrow(_searched(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every 20th vector of ``embeddings`` its 20 best others."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("id"), floor_scaled().alias("v"))
    return exact_top_k(rows.where("id % 20 = 0"), rows)


OP8_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
