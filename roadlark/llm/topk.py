"""Exact top-k search by inner product, dimension block by dimension block.

Vectors are packed into blocks in vertical layout: one row of numbers per dimension.  A task takes
a block of candidates and a block of queries, adds up the scores over one block of dimensions
after another, and bounds what the remaining dimensions can still add by the product of the
remaining lengths (Cauchy-Schwarz).  Candidates whose upper bound falls below a query's k-th best
lower bound are compacted away, the rest goes on to the next dimensions; what reaches the last
block has its exact score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlark.llm.common import Scratch, parts

SCALE = 64
CANDIDATES = 4096
QUERIES = 64
DIMENSIONS = 16
# Whole numbers up to here are exact as doubles.
EXACT = float(1 << 53)
LARGEST = float(1 << 31)
TOO_LOW = -(1 << 63)


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, d, v, large): the valid vectors as whole numbers, and whether one is beyond LARGEST."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(scale)))
    # A double of this size is a whole number.
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < EXACT / 2, F.floor(y).cast("double")).otherwise(y))
    finite = F.forall(scaled, lambda y: F.coalesce(F.abs(y) < float("inf"), F.lit(False)))  # false for NaN, too
    known = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return known.select(
        F.col("vec_id").cast("long"),
        F.size("embedding").alias("d"),
        whole.alias("v"),
        F.exists(scaled, lambda y: F.abs(y) >= LARGEST).alias("large"),
    )


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """(d, large, ids, v): up to ``size`` vectors of one dimension; v holds one row per dimension,
    as 32-bit numbers, or as doubles if large."""

    def run(batches):
        held: dict[tuple, list] = {}

        def pack(key, rows):
            ids = np.array([i for i, _ in rows], np.int64)
            kind = np.float64 if key[1] else np.int32
            columns = np.array([v for _, v in rows], kind).reshape(len(rows), key[0]).T
            return *key, ids.tobytes(), np.ascontiguousarray(columns).tobytes()

        def table(rows):
            kinds = pa.int32(), pa.bool_(), pa.binary(), pa.binary()
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["d", "large", "ids", "v"])

        for batch in batches:
            for i, d, v, large in zip(*(c.to_pylist() for c in batch.columns)):
                rows = held.setdefault((d, large), [])
                rows.append((i, v))
                if len(rows) == size:
                    yield table([pack((d, large), rows)])
                    del held[d, large]
        if held:
            yield table([pack(key, rows) for key, rows in held.items()])

    return vectors.mapInArrow(run, "d int, large boolean, ids binary, v binary")


def exact_scores(queries, query_ids, candidates, ids, k):
    """Like ``search``, for numbers of any size: whole numbers without a limit, no bounds."""
    whole = np.frompyfunc(int, 1, 1)
    scores = whole(queries).T @ whole(candidates) if len(queries) else np.zeros((len(query_ids), len(ids)), object)
    for i, query in enumerate(query_ids):
        at = [n for n in range(len(ids)) if ids[n] != query]
        at = sorted(at, key=lambda n: (-scores[i, n], ids[n]))[:k]
        best = [int(scores[i, n]) for n in at]
        if best and best[0] >= 1 << 63:
            raise OverflowError(f"a score of vector {query} does not fit a long")
        # Too low for a long: an error only if it is among the best of all blocks.
        best = [max(x, TOO_LOW) for x in best]
        if at:
            yield i, ids[at], np.array(best, np.int64)


def remaining(columns: np.ndarray, step: int) -> np.ndarray:
    """Length of each vector's part from each block of dimensions on."""
    if not len(columns):
        return np.zeros((1, columns.shape[1]))
    squares = np.add.reduceat(columns * columns, np.arange(0, len(columns), step), axis=0)
    rest = np.cumsum(squares[::-1], axis=0)[::-1]
    # Room for rounding: bounds may be too wide, never too narrow.
    return np.sqrt(np.vstack([rest, np.zeros((1, columns.shape[1]))])) * (1 + 1e-9)


def search(queries, query_ids, candidates, ids, k, floor):
    """(query number, candidate id, score) of each query's ``k`` best of one block of candidates.

    ``floor`` holds for each query a score that k others are known to reach; it is raised here.
    """
    d, n = candidates.shape
    q, m = queries.T, len(query_ids)
    own = query_ids[:, None] == ids[None, :]
    rest_q, rest_c = remaining(queries, DIMENSIONS), remaining(candidates, DIMENSIONS)
    limit = np.abs(q).max(initial=0) * np.abs(candidates).max(initial=0) * max(d, 1)
    kind = np.float64 if limit < EXACT else np.int64
    left, score = np.arange(n), np.zeros((m, n), kind)
    for block, begin in enumerate(range(0, d, DIMENSIONS)):
        part = slice(begin, begin + DIMENSIONS)
        score += q[:, part].astype(kind) @ candidates[part][:, left].astype(kind)
        slack = rest_q[block + 1][:, None] * rest_c[block + 1][left][None, :]
        if kind is not np.float64:
            slack = np.ceil(slack * (1 + 1e-6))
        if len(left) - 1 > k:
            low = np.where(own[:, left], -np.inf, score - slack)
            floor = np.maximum(floor, -np.partition(-low, k - 1, axis=1)[:, k - 1])
        alive = (score + slack >= floor[:, None]) & ~own[:, left]
        some = alive.any(axis=0)
        if not some.all():
            left, score = left[some], score[:, some]
    found = (score >= floor[:, None]) & ~own[:, left]
    for i in np.flatnonzero(found.any(axis=1)):
        at = np.flatnonzero(found[i])
        at = at[np.lexsort((ids[left[at]], -score[i, at]))][:k]
        if len(at) == k:
            floor[i] = max(floor[i], score[i, at[-1]])
        yield i, ids[left[at]], score[i, at].astype(np.int64)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of all other rows.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id.  Components become
    floor(scale * x).  Vectors that are null or hold null, infinite or NaN components take no
    part, nor do rows without vec_id.  Vectors with a component of 2**31 or more after scaling are
    scored with whole numbers of any size; a best score that does not fit a long is an error.
    Only vectors of one length meet; empty vectors score 0 with each other.
    Equal scores rank by the smaller vec_id.  A repeated candidate row counts as often as it is
    there; a repeated query id asks once, with the least of its vectors.  Fewer than ``k``
    candidates give fewer rows, an empty table none.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")
    valid = quantised(vectors, scale)
    rows = scratch.keep(blocks(valid, CANDIDATES))
    asked = valid.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("d", "v", "large")).alias("x"))
    asked = blocks(asked.select("vec_id", "x.d", "x.v", "x.large"), QUERIES)
    asked = scratch.keep(asked.toDF("d", "large_q", "query_ids", "q"))
    # A grid of cells: its rows share out the candidates, its columns the queries, so each block
    # is sent to one row or column of cells.
    side = math.ceil(math.sqrt(2 * parts(vectors.sparkSession)))
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    left = rows.withColumn("i", F.pmod(F.xxhash64("ids"), F.lit(side)).cast("int"))
    right = asked.withColumn("j", F.pmod(F.xxhash64("query_ids"), F.lit(side)).cast("int"))
    grid = left.withColumn("j", every).join(right.withColumn("i", every), ["d", "i", "j"])
    grid = grid.select("d", "large", "ids", "v", "large_q", "query_ids", "q")

    def run(batches):
        floors: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for d, large, ids, v, large_q, query_ids, q in zip(*batch.columns):
                d, name = d.as_py(), query_ids.as_py()
                ids, asking = np.frombuffer(ids.as_buffer(), "i8"), np.frombuffer(name, "i8")
                kind, kind_q = ("f8" if x.as_py() else "i4" for x in (large, large_q))
                v = np.frombuffer(v.as_buffer(), kind).reshape(d, len(ids)).astype(float)
                q = np.frombuffer(q.as_buffer(), kind_q).reshape(d, len(asking)).astype(float)
                if kind == "f8" or kind_q == "f8":
                    out = list(exact_scores(q, asking, v, ids, k))
                else:
                    # What one block of candidates has reached holds for the task's next blocks.
                    floor = floors.setdefault(name, np.full(len(asking), -np.inf))
                    out = list(search(q, asking, v, ids, k, floor))
                if out:
                    numbers, found, scores = zip(*out)
                    asker = np.repeat(asking[list(numbers)], [len(x) for x in found])
                    columns = asker, np.concatenate(found), np.concatenate(scores)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], names=["query_id", "vec_id", "score"]
                    )

    best = grid.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    fits = F.when(F.col("score") == TOO_LOW, F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return ranked.select("query_id", "rank", "vec_id", fits.otherwise(F.col("score")).alias("score"))
