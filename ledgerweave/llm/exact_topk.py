"""Exact top-k search by inner product, without random access.

A vector is an object with one sorted list per component.  For a query the lists are read from their better end, all to
the same depth, step by step; an object met in a list has a lower bound of its read components plus, for each unread one, the list's worst
product, and an upper bound of the read components plus the products at the depth reached.  Reading stops at the first step where the k-th
best lower bound is above the score that an object not yet met could have.  Of the objects met, those whose upper bound reaches the
k best lower bounds are resolved to full scores from the block's rows; where reading goes to the end of the lists, the bounds are the scores.

Queries and vectors meet in blocks of bounded size (each block of queries against each block of vectors, a stated query set against
all rows), so neither side has to fit anywhere.  Lists are kept per block, as ranks of the block's objects.

Integers only, so scores are exact.  Ties go to the smaller vec_id; with fewer candidates than k all are returned; see ``vectors.usable``
for nulls, repeated rows and odd vectors; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.base import saved, table
from ledgerweave.llm.vectors import best, matrix, usable

K = 10
SCALE = 1024
#: Vectors and queries of a block.
VECTORS, QUERIES = 4096, 1024
#: Steps in which a list is read.
STEPS = 16


class SortedLists:
    """One sorted list per component over the objects of a block."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.largest = int(np.abs(values).max(initial=0))
        self.order = np.argsort(values, axis=0, kind="stable")  # objects of each list, smallest value first
        self.sorted = np.take_along_axis(values, self.order, 0)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Objects that may be among the k best (ties kept), with full scores, and the depth to which the lists were read."""
        n, d = self.values.shape
        down = query > 0  # lists of positive components are read from their large end
        # sums of products are exact in doubles below 2^53, else whole integers
        exact = self.largest * int(np.abs(query).max(initial=0)) * d < 1 << 53
        query = query.astype(np.float64 if exact else np.int64)
        worst = np.where(down, self.sorted[0], self.sorted[-1]) * query
        lower, met, seen = np.full(n, worst.sum()), np.zeros(n, bool), np.zeros((n, d), bool)
        lists, depth = np.arange(d), 0
        for step in range(1, STEPS + 1):
            start, depth = depth, n * step // STEPS
            if depth == start:
                continue
            read = np.arange(start, depth)[:, None]
            at = np.where(down, n - 1 - read, read)
            objects = self.order[at, lists]
            products = self.sorted[at, lists] * query
            # each read product takes the place of the list's worst
            if exact:
                lower += np.bincount(objects.ravel(), weights=(products - worst).ravel(), minlength=n)
            else:
                np.add.at(lower, objects, products - worst)
            seen[objects, lists] = met[objects] = True
            reached = products[-1]
            # an object not met yet scores the threshold at most; one that ties may have the smaller id
            if n - k > 0 and met.sum() >= k and np.partition(lower, n - k)[n - k] > reached.sum():
                break
        left = np.flatnonzero(met)
        if depth < n:
            upper = lower[left] + (reached - worst).sum() - seen[left].astype(query.dtype) @ (reached - worst)
            left = left[upper >= np.partition(lower, n - k)[n - k]]
            return left, (self.values[left].astype(query.dtype) @ query).astype(np.int64), depth
        return left, lower.astype(np.int64), depth


def exact_top(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score (long) of the k largest inner products; ``vectors`` (vec_id, z array<long>, row, n)."""
    vectors = saved(vectors, "integers")
    queries = vectors.where(is_query)
    n, m = vectors.count(), queries.count()
    nv, nq = max(1, -(-n // VECTORS)), max(1, -(-m // QUERIES))
    block = lambda of, size: F.pmod(F.xxhash64(F.lit(of), "vec_id", "row"), F.lit(size)).cast("int")
    spread = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    left = vectors.withColumn("vb", block(1, nv)).withColumn("qb", spread(nq))
    right = queries.withColumn("qb", block(2, nq)).withColumn("vb", spread(nv))

    def search(vs: pa.Table, qs: pa.Table) -> pa.Table:
        ids, rows, z = vs.column("vec_id").to_numpy(), vs.column("row").to_numpy(), matrix(vs.column("z"))
        out = [], [], [], []
        if len(ids) and qs.num_rows:
            lists = SortedLists(z)
            for q, row, x in zip(qs.column("vec_id").to_numpy(), qs.column("row").to_numpy(), matrix(qs.column("z"))):
                at, score, _ = lists.search(x, k + 1)  # one more, as the query itself may be there
                other = (ids[at] != q) | (rows[at] != row)
                at, score = at[other], score[other]
                o = np.lexsort((ids[at], -score))[:k]
                for column, values in zip(out, (np.full(len(o), q), np.full(len(o), row), ids[at[o]], score[o])):
                    column.append(values)
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        return pa.table({"query_id": cat(out[0]), "query_row": cat(out[1]), "vec_id": cat(out[2]), "score": cat(out[3])})

    found = left.groupBy("n", "vb", "qb").cogroup(right.groupBy("n", "vb", "qb")).applyInArrow(search, "query_id long, query_row long, vec_id long, score long")
    return best(found, k, ascending=False)


def integers(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, z, row, n): each component x of a usable vector as floor(scale * x)."""
    return usable(df, zero=True).select("vec_id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("long")).alias("z"), "row", "n")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top(integers(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


OP7_SQL = """
WITH t AS (SELECT row_number() OVER () AS r, vec_id, embedding, len(embedding) AS n FROM embeddings WHERE vec_id IS NOT NULL),
x AS (SELECT r, vec_id, n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM t),
bad AS (SELECT DISTINCT r FROM x WHERE x IS NULL OR NOT isfinite(x)),
v AS (SELECT r, vec_id, n, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS z FROM x WHERE r NOT IN (SELECT r FROM bad)),
s AS (SELECT q.r AS qr, c.r AS cr, q.vec_id AS query_id, c.vec_id, CAST(sum(q.z * c.z) AS BIGINT) AS score
      FROM v q JOIN v c ON q.i = c.i AND q.n = c.n AND q.r <> c.r WHERE q.vec_id % 100 = 0 GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
