"""Approximate nearest neighbours by learned partitions.

1. A bounded sample of vectors makes a neighbour graph, which recursive bisection cuts into parts of equal size with few cut edges
   (a spectral split at the median, then swaps that lower the cut).
2. A small network learns, for a vector, the parts its neighbours lie in.  It stands for the partition from then on.
3. Every row of the table is indexed under its most probable part; a query goes to its several most probable parts, and the rows
   there are ranked by exact distance.  How many parts is measured on sampled rows that were not learned from: the least
   number that covers ``COVER`` of the true neighbours of distinct vectors (copies of one vector would count as often as they stand).

Vectors of different length do not meet.  Parts are learned for the most frequent length; rows of any other length are one part, which is
searched whole.

The sample and the network have fixed sizes; rows are routed in Spark.  A part is dealt to as many groups as its row count
asks for, so large parts stay bounded per task.  Nearness: Euclidean distance in double precision, ties to the smaller vec_id.

With fewer candidates than k all that were found are returned; tables of at most ``SMALL`` rows have one part, which makes the
search exact.  See ``vectors.usable`` for nulls, repeated rows and odd vectors; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.base import saved, table
from ledgerweave.llm.vectors import best, matrix, usable

K = 10
#: Rows sampled for the graph, parts, neighbours of the graph, and the share of true neighbours that probing must cover.
SAMPLE, PARTS, NEIGHBOURS, COVER = 4096, 16, 16, 0.98
#: Tables up to this size have one part; rows of a group of a part.
SMALL, GROUP = 1000, 4096
HIDDEN, STEPS = 128, 600


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest others of each row."""
    sq = (x * x).sum(1)
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 512):
        d = sq[None, :] - 2 * x[lo:lo + 512] @ x.T
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out[lo:lo + 512] = np.argpartition(d, k, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rng) -> np.ndarray:
    """Part of each node: halves of equal size, again and again, cutting few edges of the graph."""
    n, k = graph.shape
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    part = np.zeros(n, np.int64)

    def halve(nodes: np.ndarray) -> np.ndarray:
        where = np.full(n, -1)
        where[nodes] = np.arange(len(nodes))
        keep = (where[a] >= 0) & (where[b] >= 0)
        u, v = where[a[keep]], where[b[keep]]
        u, v = np.concatenate((u, v)), np.concatenate((v, u))
        m = len(nodes)
        degree = np.maximum(np.bincount(u, minlength=m), 1)
        y = rng.normal(size=m)
        for _ in range(60):  # towards the second eigenvector of the random walk
            y -= (y * degree).sum() / degree.sum()
            y = 0.5 * y + 0.5 * np.bincount(u, weights=y[v], minlength=m) / degree
            y /= np.linalg.norm(y) + 1e-30
        side = np.zeros(m, bool)
        side[np.argsort(y, kind="stable")[m // 2:]] = True
        for _ in range(10):  # swap pairs whose moves both lower the cut
            across = np.bincount(u, weights=side[u] != side[v], minlength=m)
            gain = 2 * across - np.bincount(u, minlength=m)
            left, right = (np.flatnonzero(s)[np.argsort(-gain[s], kind="stable")] for s in (~side, side))
            c = min(len(left), len(right), max(1, m // 20))
            good = int((gain[left[:c]] + gain[right[:c]] > 2).sum())
            if not good:
                break
            trial = side.copy()
            trial[left[:good]], trial[right[:good]] = True, False
            if (trial[u] != trial[v]).sum() >= (side[u] != side[v]).sum():
                break
            side = trial
        return side

    size = 1
    while size < parts:
        for p in range(size):
            nodes = np.flatnonzero(part == p)
            if len(nodes) > 1:
                part[nodes[halve(nodes)]] = p + size
        size *= 2
    return part


class Router:
    """A network with one hidden layer: parts of a vector by probability."""

    def __init__(self, x: np.ndarray, target: np.ndarray, rng):
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        z = (x - self.mean) / self.scale
        d, p = x.shape[1], target.shape[1]
        w = [rng.normal(size=(d, HIDDEN)) * np.sqrt(2 / d), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, p)) * np.sqrt(1 / HIDDEN), np.zeros(p)]
        m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        for t in range(1, STEPS + 1):
            i = rng.integers(0, len(z), 512)
            h = np.maximum(z[i] @ w[0] + w[1], 0)
            e = self._soft(h @ w[2] + w[3]) - target[i]
            back = (e @ w[2].T) * (h > 0)
            for j, g in enumerate((z[i].T @ back, back.sum(0), h.T @ e, e.sum(0))):
                g = g / len(i) + 1e-4 * w[j]
                m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.99 * v[j] + 0.01 * g * g
                w[j] = w[j] - 0.01 * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.99 ** t)) + 1e-9)
        self.w = w

    @staticmethod
    def _soft(s):
        s = np.exp(s - s.max(1, keepdims=True))
        return s / s.sum(1, keepdims=True)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts from the most to the least probable."""
        z = (x - self.mean) / self.scale
        s = np.maximum(z @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        return np.argsort(-s, axis=1, kind="stable")


def learn(x: np.ndarray, parts: int = PARTS, cover: float = COVER, seed: int = 7) -> tuple[Router, int]:
    """Router and number of parts to probe, from sampled vectors."""
    rng = np.random.default_rng(seed)
    asked, x = np.unique(x[:len(x) // 4], axis=0), x[len(x) // 4:]  # copies of one vector are one query
    k = min(NEIGHBOURS, len(x) - 1)
    graph = neighbour_graph(x, k)
    part = balanced_parts(graph, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 1)
    np.add.at(target, (np.arange(len(x)), part), 1)
    router = Router(x, target / target.sum(1, keepdims=True), rng)
    # of rows not learned from: the place, in their order of parts, of the part each true neighbour is indexed under
    indexed, order = router.order(x)[:, 0], router.order(asked)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], 1)
    near = np.argsort((x * x).sum(1)[None, :] - 2 * asked @ x.T, axis=1, kind="stable")[:, :K]
    need = np.sort(np.take_along_axis(place, indexed[near], 1).ravel())
    return router, int(need[min(len(need) - 1, int(np.ceil(cover * len(need))))]) + 1


def nearest(vectors: DataFrame, is_query, k: int = K, parts: int = PARTS, cover: float = COVER) -> DataFrame:
    """query_id, rank, vec_id, score (distance) of the k nearest rows found; ``vectors`` (vec_id, v array<double>, row, n)."""
    spark = vectors.sparkSession
    vectors = saved(vectors, "vectors")
    sizes = vectors.groupBy("n").count().orderBy(F.desc("count"), "n").first()  # one row
    one_part = lambda v: v.withColumn("parts", F.array(F.lit(0)))
    if not sizes or sizes["count"] <= SMALL:
        routed = one_part(vectors)
    else:
        usual = vectors.where(F.col("n") == sizes.n)
        sample = usual.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "row").limit(SAMPLE).collect()  # a fixed number of rows
        router, probes = learn(np.array([r.v for r in sample]), parts, cover)
        own = spark.sparkContext.broadcast(router)

        def route(batches):
            for b in batches:
                if b.num_rows:
                    order = own.value.order(matrix(b.column(1)))[:, :probes].astype(np.int32)
                    cuts = np.arange(0, order.size + 1, probes, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(cuts), pa.array(order.ravel()))], names=[*b.schema.names, "parts"])

        placed = usual.select("vec_id", "v", "row", "n").mapInArrow(route, "vec_id long, v array<double>, row long, n int, parts array<int>")
        routed = saved(placed.unionByName(one_part(vectors.where(F.col("n") != sizes.n))), "routed")
    index = routed.select("vec_id", "v", "row", "n", F.col("parts")[0].alias("part"))
    counts = {r.part: r["count"] for r in index.groupBy("part").count().collect()}  # one row a part
    groups = F.create_map(*[F.lit(x) for p, c in counts.items() for x in (p, -(-c // GROUP))]) if counts else F.create_map(F.lit(0), F.lit(1))
    index = index.withColumn("g", F.pmod(F.xxhash64("vec_id", "row"), groups[F.col("part")]).cast("int"))
    asked = (routed.where(is_query).select("vec_id", "v", "row", "n", F.explode("parts").alias("part")).where(groups[F.col("part")].isNotNull())
             .withColumn("g", F.explode(F.sequence(F.lit(0), groups[F.col("part")] - 1))))
    # queries are dealt too, each of their groups meeting each group of a part
    nq = max(1, -(-routed.where(is_query).count() // GROUP))
    asked = asked.withColumn("q", F.pmod(F.xxhash64(F.lit(1), "vec_id", "row"), F.lit(nq)).cast("int"))
    index = index.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    def search(vs: pa.Table, qs: pa.Table) -> pa.Table:
        ids, rows, out = vs.column("vec_id").to_numpy(), vs.column("row").to_numpy(), ([], [], [], [])
        if len(ids) and qs.num_rows:
            x = matrix(vs.column("v"))
            sq = (x * x).sum(1)
            for q, row, y in zip(qs.column("vec_id").to_numpy(), qs.column("row").to_numpy(), matrix(qs.column("v"))):
                own_row = (ids == q) & (rows == row)
                rough = sq - 2 * (x @ y)
                rough[own_row] = np.inf
                bar = np.partition(rough, k - 1)[k - 1] if len(rough) > k else np.inf
                at = np.flatnonzero((rough <= bar + 1e-9 * (abs(bar) + y @ y + sq.max()) if np.isfinite(bar) else np.isfinite(rough)) & ~own_row)
                score = np.sqrt(((x[at] - y) ** 2).sum(1))
                o = np.lexsort((ids[at], score))[:k]
                for column, values in zip(out, (np.full(len(o), q), np.full(len(o), row), ids[at[o]], score[o])):
                    column.append(values)
        cat = lambda c, t: pa.array(np.concatenate(c) if c else np.zeros(0), t)
        return pa.table({"query_id": cat(out[0], pa.int64()), "query_row": cat(out[1], pa.int64()), "vec_id": cat(out[2], pa.int64()), "score": cat(out[3], pa.float64())})

    keys = ["n", "part", "g", "q"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "query_id long, query_row long, vec_id long, score double")
    return best(found, k, ascending=True)


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(usable(table(spark, sf_dir, "embeddings"), zero=False), F.col("vec_id") % 100 == 0)
