"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  Each positive asks for the best rows of other labels whose score lies
between a share of the positive's score and that score, so the windows of an anchor overlap.  Instead of one selection per window:

1. the positives' scores, the upper limits of the windows, cut the score line into disjoint slots;
2. each block of rows keeps, per anchor and slot, its k best rows (the combiner), and the k best of all blocks are kept per slot;
3. from the lowest slot up, the k best of everything at or below a limit are merged from the slot and the merge below it.  That
   merge, cut at the window's lower limit, is the window's answer: a window's rows below its upper limit are in these slots, and
   its lower limit only cuts the end of a descending list.

A row of another label is looked at once per anchor, whatever the number of positives, and at most k rows per slot are sent on.
Anchors and rows meet in blocks of bounded size (a stated query set against all rows); rows of one label meet in the first pass only
rows of that label.  Hot labels and repeated vectors are dealt to blocks by row, so no group grows with them.

Rows without vec_id or label, and vectors that are null or hold null or non-finite components take no part; vectors of different length have
no product and do not meet; zero and empty vectors count.  Every row is a row of its own, repeated rows too; an anchor does not
meet its own row, but its copies.  Ties go to the smaller vec_id.  A window whose upper limit is negative is empty.  Scores must fit
64 bits.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.llm.base import saved, table
from ledgerweave.llm.vectors import matrix

POSITIVES, NEGATIVES = 5, 5
#: A window's lower limit as a percentage of its upper one.
LOWER_PERCENT = 80
SCALE = 256
#: Rows and anchors of a block, and anchors scored at once.
ROWS, ANCHORS, TILE = 16384, 2048, 64
FOUND = "anchor_row long, slot int, row long, vec_id long, score long"


def taking_part(df: DataFrame, label, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, z array<long>, n) of the rows that take part; z: floor(scale * x) of each component."""
    v = df.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and label is not null and v is not null")
    v = v.where(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    z = F.transform("v", lambda x: F.floor(x * float(scale)).cast("long"))
    return v.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", z.alias("z"), F.size("v").alias("n"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of two matrices: by doubles where no sum can pass 2^53, else by whole integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2.0 ** 63:
        return a @ b.T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def leading(order: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """The first k of ``order`` within each run of equal ``group``."""
    g = group[order]
    start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    place = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[place < k]


def _rows_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(t)
    z = matrix(t.column("z"))
    return t.column("row").to_numpy(), t.column("vec_id").to_numpy(), z.astype(np.int64) if n and z.size else np.zeros((n, 0), np.int64)


def _found(parts: list[tuple]) -> pa.Table:
    types = (np.int64, np.int32, np.int64, np.int64, np.int64)
    cols = [np.concatenate(c).astype(t) if len(c) else np.zeros(0, t) for c, t in zip(zip(*parts), types)] if parts else [np.zeros(0, t) for t in types]
    return pa.table(dict(zip(("anchor_row", "slot", "row", "vec_id", "score"), cols)))


def _meet(rows: DataFrame, anchors: DataFrame, keys: list[str], search) -> DataFrame:
    """``search(rows, anchors)`` for every block of rows with every block of anchors that agree in ``keys``."""
    nr, na = (max(1, -(-d.count() // size)) for d, size in ((rows, ROWS), (anchors, ANCHORS)))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("rb", block(nr)).withColumn("ab", every(na))
    right = anchors.withColumn("ab", block(na)).withColumn("rb", every(nr))
    on = [*keys, "rb", "ab"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(search, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and slot, over all blocks."""
    w = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def positives(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(row, positives array<struct<rank, vec_id, score>>) of each anchor row: its k best other rows of its label."""
    def search(rs: pa.Table, qs: pa.Table) -> pa.Table:
        out = []
        if len(rs) and len(qs):
            (row, ids, z), (own, _, az) = _rows_of(rs), _rows_of(qs)
            for lo in range(0, len(own), TILE):
                for a, s in zip(own[lo:lo + TILE], products(az[lo:lo + TILE], z)):
                    at = np.flatnonzero(row != a)
                    if len(at) > k:
                        at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
                    at = at[np.lexsort((row[at], ids[at], -s[at]))[:k]]
                    out.append((np.full(len(at), a), np.zeros(len(at)), row[at], ids[at], s[at]))
        return _found(out)

    best = _best(_meet(rows, anchors, ["n", "label"], search), k)
    return best.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))


def slots(rows: DataFrame, anchors: DataFrame, k: int = NEGATIVES, lower_percent: int = LOWER_PERCENT) -> DataFrame:
    """(anchor_row, slot, vec_id, score, rank): the k best rows of other labels in each slot of ``anchors`` (with limits array<long>, ascending).

    Slot j holds the scores above limit j - 1 and up to limit j; scores below the lowest window are left out.
    """
    def search(rs: pa.Table, qs: pa.Table) -> pa.Table:
        out = []
        if len(rs) and len(qs):
            (row, ids, z), (own, _, az) = _rows_of(rs), _rows_of(qs)
            labels, mine, limits = rs.column("label").to_numpy(zero_copy_only=False), qs.column("label").to_numpy(zero_copy_only=False), qs.column("limits").to_pylist()
            for lo in range(0, len(own), TILE):
                for i, s in enumerate(products(az[lo:lo + TILE], z), lo):
                    upto = np.array(limits[i], np.int64)
                    least = -(-int(upto[0]) * lower_percent // 100)
                    at = np.flatnonzero((s >= least) & (s <= upto[-1]) & (labels != mine[i]))
                    if not len(at):
                        continue
                    slot = np.searchsorted(upto, s[at], "left")
                    o = leading(np.lexsort((row[at], ids[at], -s[at], slot)), slot, k)
                    at, slot = at[o], slot[o]
                    out.append((np.full(len(at), own[i]), slot, row[at], ids[at], s[at]))
        return _found(out)

    return _best(_meet(rows, anchors, ["n"], search), k)


def mine(rows: DataFrame, is_anchor, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, lower_percent: int = LOWER_PERCENT) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows`` (see ``taking_part``)."""
    rows = saved(rows, "vectors")
    anchors = rows.where(is_anchor)
    anchors = anchors.join(positives(rows, anchors, n_positives), "row")
    # windows with a negative upper limit are empty
    anchors = anchors.withColumn("limits", F.array_sort(F.array_distinct(F.filter(F.transform("positives", lambda p: p["score"]), lambda s: s >= 0)))).where("size(limits) > 0")
    anchors = saved(anchors, "anchors")
    found = slots(rows, anchors.drop("positives"), n_negatives, lower_percent)
    item = F.struct((-F.col("score")).alias("down"), "vec_id")
    found = found.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct("slot", item.alias("item"))).alias("found"))
    j = anchors.select("row", F.col("vec_id").alias("anchor_id"), "positives", "limits").join(found, "row")
    # from the lowest slot up: the best of everything at or below a limit
    below = f"""aggregate(sequence(0, size(limits) - 1), cast(array(array()) as array<array<struct<down: bigint, vec_id: bigint>>>),
        (merged, s) -> concat(merged, array(slice(array_sort(concat(element_at(merged, -1), transform(filter(found, f -> f.slot = s), f -> f.item))), 1, {int(n_negatives)}))))"""
    j = j.withColumn("merged", F.expr(below)).withColumn("p", F.explode("positives")).where("p.score >= 0")
    inside = F.expr(f"filter(element_at(merged, cast(array_position(limits, p.score) as int) + 1), x -> cast(-x.down as decimal(20, 0)) * 100 >= cast(p.score as decimal(20, 0)) * {int(lower_percent)})")
    j = j.select("anchor_id", "p", F.posexplode(inside).alias("at", "x"))
    return j.select("anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("negative_id"),
                    F.col("p.score").alias("positive_score"), (-F.col("x.down")).alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(taking_part(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH x AS (SELECT row_number() OVER () AS r, vec_id, embedding, IF(vec_id % 7 = 0, (label + 1) % 10, label) AS label
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
y AS (SELECT r, vec_id, label, len(embedding) AS n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM x),
bad AS (SELECT DISTINCT r FROM y WHERE x IS NULL OR NOT isfinite(x)),
v AS (SELECT r, vec_id, label, n, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS z FROM y WHERE r NOT IN (SELECT r FROM bad)),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id AS vec_id, a.label = c.label AS same, CAST(sum(a.z * c.z) AS BIGINT) AS score
      FROM v a JOIN v c ON a.i = c.i AND a.n = c.n AND a.r <> c.r WHERE a.vec_id % 100 = 0 GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, cr) AS k FROM s WHERE same QUALIFY k <= 5),
w AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY s.score DESC, s.vec_id, s.cr) AS k
      FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND CAST(80 AS HUGEINT) * p.score <= CAST(100 AS HUGEINT) * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM w WHERE k <= 5"""
