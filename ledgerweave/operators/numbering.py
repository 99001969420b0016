"""Skew-safe ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)``.

A plain window sends every row of one key to one task; a transaction holding
a third of the day would be sorted by one core.  Here keys of at most ``block`` rows
are numbered by the plain window, and larger ones are cut into *slices* of about ``block`` rows
by bounds of their own: quantiles of the first ordering column, from a mergeable sketch (KLL) of the key's rows.
A bound cuts between values, so slices follow the data (sparse, dense or clustered values alike) and only rows that share one value stay together.
Rows are numbered inside (key, slice) in parallel; per-slice row counts (one small row per slice) give
each slice its offset, the count of rows of the same key in earlier slices.
``row_number = local number + offset`` equals the plain window exactly,
because every row of an earlier slice sorts before every row of a later one.

The row counts per key, one aggregation, say which keys are larger; without any (the usual day) there are no slices and the plan is the
plain window.  A slice is larger than ``hot_rows`` only by true ties (copies, or many rows without a value);
its rows are cut further, see ``hot_numbers``, and without such slices that branch is not planned.  All plans give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.operators.joins import broadcast_if_small
from ledgerweave.session import discard, materialize, written

SLICE = "_slice"
LOCAL_RN = "_rn_local"
KEY_ROWS = "_key_rows"
SLICE_ROWS = "_slice_rows"
SLICE_OFFSET = "_slice_offset"
BOUNDS = "_bounds"
# Rows without a value sort first.
NULL_SLICE = -1
# Size of a sketch: its rank error is about 2.3 / k, 0.03 % of a key's rows; some hundred kilobytes, for keys above a block only.
SKETCH = 8192
# Bounds of a key at most (a key of more blocks has larger slices).
MOST_BOUNDS = 8192
# Bounds are broadcast up to this many bytes; beyond, they meet the rows by a join that splits skewed keys.
BROADCAST_BYTES = 8 << 20
# Rows that are moved and numbered at once; a larger table is numbered in passes over its keys, as the shuffle of a job stays on disk until it ends.
PASS_ROWS = 1 << 23
# A pass reads the whole table (and moves its part of it).
MOST_PASSES = 16


def key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, KEY_ROWS): rows of each key, combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(KEY_ROWS))


def slice_bounds(df: DataFrame, large: DataFrame, keys: Sequence[str], order_col: str, block: int) -> DataFrame:
    """(keys, BOUNDS): for each key of ``large`` (keys, KEY_ROWS) the values its slices end with, in order.

    One pass over the rows of these keys, whose sketches merge map-side; at most a bound per ``block`` rows.
    """
    if block < 2:
        raise ValueError("block must be at least 2")
    most = large.agg(F.max(KEY_ROWS)).first()[0] or 0
    ranks = min(MOST_BOUNDS, -(-most // block))
    rows = df.join(broadcast_if_small(large.select(*keys, KEY_ROWS), BROADCAST_BYTES), list(keys))
    sketch = rows.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(order_col).cast("long"), F.lit(SKETCH)).alias("_sketch"),
                                     F.first(KEY_ROWS).alias(KEY_ROWS), F.count(order_col).alias("_values"))
    # asked at the ranks of the largest key; a smaller one takes as many of them as it has blocks.  Without any value all rows are ties
    asked = F.kll_sketch_get_quantile_bigint("_sketch", F.array(*[F.lit(i / ranks) for i in range(1, ranks)]).cast("array<double>"))
    sketch = sketch.withColumn(BOUNDS, F.when(F.col("_values") > 0, asked).otherwise(F.array().cast("array<bigint>")))
    part = f"least({ranks}, ceil({KEY_ROWS} / {int(block)}))"
    thinned = F.expr(f"filter({BOUNDS}, (b, i) -> floor((i + 1) * {part} / {ranks}) > floor(i * {part} / {ranks}))")
    return sketch.select(*keys, F.array_sort(F.array_distinct(thinned)).alias(BOUNDS))


def with_slices(df: DataFrame, bounds: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """``df`` with its slice: the number of bounds below the row's value; 0 for keys without bounds."""
    below = F.expr(f"size(filter({BOUNDS}, b -> b < `{order_col}`))")
    slice_ = F.when(F.col(BOUNDS).isNull(), F.lit(0)).when(F.col(order_col).isNull(), F.lit(NULL_SLICE)).otherwise(below)
    return df.join(broadcast_if_small(bounds, BROADCAST_BYTES), list(keys), "left").withColumn(SLICE, slice_.cast("int")).drop(BOUNDS)


def slice_offsets(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, slice, rows, offset): offset = rows of the key in earlier slices.

    The count is aggregated map-side first, so only one row per slice and
    task is shuffled; the window runs on one row per slice.
    """
    counts = sliced.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias(SLICE_ROWS))
    w = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(SLICE_OFFSET, F.coalesce(F.sum(SLICE_ROWS).over(w), F.lit(0)).cast("long"))


def any_row(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def ordered_row_number(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], block: int, out: str,
                       hot_rows: int, used: Sequence[DataFrame] = ()) -> DataFrame:
    """Exact row number per key (``order_cols`` ascending, NULL first).

    ``keys`` must be non-null surrogate columns (NULL keys still form one
    group, as in a window, when mapped to a value no real key takes).
    ``df`` must be a materialised table: it is read several times.  ``used``: see ``numbered_lines``.
    """
    return numbered_lines(df, materialize(key_rows(df, keys), "key_rows"), keys, order_cols, block, out, hot_rows, used=used)


def numbered_lines(df: DataFrame, per_key: DataFrame, keys: Sequence[str], order_cols: Sequence[str], block: int, out: str, hot_rows: int,
                   carried: DataFrame | None = None, used: Sequence[DataFrame] = ()) -> DataFrame:
    """``df`` with ``out``, the row number in its key, and the columns of ``carried`` (a row per key; rows of other keys are dropped).

    ``per_key`` (keys, KEY_ROWS, materialised) says which keys are cut into slices, and how many rows there are: up to PASS_ROWS are numbered
    in the caller's job; more in passes, each over the keys of one hash value, whose rows are stored as a work table.  The work tables
    ``used``, which only the numbering reads, are deleted then.
    """
    spark = df.sparkSession
    passes = min(MOST_PASSES, -(-int(per_key.agg(F.sum(KEY_ROWS)).first()[0] or 0) // PASS_ROWS))
    if passes <= 1:
        return _numbered(df, per_key, keys, order_cols, block, out, hot_rows, carried)
    paths, schema = [], None
    for i in range(passes):
        own = F.pmod(F.xxhash64(*keys), F.lit(passes)) == i
        part = _numbered(df.where(own), per_key.where(own), keys, order_cols, block, out, hot_rows, None if carried is None else carried.where(own))
        paths.append(written(part, "numbered"))
        schema = part.schema
    for table in used:
        discard(table)
    return spark.read.schema(schema).parquet(*paths)


def _numbered(df: DataFrame, per_key: DataFrame, keys: Sequence[str], order_cols: Sequence[str], block: int, out: str, hot_rows: int,
              carried: DataFrame | None) -> DataFrame:
    keys, order = list(keys), [F.col(c).asc_nulls_first() for c in order_cols]
    large = per_key.where(F.col(KEY_ROWS) > block)
    # a row per key is merged, never the rows broadcast to it: their size says little after compression
    with_carried = lambda d: d if carried is None else d.join(carried.hint("merge"), keys)
    if not any_row(large):
        w = Window.partitionBy(*keys).orderBy(*order)
        return with_carried(df.withColumn(out, F.row_number().over(w).cast("long")))
    bounds = materialize(slice_bounds(df, large, keys, order_cols[0], block), "bounds")
    sliced = with_slices(df, bounds, keys, order_cols[0])
    offsets = materialize(slice_offsets(with_slices(df.join(broadcast_if_small(large.select(*keys), BROADCAST_BYTES), keys, "left_semi"), bounds, keys, order_cols[0]), keys), "offsets")
    of_slice = [*keys, SLICE]
    w = Window.partitionBy(*of_slice).orderBy(*order)
    hot = offsets.where(F.col(SLICE_ROWS) > hot_rows).select(*of_slice, SLICE_OFFSET)
    is_hot = any_row(hot)
    rows = sliced.join(broadcast_if_small(hot.drop(SLICE_OFFSET), BROADCAST_BYTES), of_slice, "left_anti") if is_hot else sliced
    cold = rows.withColumn(LOCAL_RN, F.row_number().over(w).cast("long")).join(offsets.select(*of_slice, SLICE_OFFSET).hint("merge"), of_slice, "left")
    if is_hot:
        warm = hot_numbers(sliced.withColumn(TAG, F.monotonically_increasing_id()).join(broadcast_if_small(hot, BROADCAST_BYTES), of_slice), of_slice, order_cols)
        cold = cold.unionByName(warm)
    return with_carried(cold.withColumn(out, F.col(LOCAL_RN) + F.coalesce(F.col(SLICE_OFFSET), F.lit(0))).drop(LOCAL_RN, SLICE_OFFSET, SLICE))


# ---------------------------------------------------------------- rows of hot slices

TAG = "_tag"
PART = "_part"
PARTS = 64


def hot_numbers(rows: DataFrame, keys: Sequence[str], order_cols: Sequence[str], split: int = 3) -> DataFrame:
    """``rows`` (with TAG) plus LOCAL_RN: the exact row number within ``keys``, without a window over all rows of a key.

    Rows equal in every order column are interchangeable, so they are dealt to PARTS parts by their tag and numbered inside
    a part.  The numbers are shifted level by level, each level one aggregation and one window over its own distinct
    values: the parts of equal rows, the distinct rows of one value of the first ``split`` order columns, those values
    within the key.  The tag is stable because the input is a materialised table.
    """
    keys, order = list(keys), list(order_cols)
    head = order[:split]
    rows = rows.withColumn(PART, F.pmod(F.xxhash64(TAG), F.lit(PARTS)))
    counts = rows.groupBy(*keys, *order, PART).agg(F.count(F.lit(1)).alias("_n"))     # combined map-side
    first = lambda cols: [F.col(c).asc_nulls_first() for c in cols]
    before = lambda part, by, v: F.coalesce(F.sum(v).over(Window.partitionBy(*part).orderBy(*first(by)).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    parts = counts.withColumn("_in_copies", before([*keys, *order], [PART], "_n"))
    tuples = counts.groupBy(*keys, *order).agg(F.sum("_n").alias("_n"))
    heads = tuples.groupBy(*keys, *head).agg(F.sum("_n").alias("_n"))
    tuples = tuples.withColumn("_in_head", before([*keys, *head], order[split:], "_n")).drop("_n")
    heads = heads.withColumn("_in_key", before(keys, head, "_n")).drop("_n")

    def joined(left: DataFrame, right: DataFrame, on: Sequence[str], value: str) -> DataFrame:
        r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], value)
        cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in on]
        return left.join(r, cond).drop(*[f"_r_{c}" for c in on])

    shifts = joined(joined(parts.drop("_n"), tuples, [*keys, *order], "_in_head"), heads, [*keys, *head], "_in_key")
    shifts = shifts.withColumn("_shift", F.col("_in_copies") + F.col("_in_head") + F.col("_in_key"))
    w = Window.partitionBy(*keys, *order, PART).orderBy(TAG)
    local = rows.withColumn(LOCAL_RN, F.row_number().over(w).cast("long"))
    out = joined(local, shifts, [*keys, *order, PART], "_shift")
    return out.withColumn(LOCAL_RN, F.col(LOCAL_RN) + F.col("_shift")).drop("_shift", PART, TAG)
