"""Sliced row numbering equals a plain window, on random data."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerweave import session
from ledgerweave.operators import numbering


@pytest.mark.parametrize("seed,block,hot", [(1, 2, 10 ** 6), (2, 3, 5), (3, 7, 0), (4, 1 << 20, 40)])
def test_ordered_row_number_equals_window(spark, seed, block, hot):
    rnd = random.Random(seed)
    rows = []
    for _ in range(600):
        k = rnd.choice(["a", "b", "hot", "hot", "hot", ""])      # '' is the NULL-key surrogate
        seq = None if rnd.random() < 0.05 else rnd.randint(-20, 60)
        rows.append((rnd.choice([1, 2]), k, seq, rnd.choice(["1", "2"]), rnd.randint(0, 10 ** 6)))
    df = spark.createDataFrame(rows, "p int, k string, seq long, nat string, tie long")
    order = [F.col("seq").asc_nulls_first(), F.col("nat"), F.col("tie")]
    df = session.materialize(df)
    got = numbering.ordered_row_number(df, ["p", "k"], ["seq", "nat", "tie"], block, "rn", hot)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("p", "k").orderBy(*order)).cast("long"))
    cols = ["p", "k", "seq", "nat", "tie", "rn"]
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == \
        sorted(map(tuple, want.select(cols).collect()), key=repr)


def bounds_of(spark, rows, block):
    """{key: bounds} and the rows of each (key, slice)."""
    df = session.materialize(spark.createDataFrame(rows, "k string, seq long").repartition(4))
    per_key = numbering.key_rows(df, ["k"])
    bounds = numbering.slice_bounds(df, per_key.where(F.col(numbering.KEY_ROWS) > block), ["k"], "seq", block)
    sliced = numbering.with_slices(df, bounds, ["k"], "seq").collect()
    count = {}
    for r in sliced:
        count.setdefault((r.k, r[numbering.SLICE]), []).append(r.seq)
    return {r.k: r[numbering.BOUNDS] for r in bounds.collect()}, count


@pytest.mark.parametrize("values", ["dense", "sparse", "clustered"])
def test_slices_follow_the_data(spark, values):
    """However the values lie, a key of many distinct values is cut into about rows / block slices of about block rows."""
    rnd = random.Random(values)
    n, block = 20000, 500
    seq = {"dense": range(n), "sparse": [rnd.randint(-10 ** 15, 10 ** 15) for _ in range(n)],
           "clustered": [i if i % 10 else 10 ** 12 + i * 7919 for i in range(n)]}[values]
    bounds, count = bounds_of(spark, [("big", s) for s in seq] + [("small", s) for s in range(400)], block)
    assert set(bounds) == {"big"} and bounds["big"] == sorted(set(bounds["big"]))
    sizes = [len(v) for (k, _), v in count.items() if k == "big"]
    assert len(sizes) == n // block and max(sizes) <= 1.2 * block and min(sizes) >= 0.8 * block
    assert count["small", 0] and len([1 for k, _ in count if k == "small"]) == 1
    spans = sorted((min(v), max(v)) for (k, _), v in count.items() if k == "big")
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))           # slices do not overlap


def test_only_ties_stay_together(spark):
    rows = [("a", 5)] * 3000 + [("a", v) for v in range(1000, 3000)] + [("n", None)] * 900 + [("n", 1)] * 2 + [("only", None)] * 800
    _, count = bounds_of(spark, rows, 100)
    assert all(len(set(v)) == 1 for v in count.values() if len(v) > 150)
    assert sorted(map(len, (v for (k, _), v in count.items() if k != "a"))) == [2, 800, 900]


def test_block_must_split(spark):
    with pytest.raises(ValueError):
        numbering.slice_bounds(spark.range(1), spark.range(1), ["id"], "id", 1)


def test_usual_days_have_no_slices(spark):
    """Without a key above the block the plan is one window, with ties only among large keys' slices the hot branch."""
    df = session.materialize(spark.createDataFrame([("a", 1, 1)] * 30 + [("b", i, 1) for i in range(30)], "k string, seq long, tie long"))
    windows = lambda block, hot: numbering.ordered_row_number(df, ["k"], ["seq", "tie"], block, "rn", hot)._jdf.queryExecution().optimizedPlan().toString().count("Window [")
    assert windows(100, 400) == 1 and windows(10, 40) < windows(10, 20)


@pytest.mark.parametrize("seed", [5, 6])
def test_copies(spark, seed):
    """One key holding most rows, most of them identical: the slice is cut down to equal rows."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(900):
        if rnd.random() < 0.6:
            rows.append((1, "hot", 5, "1", 0, None))                 # identical copies
        else:
            rows.append((rnd.choice([1, 2]), rnd.choice(["a", "hot", ""]), rnd.choice([None, 1, 5, 9]),
                         rnd.choice(["1", "2", None]), rnd.randint(0, 3), rnd.choice([None, 1])))
    df = session.materialize(spark.createDataFrame(rows, "p int, k string, seq long, nat string, tie long, more int").repartition(5))
    order = ["seq", "nat", "tie", "more"]
    got = numbering.ordered_row_number(df, ["p", "k"], order, 10, "rn", 20)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("p", "k").orderBy(*[F.col(c).asc_nulls_first() for c in order])).cast("long"))
    cols = ["p", "k", *order, "rn"]
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(map(tuple, want.select(cols).collect()), key=repr)
