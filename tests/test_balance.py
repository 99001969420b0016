"""Two-level prefix-sum balancing equals the reference's plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerweave.operators import balance
from conftest import SF001


def plain_groups(counts, keys, code, limit, width):
    """The reference formulation: DENSE_RANK and running SUM over every code of a key."""
    large = F.col("total_registros") > limit
    w = Window.partitionBy(*keys).orderBy(F.col(code).asc_nulls_first()) if keys else \
        Window.orderBy(F.col(code).asc_nulls_first())
    big = counts.where(large).withColumn("grupo_salida", F.dense_rank().over(w).cast("long"))
    nbig = big.groupBy(*keys).agg(F.max("grupo_salida").alias("m")) if keys else \
        big.agg(F.max("grupo_salida").alias("m"))
    small = counts.where(~large)
    if keys:
        small = small.join(nbig, list(keys), "left")
    else:                                  # one global maximum: a literal, no join
        small = small.withColumn("m", F.lit(nbig.first()["m"]).cast("long"))
    small = small.withColumn("grupo_salida", (F.coalesce("m", F.lit(0)) + F.floor(
        (F.sum("total_registros").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1) / width) + 1)
        .cast("long")).drop("m")
    return big.unionByName(small)


@pytest.mark.parametrize("seed,bucket_len,limit,width", [(1, 1, 5, 7), (2, 3, 9, 9), (3, 6, 3, 100), (4, None, 4, 4),
                                                         (5, (1, 3), 5, 7), (6, (2, 4, 6), 3, 11)])
def test_prefix_levels_equal_plain(spark, seed, bucket_len, limit, width):
    rnd = random.Random(seed)
    rows = set()
    for _ in range(300):
        code = None if rnd.random() < 0.01 else "".join(rnd.choice("0123") for _ in range(rnd.randint(1, 7)))
        rows.add((rnd.choice(["2024-01-01", "2024-01-02"]), code))
    data = [(p, c, rnd.randint(1, 12)) for p, c in rows]
    counts = spark.createDataFrame(data, "periodo string, code string, total_registros long")
    got = balance.assign_groups(counts, ["periodo"], "code", limit, bucket_len, width)
    want = plain_groups(counts, ["periodo"], "code", limit, width)
    cols = ["periodo", "code", "total_registros", "grupo_salida"]
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == \
        sorted(map(tuple, want.select(cols).collect()), key=repr)


def test_month_balance_checked_values(spark):
    """FIXTURES §3: balance of lineitem by ship month, limit 750."""
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(F.date_format("l_shipdate", "yyyy-MM").alias("mes"))
    g = balance.assign_groups(balance.transaction_counts(li, [], "mes"), [], "mes", 750, 4)
    assert g.count() == 83
    assert g.select("grupo_salida").distinct().count() == 80
    per_group = g.groupBy("grupo_salida").agg(F.sum("total_registros").alias("n"), F.max("total_registros").alias("mx"))
    small_bins = per_group.where(F.col("mx") <= 750)
    assert small_bins.agg(F.max("n")).first()[0] == 1429


def test_small_bins_are_contiguous_after_large(spark):
    data = [("d", f"c{i:03d}", n) for i, n in enumerate([1, 9, 2, 2, 20, 3, 3, 3, 30, 1])]
    counts = spark.createDataFrame(data, "periodo string, code string, total_registros long")
    g = balance.assign_groups(counts, ["periodo"], "code", 8, None, 5)
    rows = {r["code"]: r["grupo_salida"] for r in g.collect()}
    large = sorted(rows[c] for c, n in [(d[1], d[2]) for d in data] if n > 8)
    small = sorted({rows[c] for c, n in [(d[1], d[2]) for d in data] if n <= 8})
    assert large == [1, 2, 3]
    assert small == list(range(4, 4 + len(small)))


def test_rows_are_moved_once_for_all_levels(spark):
    """The totals above the finest level come from kept rows per bucket, not from the codes' window again."""
    counts = spark.createDataFrame([(1, f"AK{d:08d}{p:08d}{n:04d}1", n) for d in range(3) for p in range(3) for n in range(1, 5)], "k int, code string, n long")
    out = balance.prefix_running_sums(counts, ["k"], "code", (10, 18), {"n": F.col("n")})
    want, total = {}, 0
    for r in sorted(counts.collect(), key=lambda r: r.code):
        total += r.n
        want[r.code] = total
    assert {r.code: r._run_n for r in out.collect()} == want and {r._all_n for r in out.collect()} == {total}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("windowspecdefinition(k") == 4    # codes, finest buckets, top buckets and their sum
