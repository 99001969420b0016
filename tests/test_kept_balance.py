"""The kept balance equals the full computation after any updates, and an update reads the prefixes it touches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

import oracle_harness as H
from conftest import SF0001
from ledgerweave import catalog
from ledgerweave.operators import balance
from ledgerweave.operators.kept_balance import KeptBalance
from ledgerweave.oracles import ORACLE
from ledgerweave.sources import versioned

DAYS = [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
COUNTS = "periodo date, codigo_transaccion string, total_registros long"


def code(rnd):
    return None if rnd.random() < 0.03 else f"AK2024010{rnd.randint(1, 4)}2024010{rnd.randint(1, 9)}{rnd.randint(0, 60):04d}1"[:rnd.choice([25, 25, 25, 9, 14])]


def frame(spark, total):
    return spark.createDataFrame([(d, c, n) for (d, c), n in total.items()], COUNTS)


def full(spark, total, limit, width):
    counts = {k: n for k, n in total.items() if n > 0}
    return sorted(map(tuple, balance.assign_groups(frame(spark, counts), ["periodo"], balance.CODE, limit, None, width).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_full_computation(spark, tmp_path, seed):
    rnd = random.Random(seed)
    limit, width = rnd.choice([(5, 20), (30, 30), (1, 7)])
    kept = KeptBalance(spark, str(tmp_path / "k"), limit, width)
    total = {}
    for step in range(4):
        change = {}
        for _ in range(rnd.choice([400, 15, 3]) if step else 300):
            k = (rnd.choice(DAYS), code(rnd))
            change[k] = change.get(k, 0) + rnd.randint(1, 9)
        if step == 2:       # lines taken away, some codes altogether
            change = {k: -rnd.choice([1, n]) for k, n in rnd.sample(sorted(total.items(), key=repr), 30)}
        for k, n in change.items():
            total[k] = total.get(k, 0) + n
        if step:
            touched = kept.update(frame(spark, change))
            assert set(touched) == {(d, "p" + (c or "")[:10]) for d, c in change}
        else:
            kept.build(frame(spark, change))
        total = {k: n for k, n in total.items() if n > 0}
        got = sorted(map(tuple, kept.groups().collect()), key=repr)
        assert got == full(spark, total, limit, width)
    one = sorted(map(tuple, kept.groups([DAYS[0]]).collect()), key=repr)
    assert one == [r for r in got if r[0] == DAYS[0]]


def leaf_files(root):
    return {os.path.join(f, n) for f, _, names in os.walk(root) for n in names if n.endswith(".parquet") and "leaves-" in f}


def test_only_touched_prefixes_are_read(spark, tmp_path):
    root = str(tmp_path / "k")
    total = {(DAYS[0], f"AK2024010{p}20240101{i:04d}1"): 3 for p in range(1, 6) for i in range(4)}
    kept = KeptBalance(spark, root, 10, 10)
    kept.build(frame(spark, total))
    held = {f: open(f, "rb").read() for f in leaf_files(root)}
    for f in held:      # every leaf but one prefix's is broken while the update runs
        if "AK20240102" not in f:
            with open(f, "wb") as out:
                out.write(b"broken")
    for f, _, names in os.walk(root):
        for n in names:
            if n.endswith(".crc"):
                os.unlink(os.path.join(f, n))
    late = {(DAYS[0], "AK20240102202401010000" + "1"): 20}
    assert kept.update(frame(spark, late)) == [(DAYS[0], "pAK20240102")]
    for f, data in held.items():
        with open(f, "wb") as out:
            out.write(data)
    for k, n in late.items():
        total[k] = total.get(k, 0) + n
    assert sorted(map(tuple, kept.groups().collect()), key=repr) == full(spark, total, 10, 10)
    new = leaf_files(root) - set(held)
    assert new and all("AK20240102" in f for f in new)


def test_a_writer_that_comes_second_starts_again(spark, tmp_path, monkeypatch):
    total = {(DAYS[0], f"AK202401012024010{i}00011"): 2 for i in range(1, 5)}
    kept, other = (KeptBalance(spark, str(tmp_path / "k"), 3, 6) for _ in range(2))
    kept.build(frame(spark, total))
    commit, calls = versioned.VersionedTable.commit, []

    def late(self, df, base, note=""):
        if not calls:       # another update commits between this one's read and its commit
            calls.append(1)
            other.update(frame(spark, {(DAYS[0], "AK20240101202401010001" + "1"): 5}))
        return commit(self, df, base, note)

    monkeypatch.setattr(versioned.VersionedTable, "commit", late)
    kept.update(frame(spark, {(DAYS[0], "AK20240101202401020001" + "1"): 1}))
    total[(DAYS[0], "AK20240101202401010001" + "1")] += 5
    total[(DAYS[0], "AK20240101202401020001" + "1")] += 1
    assert sorted(map(tuple, kept.groups().collect()), key=repr) == full(spark, total, 3, 6)


def test_key(spark, duck0001):
    r = H.compare(spark, SF0001, catalog.QUERIES["balance_kept"], ORACLE["balance_kept"], duck0001)
    assert r["ok"], r


def test_unknown_days(spark, tmp_path):
    kept = KeptBalance(spark, str(tmp_path / "k"), 3)
    kept.build(frame(spark, {(DAYS[0], "AK1"): 2}))
    assert kept.groups([]).count() == 0 and kept.groups([DAYS[1]]).count() == 0
    kept.update(frame(spark, {(DAYS[1], "AK1"): 2}))
    assert kept.groups().where(F.col("grupo_salida") == 1).count() == 2


def test_late_lines_are_summed_once(spark, tmp_path):
    """an update computes the late lines once, moves its leaves' rows once, and leaves no work table."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        read.add(1)
        return n

    kept = KeptBalance(spark, str(tmp_path / "k"), 3, 6)
    total = {(DAYS[0], f"AK202401012024010{i}00011"): 2 for i in range(1, 9)}
    kept.build(frame(spark, total))
    late = {(DAYS[0], f"AK202401022024010{i}00011"): 1 for i in range(1, 6)}
    kept.update(frame(spark, late).withColumn("total_registros", counted("total_registros")))
    assert read.value == len(late)
    assert sorted(map(tuple, kept.groups().collect()), key=repr) == full(spark, total | late, 3, 6)
    assert not [n for n in os.listdir(kept.root) if n.startswith("late-")]
    counts = kept._by_leaf(kept._prefixed(frame(spark, total)))
    sums = balance.prefix_running_sums(counts, ["periodo", "prefijo"], balance.CODE, (), {"n": F.col("total_registros")})
    assert sums._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
