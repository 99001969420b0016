"""Scale-safety helpers: thin-input spreading, the shared checkpoint folder, work-table cleanup."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerweave import session
from ledgerweave.sources.tables import spread


def test_spread_only_thin_inputs(spark):
    thin = spark.range(100).coalesce(1)
    wide = spark.range(1000).repartition(32)
    assert spread(thin, 8).rdd.getNumPartitions() == 8
    assert spread(wide, 8) is wide                      # enough splits: no extra shuffle


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master)
        self.conf = _Conf(conf)


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session("yarn", {}))


def test_cluster_checkpoint_dir_is_used_as_is():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert session.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def _exists(path):
    return os.path.exists(path.replace("file:", ""))


def test_owned_blocks_release_their_own(spark):
    """Two interleaved runs and a failing one: each deletes what it made, and nothing of the others."""
    started, finish, seen = threading.Event(), threading.Event(), {}

    def other():
        with session.owned(spark) as o:
            df = session.materialize(spark.range(7), "other")
            seen["path"] = o.tables[0]
            started.set()
            finish.wait(60)
            seen["rows"] = df.count()

    t = threading.Thread(target=other)
    t.start()
    assert started.wait(60)
    with pytest.raises(ValueError):
        with session.owned(spark) as o:
            df = session.materialize(spark.range(10), "t")
            kept = session.keep(spark.range(5))
            mine = o.tables[0]
            assert df.count() == 10 and kept.count() == 5 and _exists(mine)
            raise ValueError("the run fails")
    assert not _exists(mine) and _exists(seen["path"]) and not kept.is_cached
    finish.set()
    t.join()
    assert seen["rows"] == 7 and not _exists(seen["path"])


def test_byte_limit_of_broadcasts(spark):
    from ledgerweave.operators.joins import broadcast_if_small, value_bytes
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "t string, n long")
    assert value_bytes(df) == 2 * (16 + 8) + 1000
    plan = lambda d: spark.range(9).join(d, F.col("id") == F.col("n"))._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(df, 2000)) and "broadcast" not in plan(broadcast_if_small(df, 1000))
