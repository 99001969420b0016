"""What the operators share: table reading, work tables in the shared folder, bounded bit filters, components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.session import owner


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a scratch folder only in local mode without one."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="llm-work-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def written(df: DataFrame, name: str) -> str:
    """Path of a work table in the shared folder, written from ``df``; inside ``session.owned`` it goes at the end of that block."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if own := owner():
        own.tables.append(path)
    df.write.parquet(path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a work table and read it back: cuts lineage, survives lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of the same cluster with the settings of ``spark`` and some of its own, which no other job gets."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def release() -> None:
    """Give memory that is free back to the system: a Python worker outlives its task and would keep it."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def freed(work):
    """``work`` (iterator of batches -> iterator of batches) that releases its memory when it ends."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            release()
    return run


#: Bits of a membership filter: a fixed size, so its broadcast is bounded whatever the data.
FILTER_BITS = 1 << 25


class KeyFilter:
    """Fixed-size bit filter over 64-bit keys: no false negatives; false positives only cost extra work."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    def has(self, keys: np.ndarray) -> np.ndarray:
        p = keys.astype(np.int64, copy=False).view(np.uint64) % np.uint64(self.size)
        return (self.bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0


def key_filter(df: DataFrame, key: str, size: int = FILTER_BITS) -> KeyFilter:
    """A ``KeyFilter`` of a long column, built with the bitmap aggregates; at most size/8 bytes reach the driver."""
    p = F.expr(f"cast(pmod({key}, {size}) as long)") if size & (size - 1) else F.col(key).bitwiseAND(F.lit(size - 1))
    rows = (df.where(F.col(key).isNotNull()).select(p.alias("p"))
            .groupBy(F.expr("p div 32768").alias("b"))
            .agg(F.expr("bitmap_construct_agg(p % 32768)").alias("m")).toLocalIterator())
    bits = np.zeros(size // 8, np.uint8)
    for r in rows:
        bits[r.b * 4096:r.b * 4096 + 4096] |= np.frombuffer(bytes(r.m), np.uint8)
    return KeyFilter(bits, size)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: (node, label), label = smallest node of the component.

    Every node hooks onto its smallest neighbour if that is smaller; following these pointers (log n hops) leads to a
    root.  Then edges are drawn between roots only, and it starts again until none is left, so the edges of a large
    group are gone after one round.  Every step is a written table; only one row comes back to the driver.
    Nodes without edges do not appear.
    """
    x, y = F.col(a), F.col(b)
    e = saved(edges.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).where("x <> y").distinct(), "edges")
    label = None
    while label is None or e.limit(1).count():
        ends = e.select(F.col("x").alias("node"), F.col("y").alias("other")).unionByName(e.select(F.col("y").alias("node"), F.col("x").alias("other")))
        up = saved(ends.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "hooks")
        while True:
            hop = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            step = saved(up.join(hop, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "hops")
            up = step.select("node", "root")
            if not step.where("moved").limit(1).count():
                break
        if label is None:
            label = up.select("node", F.col("root").alias("label"))
        else:
            label = saved(label.join(up.select(F.col("node").alias("label"), "root"), "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")
        p, q = up.select(F.col("node").alias("x"), F.col("root").alias("rx")), up.select(F.col("node").alias("y"), F.col("root").alias("ry"))
        e = saved(e.join(p, "x").join(q, "y").where("rx <> ry").select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).distinct(), "edges")
    return label
