"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import contextvars
import datetime as dt
import os
import tempfile
import uuid
import zipfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: Setting of Spark by which a job's shuffle files go with the job, not with the garbage collection of the driver.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Work tables are read a few times and deleted: the smaller codec is worth its time.
COMPRESSION = "zstd"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerweave") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is; a cluster without one is an error.  Only a
    local-mode session (tests, bench) with none set gets a scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
        current = tempfile.mkdtemp(prefix="ledgerweave-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors (once a session), so that Python tasks can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerweave_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerweave-src-"), "ledgerweave.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.join("ledgerweave", os.path.relpath(f, here)))
    sc.addPyFile(path)
    sc._ledgerweave_shipped = True


def now(spark: SparkSession) -> dt.datetime:
    """The time in the session's time zone, without fractions: what file times are compared with."""
    return spark.sql("SELECT CAST(date_trunc('second', current_timestamp()) AS timestamp_ntz) AS t").first()["t"]


def work_dir(spark: SparkSession, name: str) -> str:
    """A folder for written work tables or exports, under the shared checkpoint folder."""
    root = spark.conf.get("ledgerweave.work.dir", None) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}"


class Owned:
    """Work tables and persisted frames of one run; ``release`` deletes its own and nothing else."""

    def __init__(self, spark: SparkSession, tables: list[str] | None = None):
        self.spark, self.tables, self.frames = spark, list(tables or ()), []

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()
        conf = self.spark._jsc.hadoopConfiguration()
        while self.tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.tables.pop())
            path.getFileSystem(conf).delete(path, True)


_OWNER: contextvars.ContextVar[Owned | None] = contextvars.ContextVar("ledgerweave_owner", default=None)


def owner() -> Owned | None:
    """The owner of the work tables made here and now, if there is one."""
    return _OWNER.get()


@contextlib.contextmanager
def owned(spark: SparkSession):
    """What ``materialize`` and ``keep`` make inside belongs to this block and goes at its end, also after a failure.

    Frames that read the work tables must have been written by then.  Runs in other threads have owners of their own.
    """
    own = Owned(spark)
    token = _OWNER.set(own)
    try:
        yield own
    finally:
        _OWNER.reset(token)
        own.release()


def freeing(df: DataFrame) -> DataFrame:
    """``df`` in a session of its own, whose jobs delete their shuffle files when they end.

    For frames that are written: what the write has made is read from then on, so nothing needs the shuffles any more.  The session has the
    settings of the caller's, and no other job gets the one it adds.
    """
    spark = df.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(SHUFFLE_CLEANUP, "true")
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, df._jdf.logicalPlan()), own)


@contextlib.contextmanager
def active(own: SparkSession):
    """``own`` as this thread's active session, in which Spark looks a sink up by its name."""
    sessions = own._jvm.org.apache.spark.sql.classic.SparkSession
    before = sessions.getActiveSession()
    sessions.setActiveSession(own._jsparkSession)
    try:
        yield
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
        else:
            sessions.clearActiveSession()


def written(df: DataFrame, name: str) -> str:
    """Path of a parquet work table in the shared folder, written from ``df``; each call writes a new folder."""
    path = work_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    if own := owner():
        own.tables.append(path)
    freeing(df).write.mode("error").option("compression", COMPRESSION).parquet(path)
    return path


def discard(table: DataFrame) -> None:
    """Delete a work table (a frame that ``materialize`` has returned) before its owner does."""
    path, spark = table._work_path, table.sparkSession
    if (own := owner()) and path in own.tables:
        own.tables.remove(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, name: str = "work"):
    """Cut lineage: write ``df`` as a parquet work table in the shared folder and read it back.

    The reference materialises each stage as a work table; here one table
    holds the coded lines that feed several branches (the numbered lines and
    two count tables).  Parquet keeps the read-back columnar, so a branch that
    needs three columns reads three columns, and a lost executor does not send
    the job back to the source scan.  Each call writes a new folder.
    """
    path = written(df, name)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._work_path = path
    return table


def keep(df):
    """Persist a small intermediate that feeds several branches (memory, spilling to disk).

    A lost block is recomputed from its lineage (a work table).
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if own := owner():
        own.frames.append(df)
    return df
