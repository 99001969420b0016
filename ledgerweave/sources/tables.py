"""Table scans and the query-text source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores.

    A table stored as a few large files with one row group each is read by a
    few tasks, and everything up to the first shuffle runs on those tasks.
    A large table has far more splits than cores and is left untouched, so
    this adds a shuffle only where the input is too thin to use the cluster.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Temp views so report SQL can be run with ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query_source(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Query text as a source: ``spark.sql`` with named parameter markers.

    The reference splices dates into stored SQL text; here values are bound as
    ``:name`` parameters, so no text substitution and no quoting bugs.
    """
    return spark.sql(sql, args=dict(args or {}))


def period_predicate(col: str | Column, periods: Iterable[dt.date] | None) -> Column | None:
    """``periodo IN (...)`` on the partition column, or ``None`` for all periods.

    On a table written with ``partitionBy("periodo")`` this becomes a
    partition filter (only the named folders are listed and read).
    """
    if periods is None:
        return None
    c = F.col(col) if isinstance(col, str) else col
    values = [F.lit(p).cast("date") for p in periods]
    return c.isin(*values) if values else F.lit(False)


def scan_partitioned(spark: SparkSession, path: str, periods: Iterable[dt.date] | None = None,
                     partition_col: str = "periodo") -> DataFrame:
    """Scan of a table written partitioned by date, pruned to ``periods``."""
    df = spark.read.parquet(path)
    pred = period_predicate(partition_col, periods)
    return df if pred is None else df.where(pred)
