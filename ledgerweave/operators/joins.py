"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df`` (texts by length, other values 8 each, 16 a row): one small aggregation."""
    size = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f.name)
        size = size + (F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(8))
    return int(df.agg(F.sum(size.cast("long"))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """Mark ``df`` for broadcast when its values take at most ``max_bytes``.

    The check runs on the small side only (a dimension or an aggregate with
    one row per period).  Beyond the limit the join is left to the planner:
    sort-merge with AQE's skew-join split, so nothing unbounded is copied to
    every executor.
    """
    return F.broadcast(df) if value_bytes(df) <= max_bytes else df
