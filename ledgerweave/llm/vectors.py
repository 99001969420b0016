"""Vector columns: which take part, and top-k merging (helpers of two searches)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def usable(df: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, v array<double>, row, n) of the rows that take part in a search; ``row`` is each row's own, n its length.

    Out are: null ids; vectors that are null, empty, or hold null or non-finite components; zero vectors unless ``zero``.
    Every row is a row of its own, repeated rows too.  Vectors of different length have no distance or product and do not meet.
    The result has to be written before it is read twice, as ``row`` comes from its order.
    """
    v = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and size(v) > 0")
    v = v.where(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    if not zero:
        v = v.where(F.exists("v", lambda x: x != 0))
    return v.select("vec_id", "v", F.monotonically_increasing_id().alias("row"), F.size("v").alias("n"))


def matrix(col) -> np.ndarray:
    """A list column as a matrix."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy().reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def best(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    """The k best rows (query_id, query_row, vec_id, score) of each query row with their rank, ties to the smaller vec_id."""
    w = Window.partitionBy("query_id", "query_row").orderBy(F.col("score") if ascending else F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
