"""What the files of a partitioned table say without being read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def partition_files(spark: SparkSession, path: str, column: str = "periodo") -> DataFrame:
    """(periodo, archivos, bytes, modificado) of each day of a table written with ``partitionBy(column)``.

    Only the listing is used, which Spark does in parallel for many folders: day from the folder's name, size and time of each file.
    No file is opened.  Folders of other names, and days that are no dates, are not days.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .select("path", "modificationTime", "length"))
    day = F.expr(f"try_cast(nullif(regexp_extract(path, '/{column}=([^/]+)/', 1), '') as date)")
    return (files.withColumn("periodo", day).where("periodo is not null").groupBy("periodo")
            .agg(F.count(F.lit(1)).alias("archivos"), F.sum("length").alias("bytes"), F.max("modificationTime").cast("timestamp_ntz").alias("modificado")))
