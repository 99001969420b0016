"""Registry operators: keyed replace, master lookup, sub-report discovery."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions.columns import parse_tag, source_from_name
from ledgerweave.sources.tables import query_source


def keyed_replace(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DELETE by key then INSERT (S14, S15): rows of ``current`` whose key is not in
    ``incoming``, plus all of ``incoming``.  Idempotent: applying it twice equals once.

    Both sides are hash-partitioned on the keys by the anti join; nothing is
    collected.  Keys compare null-safely, as a MERGE on nullable keys should not
    duplicate rows.
    """
    cond = [current[k].eqNullSafe(incoming[k]) for k in keys]
    kept = current.join(incoming.select(*keys), cond, "left_anti")
    return kept.unionByName(incoming.select(*current.columns))


def registry_join(document: DataFrame, master: DataFrame) -> DataFrame:
    """Document settings joined to their master row on (id, product name)."""
    m = master.select("ID_PRODUCTO_DATOS", "NOMBRE_PRODUCTO_DATOS", "QUERY", "TAG_NEGOCIO")
    return document.join(m, ["ID_PRODUCTO_DATOS", "NOMBRE_PRODUCTO_DATOS"])


def master_lookup(document: DataFrame, master: DataFrame, report_name: str) -> DataFrame:
    """The active master report of that name, at most one row.

    ``LIMIT 1`` without order is made deterministic by ordering on the id.
    The business tag is parsed; malformed JSON gives NULL fields (F12), and
    the source system is taken from the name (F11).
    """
    j = registry_join(document, master).where(
        (F.col("FLAG_ACTIVO") == F.lit(True)) & (F.col("NOMBRE_REPORTE") == F.lit(report_name)))
    return (j.orderBy("ID_PRODUCTO_DATOS").limit(1)
            .withColumn("tag", parse_tag("TAG_NEGOCIO"))
            .withColumn("fuente", source_from_name("NOMBRE_REPORTE")))


def subreport_discovery(spark: SparkSession, document: DataFrame, master: DataFrame, stored_sql: str,
                        params: Mapping[str, object]) -> DataFrame:
    """Run the discovery query stored in the master row over the registry views."""
    document.createOrReplaceTempView("report_document")
    master.createOrReplaceTempView("report_master")
    return query_source(spark, stored_sql, params).withColumn("tag", parse_tag("TAG_NEGOCIO"))


def subreports(document: DataFrame, master: DataFrame, product: str, source: str) -> DataFrame:
    """The same discovery as a DataFrame expression (P14, O3): active, product, name
    contains the source (case-insensitive), not the bundle; ordered by name.
    A NULL extension drops the row, as ``!=`` does in SQL."""
    j = document.join(master.select("ID_PRODUCTO_DATOS", "NOMBRE_PRODUCTO_DATOS",
                                    F.col("QUERY").alias("SQL_SUBREPORTE"), "TAG_NEGOCIO"),
                      ["ID_PRODUCTO_DATOS", "NOMBRE_PRODUCTO_DATOS"])
    return (j.where((F.col("FLAG_ACTIVO") == F.lit(True))
                    & (F.col("NOMBRE_PRODUCTO_DATOS") == F.lit(product))
                    & F.upper(F.col("NOMBRE_REPORTE")).like(f"%{source.upper()}%")
                    & (F.col("EXTENSION") != F.lit("zip")))
            .orderBy("NOMBRE_REPORTE"))
