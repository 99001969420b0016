"""Input tables of the feed, derived from the driver's TPC-H-ish tables (FIXTURES.md §2).

The reference reads a movements table, an account-mapping table and a run
log.  The test data has none of them, so they are views over ``lineitem``,
``orders``, ``part`` and ``events``; the work grows with those tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.params import MAPPED_FIELD, FeedParams
from ledgerweave.sources import registry
from ledgerweave.sources.tables import read_table, spread

AMOUNT = "decimal(18,2)"
# Neutral names of the fixture's source system, ledger book and master report.
SOURCE = "SOURCEA"
BOOK = "BOOK_A"
MASTER_NAME = f"GENERAR_FAH_{SOURCE}_COMPLETO_ZIP"


def feed_params(**settings) -> FeedParams:
    """Parameters of a run over the fixture tables."""
    return FeedParams(source=SOURCE, book=BOOK, **settings)


# Column order of the source movements table as the reference selects it.
MOVEMENT_COLUMNS = [
    "FECHA_EFECTIVA", "FECHA_POSTEO", "CTACON", "MONEDA", "CTRCTO", "CONSECUTIVO",
    "DESCRIPCION", "VLRDEB", "VLRCRE", "PERIODO", "CONSECUTIVO_EXTRACCION",
]


def registered(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(report_master, report_document) of the fixture's source, registered on a fixed day."""
    return registry.registry_frames(spark, SOURCE, dt.date(2026, 1, 1))


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source ledger movements, one row per entry, debit and credit apart.

    lineitem joins orders on the order key (a sort-merge join at scale; the
    key is unique in orders so it is not skewed).  Upper-case names as in the
    source table.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"))
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    flag = F.col("l_returnflag")
    price = F.col("l_extendedprice").cast(AMOUNT)
    order_date = F.col("o_orderdate").cast("date")
    return j.select(
        order_date.alias("FECHA_EFECTIVA"),
        # some movements have no posting date, so their lines have no code
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_shipdate").cast("date")).alias("FECHA_POSTEO"),
        F.col("l_partkey").alias("CTACON"),
        F.col("l_linestatus").alias("MONEDA"),
        F.col("l_suppkey").alias("CTRCTO"),
        F.col("l_orderkey").alias("CONSECUTIVO"),
        F.col("o_orderpriority").alias("DESCRIPCION"),
        F.when(flag.isin("R", "A"), price).alias("VLRDEB"),
        F.when(flag == "N", price)
        .when(flag == "A", F.round(F.col("l_discount") * 100).cast(AMOUNT))
        .when(flag == "R", F.lit(0).cast(AMOUNT)).alias("VLRCRE"),
        F.trunc(order_date, "month").alias("PERIODO"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("CONSECUTIVO_EXTRACCION"),
    )


def account_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping table (FUENTE, CAMPO_ORIGEN, VALOR_ORIGEN, VALOR_SALIDA) from ``part``.

    Only parts with size > 25 are mapped, so the left join misses some accounts; those above 45 are mapped
    twice, so it multiplies some lines; every third row is of another field.
    """
    part = read_table(spark, sf_dir, "part").where(F.col("p_size") > 25)
    target = F.explode(F.expr("CASE WHEN p_size > 45 THEN array(p_brand, concat(p_brand, '-B')) ELSE array(p_brand) END"))
    return part.select(
        F.lit(SOURCE).alias("FUENTE"),
        F.when(F.col("p_partkey") % 3 != 0, MAPPED_FIELD).otherwise("Oficina").alias("CAMPO_ORIGEN"),
        F.col("p_partkey").cast("string").alias("VALOR_ORIGEN"),
        target.alias("VALOR_SALIDA"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log (FUENTE, PERIODO_EJECUTADO_FAH, NUM_VECES_REPROCESADO, ULT_FECHA_DE_CARGUE) from ``events``
    and ``orders``: the feed's own source has run the even months, some of them several times."""
    ev = read_table(spark, sf_dir, "events")
    day = F.trunc(F.col("o_orderdate").cast("date"), "month")
    own = (read_table(spark, sf_dir, "orders").where((F.month(day) % 2 == 0) & (F.col("o_orderkey") % 5 == 0))
           .select(F.lit(SOURCE).alias("FUENTE"), day.alias("PERIODO_EJECUTADO_FAH"),
                   (F.month(day) / 2 - F.col("o_orderkey") % 3).cast("int").alias("NUM_VECES_REPROCESADO"),
                   F.col("o_orderdate").cast("timestamp_ntz").alias("ULT_FECHA_DE_CARGUE")).distinct())
    return own.unionByName(ev.select(
        F.col("event_type").alias("FUENTE"),
        F.col("ts").cast("date").alias("PERIODO_EJECUTADO_FAH"),
        (F.col("user_id") % 5).cast("int").alias("NUM_VECES_REPROCESADO"),
        F.col("ts").cast("timestamp_ntz").alias("ULT_FECHA_DE_CARGUE"),
    ))
