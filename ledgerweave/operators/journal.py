"""Movements -> journal lines (C1): filter, unpivot, re-run digit, code, line number, mapping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.columns import transaction_code
from ledgerweave.operators.joins import broadcast_if_small
from ledgerweave.params import FeedParams
from ledgerweave.sources.tables import period_predicate

# Source column -> work column.
PROJECTION = [
    ("FECHA_EFECTIVA", "fecha_efectiva"),
    ("FECHA_POSTEO", "fecha_posteo"),
    ("CTACON", "ctacon"),
    ("MONEDA", "moneda_origen_raw"),
    ("CTRCTO", "ctrcto"),
    ("CONSECUTIVO", "consecutivo"),
    ("DESCRIPCION", "descripcion_origen"),
    ("VLRDEB", "vlrdeb"),
    ("VLRCRE", "vlrcre"),
    ("PERIODO", "periodo"),
    ("CONSECUTIVO_EXTRACCION", "consecutivo_extraccion"),
]

CODE = "codigo_transaccion"
TKEY = "_tkey"   # non-null surrogate of the code: '' never is a code (a code has two 8-char dates)

# Order of lines inside a transaction: the reference orders by extraction
# sequence and nature; the rest only breaks ties so the numbering is
# deterministic (rows still tied are equal in every output column).
LINE_ORDER = ["consecutivo_extraccion", "naturaleza", "ctacon", "ctrcto", "valor_movimiento",
              "moneda_origen_raw", "consecutivo"]

# Output of transform 1 (before balancing), in reference order.
JOURNAL_COLUMNS = [
    "fecha_efectiva", "cuenta", "moneda", "moneda_origen", "dependencia", "consecutivo", "descripcion",
    "contador_linea", "valor_movimiento", "naturaleza", "fecha_posteo", "tipo_de_comprobante", "referencia",
    "codigo_transaccion", "tipo_evento", "tipo_libro_contable", "origen_transaccion",
    "desc_origen_transaccion", "periodo",
]


def line_order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in LINE_ORDER]


def movements_projection(source: DataFrame) -> DataFrame:
    """Rename/prune the source movements to the 11 work columns."""
    return source.select(*[F.col(s).alias(t) for s, t in PROJECTION])


def filter_period(df: DataFrame, periods: Iterable[dt.date] | None, col: str = "periodo") -> DataFrame:
    """``periodo = @fecha_proceso`` for one or many dates (P8); all non-NULL periods when ``None``.

    Applied right on the scan so it reaches parquet as a (partition) filter.
    """
    pred = period_predicate(col, periods)
    return df.where(F.col(col).isNotNull() if pred is None else pred)


def unpivot_movements(mov: DataFrame) -> DataFrame:
    """Debit/credit columns -> (valor_movimiento, naturaleza) lines, positive amounts only.

    One pass instead of a UNION ALL of two scans.  The pre-filter (either side
    positive) is pushed to the scan; NULL, zero and negative amounts never
    become lines.
    """
    pre = mov.where((F.col("vlrdeb") > 0) | (F.col("vlrcre") > 0))
    out = pre.select("*", F.expr("stack(2, '1', vlrdeb, '2', vlrcre) AS (naturaleza, valor_movimiento)"))
    return out.where(F.col("valor_movimiento") > 0).select(*mov.columns, "valor_movimiento", "naturaleza")


def rerun_by_period(run_log: DataFrame, source: str) -> DataFrame:
    """``COALESCE(MAX(NUM_VECES_REPROCESADO) + 1, 1)`` per period for one source (A2).

    One row per logged period: bounded by the number of days, so it is a
    broadcast side.
    """
    return (run_log.where(F.col("FUENTE") == F.lit(source))
            .groupBy(F.col("PERIODO_EJECUTADO_FAH").alias("periodo"))
            .agg((F.max("NUM_VECES_REPROCESADO") + 1).cast("long").alias("codigo_reproceso")))


def attach_rerun(lines: DataFrame, run_log: DataFrame | None, params: FeedParams) -> DataFrame:
    """Re-run digit on every line (J3).  The reference cross-joins a one-row
    aggregate; for many periods that becomes a left join on the period."""
    if params.rerun is not None or run_log is None:
        return lines.withColumn("codigo_reproceso", F.lit(int(params.rerun or 1)).cast("long"))
    # one row per logged day: the size is bounded by the calendar, not by the data
    rr = F.broadcast(rerun_by_period(run_log, params.source))
    return (lines.join(rr, "periodo", "left")
            .withColumn("codigo_reproceso", F.coalesce(F.col("codigo_reproceso"), F.lit(1).cast("long"))))


def add_code(lines: DataFrame, params: FeedParams) -> DataFrame:
    """Transaction code and its non-null surrogate key."""
    code = transaction_code(params.voucher, "fecha_efectiva", "fecha_posteo", "consecutivo", "codigo_reproceso",
                            (params.voucher_width, params.sequence_width, params.rerun_width))
    return lines.withColumn(CODE, code).withColumn(TKEY, F.coalesce(F.col(CODE), F.lit("")))


def coded_lines(movements_src: DataFrame, run_log: DataFrame | None, params: FeedParams) -> DataFrame:
    """Scan -> projection -> period filter -> unpivot -> re-run digit -> code."""
    mov = filter_period(movements_projection(movements_src), params.periods)
    return add_code(attach_rerun(unpivot_movements(mov), run_log, params), params)


def mapping_for(mapping: DataFrame, params: FeedParams) -> DataFrame:
    """Rows of the mapping table for this source and field (literal predicates of J2)."""
    return (mapping.where((F.col("FUENTE") == params.source) & (F.col("CAMPO_ORIGEN") == params.mapped_field))
            .select("VALOR_ORIGEN", "VALOR_SALIDA"))


def prepared_mapping(mapping: DataFrame, params: FeedParams) -> DataFrame:
    """The mapping rows of this run, marked for broadcast when their values fit the byte limit.

    The check is one small job on the dimension table; beyond the limit the
    join stays a sort-merge join (AQE splits a hot account).  Prepare once and
    pass ``prepared=True`` to every join of the run.
    """
    return broadcast_if_small(mapping_for(mapping, params), params.broadcast_bytes)


def map_accounts(lines: DataFrame, mapping: DataFrame, params: FeedParams, account: str = "ctacon",
                 prepared: bool = False) -> DataFrame:
    """``COALESCE(hom.VALOR_SALIDA, CAST(account AS STRING))`` via a left join.

    Duplicate mapping rows multiply lines, as in the reference.
    """
    m = mapping if prepared else prepared_mapping(mapping, params)
    joined = lines.join(m, F.col(account).cast("string") == F.col("VALOR_ORIGEN"), "left")
    return joined.withColumn("cuenta", F.coalesce(F.col("VALOR_SALIDA"), F.col(account).cast("string"))) \
                 .drop("VALOR_ORIGEN", "VALOR_SALIDA")


def constant_columns(lines: DataFrame, params: FeedParams) -> DataFrame:
    """Literal and parameter columns of transform 1 (P3, P4, P5), renamed source columns."""
    return (lines
            .withColumn("moneda", F.lit(params.currency))
            .withColumnRenamed("moneda_origen_raw", "moneda_origen")
            .withColumnRenamed("ctrcto", "dependencia")
            .withColumn("descripcion", F.lit(params.event_type))
            .withColumn("tipo_de_comprobante", F.lit(params.voucher))
            .withColumn("referencia", F.lit(None).cast("string"))
            .withColumn("tipo_evento", F.lit(params.event_type))
            .withColumn("tipo_libro_contable", F.lit(params.book))
            .withColumn("origen_transaccion", F.lit(params.event_type))
            .withColumn("desc_origen_transaccion", F.lit(params.source_description)))
