"""The data product (C11): movements -> journal lines -> balanced groups -> 20 columns.

The reference runs four materialised stages for one day.  Here it is one plan
for any number of days, with one shuffle of the lines:

1. scan (period filter and column pruning reach parquet), unpivot in one pass,
   re-run digit per period (broadcast, one row per day), code expression;
2. the coded lines are written once as a work table (lineage cut, read back
   columnar by each branch), then hash-partitioned on (periodo, code), large transactions by slice too
   -- the only full shuffle of lines;
3. line numbers inside each (periodo, code) (W1, see
   ``operators.numbering``; large transactions are cut into slices),
   the group assignment, then the account mapping (broadcast behind a byte check);
4. the counts per code come from one map-side aggregation of the
   work table (``transaction_table``), and the group assignment is a multi-level
   prefix sum over one row per code (``operators.balance``).

Building the frame is not free of work: it writes the work table and checks the size of the mapping (one small job).
Wrap it in ``session.owned`` to have the work table deleted when the result has been written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.operators import balance, numbering
from ledgerweave.operators.joins import value_bytes
from ledgerweave.operators.journal import (CODE, JOURNAL_COLUMNS, LINE_ORDER, TKEY, coded_lines, constant_columns,
                                           map_accounts, mapping_for, movements_projection, prepared_mapping)
from ledgerweave.params import FeedParams
from ledgerweave.session import materialize

PRODUCT_COLUMNS = [
    "fecha_efectiva", "cuenta", "moneda", "moneda_origen", "dependencia", "consecutivo", "descripcion",
    "contador_linea", "valor_movimiento", "naturaleza", "fecha_posteo", "tipo_de_comprobante", "referencia",
    "codigo_transaccion", "tipo_evento", "tipo_libro_contable", "origen_transaccion",
    "desc_origen_transaccion", "grupo_salida", "periodo",
]
KEYS = ["periodo", TKEY]
# Columns of the coded lines that anything downstream reads; the work table holds only these
# (the raw debit/credit columns and the source description are dropped after the unpivot).
WORK_COLUMNS = ["periodo", "fecha_efectiva", "fecha_posteo", "ctacon", "moneda_origen_raw", "ctrcto", "consecutivo",
                "consecutivo_extraccion", "valor_movimiento", "naturaleza", TKEY]


def _work_table(movements_src: DataFrame, run_log: DataFrame | None, params: FeedParams) -> DataFrame:
    """Coded lines, written once as a work table."""
    return materialize(coded_lines(movements_src, run_log, params).select(*WORK_COLUMNS), "coded_lines")


def code_of_key() -> Column:
    """The code from its surrogate, which alone is stored, moved and sorted."""
    return F.when(F.col(TKEY) != "", F.col(TKEY))


def journal_lines(movements_src: DataFrame, mapping: DataFrame, run_log: DataFrame | None,
                  params: FeedParams) -> DataFrame:
    """Transform 1 (C1): 19 columns, one row per line (NULL-code lines kept).

    Lines are numbered before the account mapping, as in the reference, so
    copies made by duplicate mapping rows share a line number.
    """
    lines = _work_table(movements_src, run_log, params)
    numbered = numbering.ordered_row_number(lines, KEYS, LINE_ORDER, params.line_block, "contador_linea", params.hot_slice_limit, [lines])
    mapped = map_accounts(numbered, prepared_mapping(mapping, params), params, prepared=True)
    return constant_columns(mapped, params).withColumn(CODE, code_of_key()).select(*JOURNAL_COLUMNS)


def transaction_table(lines: DataFrame, mapping: DataFrame, params: FeedParams, mapping_is_small: bool) -> DataFrame:
    """One row per (periodo, code): its lines before and after the account mapping, and whether it has several sequences.

    One aggregation over the coded lines gives both counts the plan needs:
    before the mapping for line numbers, after it for the groups (a duplicated mapping row multiplies a line, as in the
    reference), using the number of mapping rows per account (broadcast behind
    the same byte check as the mapping).  It feeds several branches, so it is a work table.
    """
    mult = mapping_for(mapping, params).groupBy("VALOR_ORIGEN").agg(F.count(F.lit(1)).alias("_copies"))
    if mapping_is_small:                       # fewer rows than the mapping itself
        mult = F.broadcast(mult)
    return materialize(lines.join(mult, F.col("ctacon").cast("string") == F.col("VALOR_ORIGEN"), "left").groupBy(*KEYS)
                       .agg(F.count(F.lit(1)).alias(numbering.KEY_ROWS), F.sum(F.coalesce("_copies", F.lit(1))).cast("long").alias(balance.COUNT),
                            (F.min("consecutivo") != F.max("consecutivo")).alias("_mixed")), "transactions")


def ledger_product(movements_src: DataFrame, mapping: DataFrame, run_log: DataFrame | None,
                   params: FeedParams) -> DataFrame:
    """Final product (C11): 20 columns, partition column ``periodo`` last."""
    return product_and_transactions(movements_src, mapping, run_log, params)[0]


def product_and_transactions(movements_src: DataFrame, mapping: DataFrame, run_log: DataFrame | None,
                             params: FeedParams) -> tuple[DataFrame, DataFrame]:
    """The product, and the small transaction table it was planned from (for the run's control counts)."""
    lines = _work_table(movements_src, run_log, params)
    m = mapping_for(mapping, params)
    small = value_bytes(m) <= params.broadcast_bytes      # one check for both mapping joins
    transactions = transaction_table(lines, mapping, params, small)

    # one row per transaction (the NULL code too: it shifts the running totals)
    counts = transactions.select("periodo", code_of_key().alias(CODE), balance.COUNT)
    groups = materialize(balance.assign_groups(counts, ["periodo"], CODE, params.large_limit, params.bucket_length,
                                               params.bin_width)
                         .where(F.col(CODE).isNotNull())
                         .select("periodo", F.col(CODE).alias(TKEY), balance.GROUP), "groups")
    # lines without a code match no group: they need no number either
    named = F.col(TKEY) != ""
    numbered = numbering.numbered_lines(lines.where(named), transactions.where(named), KEYS, LINE_ORDER, params.line_block, "contador_linea",
                                        params.hot_slice_limit, groups, [lines, groups])
    mapped = map_accounts(numbered, F.broadcast(m) if small else m, params, prepared=True)
    return constant_columns(mapped, params).withColumn(CODE, code_of_key()).select(*PRODUCT_COLUMNS), transactions


def pending_periods(movements_src: DataFrame, run_log: DataFrame, source: str) -> DataFrame:
    """Source periods not yet in the run log for ``source``.

    The reference's scheduler runs every period whose inputs are ready; the
    data question is a distinct + anti join, and the result feeds
    ``FeedParams(periods=...)`` so a backfill is one job.
    """
    periods = movements_projection(movements_src).select("periodo").where(F.col("periodo").isNotNull()).distinct()
    done = (run_log.where(F.col("FUENTE") == F.lit(source))
            .select(F.col("PERIODO_EJECUTADO_FAH").alias("periodo")).distinct())
    return periods.join(done, "periodo", "left_anti")


def pending_by_files(files: DataFrame, run_log: DataFrame, source: str) -> DataFrame:
    """Days of ``files`` (``sources.partitions.partition_files``) that ``source`` has not run since their files last changed.

    No row of the movements is read: a day is pending when the log has no run of it, or when a file of it is as new as its last run or newer.
    """
    runs = (run_log.where(F.col("FUENTE") == F.lit(source)).groupBy(F.col("PERIODO_EJECUTADO_FAH").alias("periodo"))
            .agg(F.max("ULT_FECHA_DE_CARGUE").alias("_run")))
    # a day run without a time counts as run long ago
    return files.join(runs, "periodo", "left").where("_run is null or modificado >= _run").select("periodo")


def periods_list(df: DataFrame) -> tuple[dt.date, ...]:
    """Pending periods as parameters (one small row per day)."""
    return tuple(r["periodo"] for r in df.orderBy("periodo").collect())
