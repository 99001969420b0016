"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per operator key of
SURVEY §2, and the DuckDB oracle text of each (``oracle_sql.py`` builds the shared CTEs).

Every query reads the driver's tables (through the fixture views) over whole
tables; the one-day queries are the reference's daily run, pruned by period.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.columns import format_date, lpad_zero, normalise_date, parse_tag, source_from_name
from ledgerweave.operators import balance, journal, numbering, reports, runlog
from ledgerweave.operators.kept_balance import KeptBalance
from ledgerweave.params import FeedParams
from ledgerweave.plans import delivery, export, product
from ledgerweave.plans.run import METADATA_VERSION, export_feed, rerun_numbers
from ledgerweave.plans.tables import overwrite_bucketed, overwrite_partitions, replace_table
from ledgerweave.session import COMPRESSION, freeing, materialize, owned, work_dir
from ledgerweave.sources import fixtures, registry
from ledgerweave.sources.fixtures import feed_params
from ledgerweave.sources.partitions import partition_files
from ledgerweave.sources.tables import read_table
from ledgerweave.streaming.daily_feed import start_daily_feed

# The one-day queries run the busiest day of the movements (the heaviest daily
# run; earliest on ties), with the re-run digit and limits of FIXTURES §3.
DAY_SETTINGS = dict(rerun=3, large_limit=3, bin_width=100)
# Reports, routing and export run with limits that give every day several groups and some large transactions;
# transactions of more than two lines are cut into slices, of which those with several lines count as hot.
REPORT_SETTINGS = dict(large_limit=8, bin_width=40)
HOT_SETTINGS = dict(line_block=2, hot_slice_rows=1)
RUN_TS = dt.datetime(2026, 1, 1, 0, 0, 0)
DELIVERY = "delivery"              # relative root of file paths in the manifest queries
BUCKETS = 8                        # of the bucketed product table
PIECE_BYTES = 4096                 # of the sink queries, so that most files are written by several tasks
MONTH_LIMIT = 750                  # balance of lineitem by ship month (FIXTURES §3)

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf: str):
    return fixtures.movements(spark, sf), fixtures.account_mapping(spark, sf), fixtures.run_log(spark, sf)


def _product(spark: SparkSession, sf: str, params: FeedParams | None = None) -> DataFrame:
    """The product, with the settings of the report queries unless others are given."""
    mov, mp, log = _inputs(spark, sf)
    return product.ledger_product(mov, mp, log, params or feed_params(**REPORT_SETTINGS))


def _product_table(spark: SparkSession, sf: str, params: FeedParams | None = None) -> DataFrame:
    """The product written as its daily-partitioned table and read back (as the exporter reads it).

    Used where several reports read the product: they scan the table instead
    of recomputing the product once per report.
    """
    with owned(spark):      # the product's work tables go when it is written
        return overwrite_partitions(_product(spark, sf, params), work_dir(spark, f"product-{uuid.uuid4().hex}"))


def busiest_day(spark: SparkSession, sf: str) -> dt.date:
    """Processing day with the most movements (one row of a per-day count)."""
    proj = journal.movements_projection(fixtures.movements(spark, sf)).where(F.col("periodo").isNotNull())
    per_day = freeing(proj.groupBy("periodo").agg(F.count(F.lit(1)).alias("n")))
    return per_day.orderBy(F.col("n").desc(), F.col("periodo")).first()["periodo"]


def _unp(spark: SparkSession, sf: str) -> DataFrame:
    mov = fixtures.movements(spark, sf)
    return journal.unpivot_movements(journal.filter_period(journal.movements_projection(mov), None))


def _coded(spark: SparkSession, sf: str, params: FeedParams | None = None) -> DataFrame:
    mov, _, log = _inputs(spark, sf)
    return journal.coded_lines(mov, log, params or feed_params())


# ---------------------------------------------------------------- product and its stages

def q_ledger_product(spark, sf):
    return _product(spark, sf, feed_params())


def q_ledger_product_hot(spark, sf):
    return _product(spark, sf, feed_params(**REPORT_SETTINGS, **HOT_SETTINGS))


def q_ledger_product_day(spark, sf):
    return _product(spark, sf, feed_params(periods=(busiest_day(spark, sf),), **DAY_SETTINGS))


def q_journal_lines(spark, sf):
    mov, mp, log = _inputs(spark, sf)
    return product.journal_lines(mov, mp, log, feed_params())


def q_scan_movements(spark, sf):
    return fixtures.movements(spark, sf)


def q_movements_projection(spark, sf):
    return journal.movements_projection(fixtures.movements(spark, sf))


def q_filter_period(spark, sf):
    return journal.filter_period(journal.movements_projection(fixtures.movements(spark, sf)),
                                 [busiest_day(spark, sf)])


def q_filter_period_literal(spark, sf):
    proj = journal.movements_projection(fixtures.movements(spark, sf))
    return proj.where(F.col("periodo") == F.lit(busiest_day(spark, sf).isoformat()))


def q_filter_positive(spark, sf):
    proj = journal.movements_projection(fixtures.movements(spark, sf))
    return proj.where((F.col("vlrdeb") > 0) | (F.col("vlrcre") > 0))


def q_unpivot_movements(spark, sf):
    return _unp(spark, sf)


def q_scan_mapping(spark, sf):
    return journal.mapping_for(fixtures.account_mapping(spark, sf), feed_params())


def q_cross_join_counter(spark, sf):
    return journal.attach_rerun(_unp(spark, sf), fixtures.run_log(spark, sf), feed_params())


def q_reprocess_counter(spark, sf):
    return runlog.reprocess_counter(fixtures.run_log(spark, sf))


def q_transaction_code(spark, sf):
    return _coded(spark, sf).drop(journal.TKEY)


def q_line_numbers(spark, sf):
    p = feed_params(**HOT_SETTINGS)
    coded = _coded(spark, sf, p)
    columns = [c for c in coded.columns if c != journal.TKEY]
    moved = coded.drop(journal.CODE)      # the code is told again from its surrogate
    stored = materialize(moved, "coded_lines")     # feeds the numbering and the slice counts
    out = numbering.ordered_row_number(stored, ["periodo", journal.TKEY], journal.LINE_ORDER, p.line_block,
                                       "contador_linea", p.hot_slice_limit, [stored])
    return out.withColumn(journal.CODE, product.code_of_key()).select(*columns, "contador_linea")


def q_map_accounts(spark, sf):
    return journal.map_accounts(_unp(spark, sf), fixtures.account_mapping(spark, sf), feed_params())


def q_constant_columns(spark, sf):
    return journal.constant_columns(_unp(spark, sf), feed_params())


def q_parameter_column(spark, sf):
    _unp(spark, sf).createOrReplaceTempView("lw_lines")
    return spark.sql("SELECT periodo, consecutivo_extraccion, naturaleza, valor_movimiento, "
                     ":libro AS tipo_libro_contable FROM lw_lines", args={"libro": fixtures.BOOK})


def q_transaction_counts(spark, sf):
    p = feed_params()
    mapped = journal.map_accounts(_coded(spark, sf, p), fixtures.account_mapping(spark, sf), p)
    return balance.transaction_counts(mapped, ["periodo"], journal.CODE)


def q_pending_periods(spark, sf):
    mov, _, log = _inputs(spark, sf)
    return product.pending_periods(mov, log, fixtures.SOURCE)


# ---------------------------------------------------------------- balancing, generic form

def _month_counts(spark, sf):
    li = read_table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("mes"),
                                                    "l_orderkey", "l_linenumber")
    return li, balance.transaction_counts(li, [], "mes")


def q_size_split(spark, sf):
    _, c = _month_counts(spark, sf)
    return c.select("mes", balance.COUNT, (F.col(balance.COUNT) > MONTH_LIMIT).alias("es_grande"))


def q_large_group_rank(spark, sf):
    _, c = _month_counts(spark, sf)
    r = balance.ranked_counts(c, [], "mes", MONTH_LIMIT, 4)
    return r.where(F.col("es_grande")).select("mes", "rango_grande")


def q_running_total(spark, sf):
    _, c = _month_counts(spark, sf)
    r = balance.ranked_counts(c, [], "mes", MONTH_LIMIT, 4)
    return r.where(~F.col("es_grande")).select("mes", "acumulado")


def q_balance_groups(spark, sf):
    _, c = _month_counts(spark, sf)
    return balance.assign_groups(c, [], "mes", MONTH_LIMIT, 4)


def q_balance_kept(spark, sf):
    """The groups of a kept balance: built from the lines of even extraction numbers, then updated by the others, which come late."""
    p = feed_params(**REPORT_SETTINGS)
    lines = materialize(journal.map_accounts(_coded(spark, sf, p), fixtures.account_mapping(spark, sf), p).select("periodo", journal.CODE, "consecutivo_extraccion"), "lines")
    late = F.col("consecutivo_extraccion") % 2 != 0
    kept = KeptBalance(spark, work_dir(spark, f"balance-{uuid.uuid4().hex}"), p.large_limit, p.bin_width, p.bucket_length)
    kept.build(balance.transaction_counts(lines.where(~late), ["periodo"], journal.CODE))
    kept.update(balance.transaction_counts(lines.where(late), ["periodo"], journal.CODE))
    return kept.groups().where(F.col(journal.CODE).isNotNull())


def q_assign_groups_join(spark, sf):
    li, _ = _month_counts(spark, sf)
    return balance.balance_groups(li, [], "mes", MONTH_LIMIT, 4)


# ---------------------------------------------------------------- reports

def q_report_metadata(spark, sf):
    return reports.report_metadata(_product(spark, sf), fixtures.SOURCE)


def q_report_header(spark, sf):
    return reports.report_header(_product(spark, sf))


def q_report_lines(spark, sf):
    return reports.report_lines(_product(spark, sf))


def q_report_control(spark, sf):
    return reports.report_control(_product(spark, sf))


def q_control_line_counts(spark, sf):
    c = reports.control_counts(_product(spark, sf))
    return c.select(format_date("periodo").alias("periodo_formateado"), "grupo", F.col("lineas").alias("recuento"))


def q_control_header_counts(spark, sf):
    c = reports.control_counts(_product(spark, sf))
    return c.select(format_date("periodo").alias("periodo_formateado"), "grupo",
                    F.col("cabeceras").alias("recuento"))


def q_distinct_groups(spark, sf):
    return _product(spark, sf).select("periodo", F.col("grupo_salida").alias("grupo")).distinct()


def q_layout_header(spark, sf):
    return _product(spark, sf).select(*reports.apply_layout(reports.header_layout()))


def q_layout_lines(spark, sf):
    return _product(spark, sf).select(*reports.apply_layout(reports.lines_layout()))


def q_output_columns(spark, sf):
    ctl = reports.report_control(_product(spark, sf))
    return ctl.select(*export.output_columns(ctl))


def q_group_routing(spark, sf):
    """Lines of which some have no group: January days none at all, other days every fifth line."""
    g = (F.when(F.month("periodo") == 1, F.lit(None)).when(F.col("contador_linea") % 5 == 0, F.lit(0))
         .otherwise(F.col("grupo_salida")))
    lines = _product_table(spark, sf).select("periodo", "codigo_transaccion", "contador_linea", "cuenta", g.alias("grupo"))
    return export.group_routing(lines).select("periodo", "codigo_transaccion", "contador_linea", "cuenta", "_file_group")


SPECS: dict[str, export.ReportSpec] = {
    kind: export.ReportSpec(name=registry.report_name(kind, fixtures.SOURCE), query=text, encoding=encoding,
                            template=registry.NAME_TEMPLATE.format(prefix=prefix, source=fixtures.SOURCE),
                            extension=extension, delimiter=delimiter, header=header)
    for kind, (_, text, encoding, prefix, extension, delimiter, header) in registry.REPORT_KINDS.items() if kind != "ZIP"}


def _report(kind: str, prod: DataFrame) -> DataFrame:
    return reports.report_metadata(prod, fixtures.SOURCE) if kind == "METADATA" else reports.REPORTS[kind](prod)


def _files(prod: DataFrame, kinds=registry.KINDS, root: str = DELIVERY) -> DataFrame:
    """Manifest of the reports over the product; its counts are a work table, as they feed a branch per report and the totals."""
    specs = {SPECS[k].name: SPECS[k] for k in kinds}
    rows = export.file_rows(specs, {}, materialize(export.product_counts(prod), "counts"))
    return export.manifest(rows, specs, 1, root)


def q_report_split_by_group(spark, sf):
    # read by two branches: the days that have groups, and the lines
    r = export.render_report(materialize(_report("CONTROL", _product(spark, sf)), "control"), SPECS["CONTROL"])
    return r.select("report", "periodo", "grupo", "parte", "value")


def q_report_header_row(spark, sf):
    heads = {SPECS["HEADER"].name: ",".join(n for n, _ in reports.header_layout())}
    return export.header_rows(_files(_product(spark, sf)), heads).select("report", "periodo", "grupo", "value")


def _written(spark, sf, kinds) -> DataFrame:
    """Manifest of delivered reports; files are cut into pieces of a few kilobytes."""
    prod = _product_table(spark, sf)
    specs = {SPECS[k].name: SPECS[k] for k in kinds}
    loaded = {SPECS[k].name: _report(k, prod) for k in kinds}
    path = work_dir(spark, f"sink-{uuid.uuid4().hex}")
    files = materialize(_files(prod, kinds, path), "manifest")
    export.write_files({n: export.render_report(df, specs[n]) for n, df in loaded.items()}, specs, files, path, loaded=loaded, piece_bytes=PIECE_BYTES)
    return files


def _read_back(files: DataFrame, encoding: str) -> DataFrame:
    """Lines of delivered files with the file they are in and their place."""
    return delivery.read_lines(files, encoding, ("report", "periodo", "grupo", "parte"))


def q_sink_report_lines(spark, sf):
    files = _written(spark, sf, ["LINES"])
    return _read_back(files, "UTF-8").select("report", "periodo", "grupo", "parte", "value")


def q_file_order(spark, sf):
    """O1, O2: of every file the first and last data lines, and the sum of a number for each line and the one before it, which any other order changes."""
    files = _written(spark, sf, ["HEADER", "LINES", "CONTROL"])
    back = _read_back(files, "UTF-8").where(~F.col("value").startswith("TRANSACTION_NUMBER,"))
    before = F.coalesce(F.lag("value").over(Window.partitionBy("report", "periodo", "grupo").orderBy("at")), F.lit(""))
    pair = F.conv(F.substring(F.md5(F.concat(before, F.lit("\n"), "value")), 1, 8), 16, 10).cast("long")
    return (back.withColumn("par", pair).groupBy("report", "periodo", "grupo")
            .agg(F.min_by("value", "at").alias("primera"), F.max_by("value", "at").alias("ultima"), F.count(F.lit(1)).alias("lineas"), F.sum("par").alias("pares")))


def q_run_manifest(spark, sf):
    return _files(_product_table(spark, sf)).drop("id")


def q_file_names(spark, sf):
    return _files(_product_table(spark, sf)).select("report", "periodo", "grupo", "archivo")


def q_trailer_line(spark, sf):
    return _files(_product_table(spark, sf)).select("report", "periodo", "grupo", "trailer")


def q_run_summary(spark, sf):
    return _files(_product_table(spark, sf)).agg(
        F.count(F.lit(1)).alias("archivos"), F.sum("registros").alias("registros_leidos"),
        F.sum("registros").alias("registros_escritos"), F.countDistinct("periodo").alias("periodos"))


def _stored(spark, sf, text: str, args: dict, numbers: DataFrame | None = None) -> DataFrame:
    spec = export.ReportSpec(name="TEXT", query=text)
    return export.load_reports(spark, _product(spark, sf), {spec.name: spec}, args, numbers)[spec.name]


def q_query_source(spark, sf):
    return _stored(spark, sf, registry.CONTROL_SQL, {"desde": None, "hasta": None})


def q_query_parameters(spark, sf):
    """A stored text with its parameters bound: version, application and the days of the run (the first half of 1996)."""
    days = (dt.date(1996, 1, 1), dt.date(1996, 6, 1))
    return _stored(spark, sf, registry.METADATA_SQL, export.report_args(fixtures.SOURCE, METADATA_VERSION, days))


def q_query_identifiers(spark, sf):
    """A stored text that names its tables and reads its re-run number by parameters: a run spans days, so the numbers are a table."""
    mov, _, log = _inputs(spark, sf)
    days = journal.movements_projection(mov).select("periodo").where(F.col("periodo").isNotNull()).distinct()
    numbers = rerun_numbers(log, product.periods_list(days), feed_params())
    return _stored(spark, sf, registry.RUNS_SQL, {"desde": None, "hasta": None}, numbers)


def q_pending_by_files(spark, sf):
    """Pending days of a partitioned table from file times alone: the log has run the even months after the files were written, the others before."""
    mov = fixtures.movements(spark, sf)
    path = work_dir(spark, f"movements-{uuid.uuid4().hex}")
    mov.write.partitionBy("PERIODO").parquet(path)
    late = F.when(F.month("PERIODO_EJECUTADO_FAH") % 4 == 0, F.lit(dt.datetime(2100, 1, 1)).cast("timestamp_ntz")).otherwise(F.col(runlog.LOADED))
    return product.pending_by_files(partition_files(spark, path, "PERIODO"), fixtures.run_log(spark, sf).withColumn(runlog.LOADED, late), fixtures.SOURCE)


def q_sink_replace_table(spark, sf):
    path = work_dir(spark, f"product-{uuid.uuid4().hex}")
    with owned(spark):
        return replace_table(_product(spark, sf, feed_params()), path)


def _bucketed(spark, sf) -> DataFrame:
    """The product as a table in files by transaction code."""
    with owned(spark):
        return overwrite_bucketed(_product(spark, sf), work_dir(spark, f"bucketed-{uuid.uuid4().hex}"), BUCKETS)


def q_bucketed_header(spark, sf):
    return reports.report_header(_bucketed(spark, sf))


def q_bucketed_control(spark, sf):
    return reports.report_control(_bucketed(spark, sf))


def q_sink_overwrite_partition(spark, sf):
    path = work_dir(spark, f"product-{uuid.uuid4().hex}")
    with owned(spark):
        replace_table(_product(spark, sf, feed_params()), path)
    day = busiest_day(spark, sf)
    with owned(spark):
        return overwrite_partitions(_product(spark, sf, feed_params(periods=(day,), rerun=3)), path)


def q_run_log_upsert(spark, sf):
    mov, _, log = _inputs(spark, sf)
    keys = (log.select(*runlog.KEYS)
            .unionByName(runlog.keys_of(journal.filter_period(journal.movements_projection(mov), None), fixtures.SOURCE)))
    return runlog.run_log_upsert(log, runlog.planned_updates(runlog.next_numbers(log, keys), RUN_TS))


# ---------------------------------------------------------------- scalar functions over data

def q_fn_lpad(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", lpad_zero("l_orderkey", 4).alias("seq4"),
                     lpad_zero("l_linenumber", 1).alias("line1"))


def q_fn_format_date(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", format_date(F.col("o_orderdate").cast("date")).alias("compacta"),
                    format_date(F.col("o_orderdate").cast("date"), compact=False).alias("iso"))


def q_fn_normalise_date(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", normalise_date(format_date("d")).alias("desde_compacta"),
                    normalise_date(format_date("d", compact=False)).alias("desde_iso"))


def q_fn_source_from_name(spark, sf):
    ev = read_table(spark, sf, "events")
    name = F.concat(F.lit("GENERAR_FAH_"), F.upper("event_type"), F.lit("_COMPLETO_ZIP"))
    return ev.select("event_id", source_from_name(name).alias("fuente"),
                     source_from_name(F.col("event_type")).alias("sin_patron"))


def q_fn_parse_tag(spark, sf):
    ev = read_table(spark, sf, "events")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return ev.select("event_id", parse_tag("props", schema).getField("k").alias("k"))


def q_daily_feed(spark, sf):
    """The streaming feed (C12 re-aimed): movements land as a daily-partitioned table, an
    ``availableNow`` file stream runs the product for the days it sees; the result is the
    product table, equal to ``ledger_product``."""
    root = work_dir(spark, f"feed-{uuid.uuid4().hex}")
    mov = fixtures.movements(spark, sf)
    freeing(mov).write.partitionBy("PERIODO").option("compression", COMPRESSION).parquet(f"{root}/movements")
    q = start_daily_feed(spark, f"{root}/movements", mov.schema, fixtures.account_mapping(spark, sf),
                         fixtures.run_log(spark, sf), f"{root}/product", f"{root}/checkpoint", feed_params())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{root}/product")


def delivered(spark, sf, params: FeedParams) -> DataFrame:
    """A whole run; the delivered files are read again and counted: (file name, lines)."""
    result = export_feed(spark, sf, params)
    return delivery.read_lines(result["manifest"]).groupBy("archivo").agg(F.count(F.lit(1)).alias("lineas"))


def q_export_run(spark, sf):
    return delivered(spark, sf, feed_params(**REPORT_SETTINGS))


def q_sink_encoded_report(spark, sf):
    files = _written(spark, sf, ["METADATA"])
    return _read_back(files, "ISO-8859-1").select("grupo", "periodo", "value")


QUERIES: dict[str, Query] = {
    "ledger_product": q_ledger_product,
    "ledger_product_day": q_ledger_product_day,
    "ledger_product_hot": q_ledger_product_hot,
    "journal_lines": q_journal_lines,
    "scan_movements": q_scan_movements,
    "movements_projection": q_movements_projection,
    "filter_period": q_filter_period,
    "filter_period_literal": q_filter_period_literal,
    "filter_positive": q_filter_positive,
    "unpivot_movements": q_unpivot_movements,
    "scan_mapping": q_scan_mapping,
    "cross_join_counter": q_cross_join_counter,
    "reprocess_counter": q_reprocess_counter,
    "transaction_code": q_transaction_code,
    "line_numbers": q_line_numbers,
    "map_accounts": q_map_accounts,
    "constant_columns": q_constant_columns,
    "parameter_column": q_parameter_column,
    "transaction_counts": q_transaction_counts,
    "pending_periods": q_pending_periods,
    "pending_by_files": q_pending_by_files,
    "size_split": q_size_split,
    "large_group_rank": q_large_group_rank,
    "running_total": q_running_total,
    "balance_groups": q_balance_groups,
    "balance_kept": q_balance_kept,
    "assign_groups_join": q_assign_groups_join,
    "report_metadata": q_report_metadata,
    "report_header": q_report_header,
    "report_lines": q_report_lines,
    "report_control": q_report_control,
    "control_line_counts": q_control_line_counts,
    "control_header_counts": q_control_header_counts,
    "distinct_groups": q_distinct_groups,
    "layout_header": q_layout_header,
    "layout_lines": q_layout_lines,
    "output_columns": q_output_columns,
    "group_routing": q_group_routing,
    "report_split_by_group": q_report_split_by_group,
    "report_header_row": q_report_header_row,
    "sink_report_lines": q_sink_report_lines,
    "file_order": q_file_order,
    "run_manifest": q_run_manifest,
    "file_names": q_file_names,
    "trailer_line": q_trailer_line,
    "run_summary": q_run_summary,
    "query_source": q_query_source,
    "query_parameters": q_query_parameters,
    "query_identifiers": q_query_identifiers,
    "sink_replace_table": q_sink_replace_table,
    "bucketed_header": q_bucketed_header,
    "bucketed_control": q_bucketed_control,
    "sink_overwrite_partition": q_sink_overwrite_partition,
    "run_log_upsert": q_run_log_upsert,
    "fn_lpad": q_fn_lpad,
    "fn_format_date": q_fn_format_date,
    "fn_normalise_date": q_fn_normalise_date,
    "fn_source_from_name": q_fn_source_from_name,
    "fn_parse_tag": q_fn_parse_tag,
    "daily_feed": q_daily_feed,
    "export_run": q_export_run,
    "sink_encoded_report": q_sink_encoded_report,
}
