"""DuckDB oracle SQL per registered key (see ``catalog.QUERIES``).

Layouts, report names and settings are written out here again, so that a mistake in the engine shows.
"""

from __future__ import annotations

from ledgerweave import oracle_sql as O
from ledgerweave.oracle_sql import BOOK, SOURCE

# the processing day with the most movements, earliest on ties (SQL text)
DAY = "(SELECT PERIODO FROM movements WHERE PERIODO IS NOT NULL GROUP BY PERIODO ORDER BY COUNT(*) DESC, PERIODO LIMIT 1)"
MONTH_LIMIT = 750
RUN_TS = "2026-01-01 00:00:00"

PROD = O.with_product()                      # the feed's limits
REP = O.with_product(limit=8, width=40)      # the limits of the report queries: several groups a day
LINES = O.with_lines()


# ---------------------------------------------------------------- layouts (column -> DuckDB expression, None: NULL)

def _fill(*spans: tuple[str, int, int]) -> list[tuple[str, None]]:
    return [(f"{prefix}{i}", None) for prefix, a, b in spans for i in range(a, b + 1)]


HEADER = [
    ("TRANSACTION_NUMBER", "codigo_transaccion"), ("EVENT_TYPE_CODE", "tipo_evento"), ("LEDGER_NAME", "tipo_libro_contable"),
    ("TRANSACTION_DATE", "strftime(fecha_efectiva, '%Y-%m-%d')"), ("TRANSACTION_REVERSAL_FLAG", "'N'"),
    ("DESCRIPCION_ORIGEN_TRANSACCION", "desc_origen_transaccion"), ("COMPROBANTE_CONTABLE", "tipo_de_comprobante"),
    ("ORIGEN_TRANSACCION", "origen_transaccion"), ("MONEDA", "moneda"),
] + _fill(("Character", 5, 50), ("Number", 1, 10), ("Date", 1, 10), ("Long Character", 1, 5))

LINE = ([
    ("TRANSACTION_NUMBER", "codigo_transaccion"), ("LINE_NUMBER", "contador_linea"), ("COD_SUCURSAL", None),
    ("OFICINA_ORIGEN_TRANSACCION", "dependencia"), ("CUENTA_CONTABLE", "cuenta"), ("NATURALEZA", "naturaleza"),
    ("DESC_TRANSACCION", "desc_origen_transaccion"), ("REFERENCIA_01", "referencia"), ("REFERENCIA_02", "'0'"),
    ("TIPO_COMPROBANTE", "tipo_de_comprobante"),
] + _fill(("Character", 9, 100), ("Number", 1, 2)) + [("VALOR_COP_1", "valor_movimiento"), ("VALOR_MO_1", "valor_movimiento")]
    + _fill(("Number", 5, 30), ("Date", 1, 10)) + [("RAZON_SOCIAL_TITULAR", None)] + _fill(("Long Character", 2, 5)))


def _columns(layout) -> str:
    return ", ".join(f'{e or "CAST(NULL AS VARCHAR)"} AS "{n}"' for n, e in layout)


def _line(layout) -> str:
    return "concat_ws(',', " + ", ".join(f"COALESCE(CAST({e} AS VARCHAR), '')" if e else "''" for _, e in layout) + ")"


def _names(layout) -> str:
    return ",".join(n for n, _ in layout)


# ---------------------------------------------------------------- reports and files, from counts per (day, group)

CONTROL = """
SELECT strftime(periodo, '%Y%m%d') AS periodo_formateado, tipo AS tipo_registro,
       IF(tipo = 'LINE', lineas, cabeceras) AS recuento, grupo, periodo
FROM per_group, (VALUES ('LINE'), ('HEADER')) k(tipo)"""

METADATA = f"""
SELECT orden AS ORDEN, texto AS file_content_string, grupo, periodo
FROM per_group, (VALUES (1, 'Metadata version number : 3'), (2, 'Application Short Name : {SOURCE}')) t(orden, texto)"""

# report, file prefix, extension, encoding, header rows, data rows of a group
REPORTS = [("METADATA", "Metadata", "txt", "ISO-8859-1", 0, "2"), ("HEADER", "XlaTrxH", "csv", "UTF-8", 1, "cabeceras"),
           ("LINES", "XlaTrxL", "csv", "UTF-8", 1, "lineas"), ("CONTROL", "XlaCtl", "txt", "UTF-8", 0, "2")]


def files_sql(rerun: str = "1") -> str:
    """``files``: a row per report and group; ``rerun``: SQL text of the run's number."""
    kinds = ", ".join(f"('{k}', '{p}', '{e}', '{c}', {h})" for k, p, e, c, h, _ in REPORTS)
    rows = " ".join(f"WHEN '{k}' THEN {n}" for k, *_, n in REPORTS)
    return f"""
files AS (
  SELECT *, prefijo || '_{SOURCE}_' || strftime(periodo, '%Y%m%d') || '_' || grupo || '_de_' || total_archivos || '_'
            || {rerun} || '.' || ext AS archivo
  FROM (SELECT 'ARCHIVO_' || tipo || '_{SOURCE}' AS report, periodo, CAST(grupo AS VARCHAR) AS grupo, CAST(0 AS BIGINT) AS parte,
               CAST(CASE tipo {rows} END AS BIGINT) AS registros, count(*) OVER (PARTITION BY periodo, tipo) AS total_archivos,
               prefijo, ext, encoding, cabecera
        FROM per_group, (VALUES {kinds}) k(tipo, prefijo, ext, encoding, cabecera))
)"""


FILES = O.with_product(limit=8, width=40, more=files_sql())
LOGGED = f"(SELECT COALESCE(max(NUM_VECES_REPROCESADO), 0) + 1 FROM run_log g WHERE g.FUENTE = '{SOURCE}' AND g.PERIODO_EJECUTADO_FAH = periodo)"

RUN_LOG_UPSERT = f"""
seen AS (SELECT FUENTE, PERIODO_EJECUTADO_FAH, max(COALESCE(NUM_VECES_REPROCESADO, 0)) + 1 AS n FROM run_log GROUP BY ALL),
fresh AS (SELECT DISTINCT '{SOURCE}' AS FUENTE, periodo AS PERIODO_EJECUTADO_FAH FROM movp WHERE periodo IS NOT NULL)
SELECT r.FUENTE, r.PERIODO_EJECUTADO_FAH, CAST(s.n AS INTEGER) AS NUM_VECES_REPROCESADO, TIMESTAMP '{RUN_TS}' AS ULT_FECHA_DE_CARGUE
FROM run_log r JOIN seen s USING (FUENTE, PERIODO_EJECUTADO_FAH)
UNION ALL
SELECT *, 1, TIMESTAMP '{RUN_TS}' FROM fresh ANTI JOIN seen USING (FUENTE, PERIODO_EJECUTADO_FAH)"""

MONTHS = ("WITH li AS (SELECT strftime(l_shipdate, '%Y-%m') AS mes, l_orderkey, l_linenumber FROM lineitem),"
          + O.groups_sql("li", "mes", MONTH_LIMIT))

ACCOUNT = "LEFT JOIN mapping h ON h.FUENTE = '{0}' AND h.CAMPO_ORIGEN = 'Cuenta' AND h.VALOR_ORIGEN = CAST(u.ctacon AS VARCHAR)".format(SOURCE)

ORACLE: dict[str, str] = {
    "ledger_product": PROD + " SELECT * FROM product",
    "ledger_product_day": O.with_product(limit=3, width=100, day=DAY, rerun="CAST(3 AS BIGINT)") + " SELECT * FROM product",
    "ledger_product_hot": REP + " SELECT * FROM product",
    "journal_lines": PROD + " SELECT * FROM journal",
    "scan_movements": LINES + " SELECT * FROM movements",
    "movements_projection": LINES + " SELECT * FROM movp",
    "filter_period": LINES + f" SELECT * FROM movp WHERE periodo = {DAY}",
    "filter_period_literal": LINES + f" SELECT * FROM movp WHERE CAST(periodo AS VARCHAR) = CAST({DAY} AS VARCHAR)",
    "filter_positive": LINES + " SELECT * FROM movp WHERE greatest(vlrdeb, vlrcre) > 0",
    "unpivot_movements": LINES + " SELECT * FROM unp",
    "scan_mapping": LINES + f" SELECT VALOR_ORIGEN, VALOR_SALIDA FROM mapping WHERE FUENTE = '{SOURCE}' AND CAMPO_ORIGEN = 'Cuenta'",
    "cross_join_counter": LINES + " SELECT * EXCLUDE (codigo_transaccion) FROM coded",
    "reprocess_counter": LINES + (" SELECT FUENTE, PERIODO_EJECUTADO_FAH, CAST(max(COALESCE(NUM_VECES_REPROCESADO, 0)) + 1 AS INTEGER) "
                                  "AS VAR_VALIDA_REPROCESO FROM run_log GROUP BY ALL"),
    "transaction_code": LINES + " SELECT * FROM coded",
    "line_numbers": PROD + " SELECT * EXCLUDE (targets) FROM numbered",
    "map_accounts": LINES + f" SELECT u.*, COALESCE(h.VALOR_SALIDA, CAST(u.ctacon AS VARCHAR)) AS cuenta FROM unp u {ACCOUNT}",
    "constant_columns": LINES + f"""
 SELECT * EXCLUDE (moneda_origen_raw, ctrcto), moneda_origen_raw AS moneda_origen, ctrcto AS dependencia,
        'COP' AS moneda, '{SOURCE}' AS descripcion, 'AK' AS tipo_de_comprobante,
        CAST(NULL AS VARCHAR) AS referencia, '{SOURCE}' AS tipo_evento, '{BOOK}' AS tipo_libro_contable,
        '{SOURCE}' AS origen_transaccion, 'MOVIMIENTO {SOURCE}' AS desc_origen_transaccion
 FROM unp""",
    "parameter_column": LINES + f" SELECT periodo, consecutivo_extraccion, naturaleza, valor_movimiento, '{BOOK}' AS tipo_libro_contable FROM unp",
    "transaction_counts": PROD + " SELECT periodo, codigo_transaccion, count(*) AS total_registros FROM journal GROUP BY ALL",
    "pending_periods": LINES + (f" SELECT DISTINCT periodo FROM movp WHERE periodo IS NOT NULL AND periodo NOT IN "
                                f"(SELECT PERIODO_EJECUTADO_FAH FROM run_log WHERE FUENTE = '{SOURCE}')"),
    "size_split": MONTHS + " SELECT mes, total_registros, es_grande FROM grouped",
    "large_group_rank": MONTHS + " SELECT mes, grandes_hasta AS rango_grande FROM grouped WHERE es_grande",
    "running_total": MONTHS + " SELECT mes, acumulado FROM grouped WHERE NOT es_grande",
    "balance_groups": MONTHS + " SELECT mes, total_registros, grupo_salida FROM grouped",
    "assign_groups_join": MONTHS + " SELECT mes, l_orderkey, l_linenumber, grupo_salida FROM li JOIN grouped USING (mes)",
    "balance_kept": REP + " SELECT periodo, codigo_transaccion, count(*) AS total_registros, any_value(grupo_salida) AS grupo_salida FROM product GROUP BY periodo, codigo_transaccion",
    "report_metadata": REP + METADATA,
    "report_header": REP + f" SELECT DISTINCT {_columns(HEADER)}, grupo_salida AS grupo, periodo FROM product",
    "report_lines": REP + f" SELECT {_columns(LINE)}, grupo_salida AS grupo, periodo FROM product",
    "report_control": REP + CONTROL,
    "control_line_counts": REP + " SELECT strftime(periodo, '%Y%m%d') AS periodo_formateado, grupo, lineas AS recuento FROM per_group",
    "control_header_counts": REP + " SELECT strftime(periodo, '%Y%m%d') AS periodo_formateado, grupo, cabeceras AS recuento FROM per_group",
    "distinct_groups": REP + " SELECT periodo, grupo FROM per_group",
    "layout_header": REP + f" SELECT {_columns(HEADER)} FROM product",
    "layout_lines": REP + f" SELECT {_columns(LINE)} FROM product",
    "output_columns": REP + f" SELECT periodo_formateado, tipo_registro, recuento FROM ({CONTROL})",
    "group_routing": REP + """
 SELECT periodo, codigo_transaccion, contador_linea, cuenta,
        IF(month(periodo) = 1, 'SIN_GRUPO', CAST(grupo_salida AS VARCHAR)) AS _file_group
 FROM product p WHERE month(periodo) = 1 OR contador_linea % 5 <> 0""",
    "report_split_by_group": REP + (f" SELECT 'ARCHIVO_CONTROL_{SOURCE}' AS report, periodo, CAST(grupo AS VARCHAR) AS grupo, CAST(0 AS BIGINT) AS parte, "
                                    f"periodo_formateado || ',' || tipo_registro || ',' || recuento AS value FROM ({CONTROL})"),
    "report_header_row": REP + f" SELECT 'ARCHIVO_HEADER_{SOURCE}' AS report, periodo, CAST(grupo AS VARCHAR) AS grupo, '{_names(HEADER)}' AS value FROM per_group",
    "sink_report_lines": REP + f"""
 SELECT 'ARCHIVO_LINES_{SOURCE}' AS report, periodo, CAST(grupo AS VARCHAR) AS grupo, CAST(0 AS BIGINT) AS parte, value
 FROM (SELECT periodo, grupo_salida AS grupo, {_line(LINE)} AS value FROM product
       UNION ALL SELECT periodo, grupo, '{_names(LINE)}' FROM per_group)""",
    "file_order": REP + f"""
 SELECT report, periodo, grupo, first(value ORDER BY orden, value) AS primera, last(value ORDER BY orden, value) AS ultima, count(*) AS lineas,
        CAST(sum(CAST('0x' || left(md5(antes || chr(10) || value), 8) AS BIGINT)) AS BIGINT) AS pares
 FROM (SELECT *, COALESCE(lag(value) OVER (PARTITION BY report, periodo, grupo ORDER BY orden, value), '') AS antes
       FROM (SELECT 'ARCHIVO_' || tipo || '_{SOURCE}' AS report, periodo, CAST(grupo AS VARCHAR) AS grupo, orden, value
             FROM (SELECT 'LINES' AS tipo, periodo, grupo_salida AS grupo, (codigo_transaccion, contador_linea) AS orden, {_line(LINE)} AS value FROM product
                   UNION ALL SELECT DISTINCT 'HEADER', periodo, grupo_salida, (codigo_transaccion, 0), {_line(HEADER)} FROM product
                   UNION ALL SELECT 'CONTROL', periodo, grupo, ('', IF(tipo_registro = 'LINE', 1, 2)),
                                    periodo_formateado || ',' || tipo_registro || ',' || recuento FROM ({CONTROL}))))
 GROUP BY ALL""",
    "run_manifest": FILES + """
 SELECT report, periodo, grupo, parte, registros, registros + cabecera AS lineas, total_archivos, archivo, 'delivery/' || archivo AS ruta, encoding,
        'TOTAL_REGISTROS:' || registros || ',GRUPO:' || grupo || ',FECHA:' || strftime(periodo, '%Y%m%d') || ',REPORTE:' || report AS trailer
 FROM files""",
    "file_names": FILES + " SELECT report, periodo, grupo, archivo FROM files",
    "trailer_line": FILES + (" SELECT report, periodo, grupo, concat_ws(',', 'TOTAL_REGISTROS:' || registros, 'GRUPO:' || grupo, "
                             "'FECHA:' || strftime(periodo, '%Y%m%d'), 'REPORTE:' || report) AS trailer FROM files"),
    "run_summary": FILES + (" SELECT count(*) AS archivos, CAST(sum(registros) AS BIGINT) AS registros_leidos, "
                            "CAST(sum(registros) AS BIGINT) AS registros_escritos, count(DISTINCT periodo) AS periodos FROM files"),
    "export_run": O.with_product(limit=8, width=40, more=files_sql(LOGGED)) + " SELECT archivo, registros + cabecera AS lineas FROM files",
    "sink_encoded_report": REP + f" SELECT CAST(grupo AS VARCHAR) AS grupo, periodo, file_content_string AS value FROM ({METADATA})",
    "query_source": REP + CONTROL,
    "query_parameters": REP + f" SELECT * FROM ({METADATA}) WHERE periodo BETWEEN DATE '1996-01-01' AND DATE '1996-06-01'",
    "query_identifiers": REP + """
 SELECT p.periodo, COALESCE(numero, 1) AS reproceso, lineas, cabeceras
 FROM (SELECT periodo, sum(lineas)::BIGINT AS lineas, sum(cabeceras)::BIGINT AS cabeceras FROM per_group GROUP BY periodo) p LEFT JOIN logged USING (periodo)""",
    "pending_by_files": LINES + (f" SELECT DISTINCT periodo FROM movp WHERE periodo IS NOT NULL AND NOT (month(periodo) % 4 = 0 AND periodo IN "
                                 f"(SELECT PERIODO_EJECUTADO_FAH FROM run_log WHERE FUENTE = '{SOURCE}'))"),
    "sink_replace_table": PROD + " SELECT * FROM product",
    "daily_feed": PROD + " SELECT * FROM product",
    "bucketed_header": REP + f" SELECT DISTINCT {_columns(HEADER)}, grupo_salida AS grupo, periodo FROM product",
    "bucketed_control": REP + CONTROL,
    "sink_overwrite_partition": O.with_product(rerun=f"IF(periodo = {DAY}, 3, $logged)") + " SELECT * FROM product",
    "run_log_upsert": LINES + "," + RUN_LOG_UPSERT,
    "fn_lpad": ("SELECT l_orderkey, l_linenumber, lpad(CAST(l_orderkey AS VARCHAR), 4, '0') AS seq4, "
                "lpad(CAST(l_linenumber AS VARCHAR), 1, '0') AS line1 FROM lineitem"),
    "fn_format_date": ("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS compacta, "
                       "strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso FROM orders"),
    "fn_normalise_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS desde_compacta, CAST(o_orderdate AS DATE) AS desde_iso FROM orders",
    "fn_source_from_name": (
        "SELECT event_id, "
        "NULLIF(regexp_extract('GENERAR_FAH_' || upper(event_type) || '_COMPLETO_ZIP', '^GENERAR_FAH_([A-Z0-9]+)_', 1), '') AS fuente, "
        "NULLIF(regexp_extract(event_type, '^GENERAR_FAH_([A-Z0-9]+)_', 1), '') AS sin_patron FROM events"),
    "fn_parse_tag": ("SELECT event_id, CASE WHEN json_valid(props) THEN "
                     "TRY_CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events"),
}
