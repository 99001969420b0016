"""DuckDB text of the fixture views and of the product, for the correctness oracle.

Written from the meaning of the steps, over a whole period at once and with literals of its own, so that it shares
nothing with the Spark plans (prefix-level sums, sliced line numbers) but the given tables.
NULL ordering is spelled out: Spark sorts NULL first, DuckDB last.
"""

from __future__ import annotations

SOURCE, BOOK = "SOURCEA", "BOOK_A"
LIMIT = 150000

# the three input views
VIEWS = f"""
movements AS (
  SELECT CAST(o.o_orderdate AS DATE) AS FECHA_EFECTIVA,
         CASE WHEN l.l_orderkey % 97 <> 0 THEN CAST(l.l_shipdate AS DATE) END AS FECHA_POSTEO,
         l.l_partkey AS CTACON, l.l_linestatus AS MONEDA, l.l_suppkey AS CTRCTO, l.l_orderkey AS CONSECUTIVO,
         o.o_orderpriority AS DESCRIPCION,
         CASE WHEN l.l_returnflag IN ('R', 'A') THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS VLRDEB,
         CASE l.l_returnflag WHEN 'N' THEN CAST(l.l_extendedprice AS DECIMAL(18,2))
              WHEN 'A' THEN CAST(round(l.l_discount * 100) AS DECIMAL(18,2))
              WHEN 'R' THEN CAST(0 AS DECIMAL(18,2)) END AS VLRCRE,
         CAST(date_trunc('month', CAST(o.o_orderdate AS DATE)) AS DATE) AS PERIODO,
         l.l_orderkey * 10 + l.l_linenumber AS CONSECUTIVO_EXTRACCION
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
mapping AS (
  SELECT '{SOURCE}' AS FUENTE, CASE WHEN p_partkey % 3 <> 0 THEN 'Cuenta' ELSE 'Oficina' END AS CAMPO_ORIGEN,
         CAST(p_partkey AS VARCHAR) AS VALOR_ORIGEN,
         unnest(CASE WHEN p_size > 45 THEN [p_brand, p_brand || '-B'] ELSE [p_brand] END) AS VALOR_SALIDA
  FROM part WHERE p_size > 25
),
run_log AS (
  SELECT event_type AS FUENTE, CAST(ts AS DATE) AS PERIODO_EJECUTADO_FAH,
         CAST(user_id % 5 AS INTEGER) AS NUM_VECES_REPROCESADO, CAST(ts AS TIMESTAMP) AS ULT_FECHA_DE_CARGUE
  FROM events
  UNION ALL
  SELECT DISTINCT '{SOURCE}', CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE),
         CAST(month(CAST(o_orderdate AS DATE)) // 2 - o_orderkey % 3 AS INTEGER), CAST(o_orderdate AS TIMESTAMP)
  FROM orders WHERE month(CAST(o_orderdate AS DATE)) % 2 = 0 AND o_orderkey % 5 = 0
),
movp AS (
  SELECT FECHA_EFECTIVA AS fecha_efectiva, FECHA_POSTEO AS fecha_posteo, CTACON AS ctacon,
         MONEDA AS moneda_origen_raw, CTRCTO AS ctrcto, CONSECUTIVO AS consecutivo,
         DESCRIPCION AS descripcion_origen, VLRDEB AS vlrdeb, VLRCRE AS vlrcre, PERIODO AS periodo,
         CONSECUTIVO_EXTRACCION AS consecutivo_extraccion
  FROM movements
),
accounts AS (
  SELECT VALOR_ORIGEN AS ctacon_text, list(VALOR_SALIDA) AS targets
  FROM mapping WHERE FUENTE = '{SOURCE}' AND CAMPO_ORIGEN = 'Cuenta' GROUP BY VALOR_ORIGEN
)"""


def lines_sql(day: str | None = None) -> str:
    """``unp``: an entry's two sides as lines, positive ones, of all days or of ``day`` (SQL text)."""
    return f"""
unp AS (
  SELECT m.*, IF(side = '1', vlrdeb, vlrcre) AS valor_movimiento, side AS naturaleza
  FROM movp m, (VALUES ('1'), ('2')) s(side)
  WHERE IF(side = '1', vlrdeb, vlrcre) > 0 AND periodo {"IS NOT NULL" if day is None else "= " + day}
)"""


def coded_sql(rerun: str | None = None) -> str:
    """``coded``: lines with the number of the run (``rerun``: SQL text instead of the log's, which is ``$logged``) and the code."""
    number = "COALESCE(numero, 1)" if rerun is None else rerun.replace("$logged", "COALESCE(numero, 1)")
    return f"""
logged AS (
  SELECT PERIODO_EJECUTADO_FAH AS periodo, CAST(max(NUM_VECES_REPROCESADO) + 1 AS BIGINT) AS numero
  FROM run_log WHERE FUENTE = '{SOURCE}' GROUP BY ALL
),
coded AS (
  SELECT *, 'AK' || strftime(fecha_efectiva, '%Y%m%d') || strftime(fecha_posteo, '%Y%m%d')
            || lpad(CAST(consecutivo AS VARCHAR), 4, '0') || left(CAST(codigo_reproceso AS VARCHAR), 1) AS codigo_transaccion
  FROM (SELECT unp.*, {number} AS codigo_reproceso FROM unp LEFT JOIN logged USING (periodo))
)"""


# line numbers and accounts in one step: the accounts of a line as a list, so that copies share the number
NUMBERED = """
numbered AS (
  SELECT coded.*, COALESCE(targets, [NULL]) AS targets,
         row_number() OVER (PARTITION BY periodo, codigo_transaccion ORDER BY consecutivo_extraccion NULLS FIRST,
           naturaleza NULLS FIRST, ctacon NULLS FIRST, ctrcto NULLS FIRST, valor_movimiento NULLS FIRST,
           moneda_origen_raw NULLS FIRST, consecutivo NULLS FIRST) AS contador_linea
  FROM coded LEFT JOIN accounts ON ctacon_text = CAST(ctacon AS VARCHAR)
)"""

JOURNAL = f"""
journal AS (
  SELECT fecha_efectiva, COALESCE(target, CAST(ctacon AS VARCHAR)) AS cuenta, 'COP' AS moneda,
         moneda_origen_raw AS moneda_origen, ctrcto AS dependencia, consecutivo, '{SOURCE}' AS descripcion,
         contador_linea, valor_movimiento, naturaleza, fecha_posteo, 'AK' AS tipo_de_comprobante,
         CAST(NULL AS VARCHAR) AS referencia, codigo_transaccion, '{SOURCE}' AS tipo_evento,
         '{BOOK}' AS tipo_libro_contable, '{SOURCE}' AS origen_transaccion,
         'MOVIMIENTO {SOURCE}' AS desc_origen_transaccion, periodo
  FROM (SELECT *, unnest(targets) AS target FROM numbered)
)"""


def groups_sql(rows: str, code: str, limit: int, width: int | None = None, day: str | None = None) -> str:
    """``grouped``: per code its lines and group, from one pass over the counts: large codes are counted, the others summed up."""
    part = f"PARTITION BY {day}" if day else ""
    head = f"{day}, " if day else ""
    return f"""
counted AS (SELECT {head}{code}, count(*) AS total_registros FROM {rows} GROUP BY ALL),
grouped AS (
  SELECT *, total_registros > {limit} AS es_grande,
         CAST(count(*) FILTER (total_registros > {limit}) OVER upto AS BIGINT) AS grandes_hasta,
         CAST(sum(total_registros) FILTER (total_registros <= {limit}) OVER upto AS BIGINT) AS acumulado,
         CAST(IF(total_registros > {limit}, count(*) FILTER (total_registros > {limit}) OVER upto,
                 count(*) FILTER (total_registros > {limit}) OVER ({part})
                 + (sum(total_registros) FILTER (total_registros <= {limit}) OVER upto - 1) // {width or limit} + 1) AS BIGINT) AS grupo_salida
  FROM counted WINDOW upto AS ({part} ORDER BY {code} NULLS FIRST)
)"""


def product_sql(limit: int, width: int | None = None) -> str:
    """``product``: each line with its group, by windows over the lines alone: a code's lines are counted on its rows and summed up on one of them."""
    return f"""
product AS (
  SELECT * EXCLUDE (periodo, total, primero, grandes_hasta, grandes, acumulado),
         CAST(IF(total > {limit}, grandes_hasta, grandes + (acumulado - 1) // {width or limit} + 1) AS BIGINT) AS grupo_salida, periodo
  FROM (SELECT *, count(*) FILTER (primero AND total > {limit}) OVER upto AS grandes_hasta,
               count(*) FILTER (primero AND total > {limit}) OVER (PARTITION BY periodo) AS grandes,
               sum(total) FILTER (primero AND total <= {limit}) OVER upto AS acumulado
        FROM (SELECT *, count(*) OVER same AS total, row_number() OVER same = 1 AS primero
              FROM journal WINDOW same AS (PARTITION BY periodo, codigo_transaccion))
        WINDOW upto AS (PARTITION BY periodo ORDER BY codigo_transaccion NULLS FIRST))
  WHERE codigo_transaccion IS NOT NULL
)"""


# lines and transactions per file group: what the control report and the files are made of
PER_GROUP = """
per_group AS (
  SELECT periodo, grupo_salida AS grupo, count(*) AS lineas, count(DISTINCT codigo_transaccion) AS cabeceras
  FROM product GROUP BY ALL
)"""


def with_product(limit: int = LIMIT, width: int | None = None, day: str | None = None, rerun: str | None = None,
                 more: str = "") -> str:
    """``WITH`` clause ending in ``product`` and ``per_group``, plus ``more`` tables."""
    parts = [VIEWS, lines_sql(day), coded_sql(rerun), NUMBERED, JOURNAL, product_sql(limit, width), PER_GROUP]
    return "WITH " + ",".join(parts + ([more] if more else []))


def with_lines(more: str = "") -> str:
    """``WITH`` clause of the views, the lines and the coded lines, plus ``more`` tables."""
    return "WITH " + ",".join([VIEWS, lines_sql(), coded_sql()] + ([more] if more else []))
