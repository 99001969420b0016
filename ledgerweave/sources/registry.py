"""Report registry: master rows and document (file) settings of the five reports.

The reference stores each report as a row whose QUERY column is SQL text.
Here the stored text is Spark SQL over the view ``ledger_product`` (the
product of the run being exported) with named parameter markers, run by
``spark.sql(text, args=...)``; the master report stores the discovery query
over the registry views.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerweave.operators.reports import header_layout, lines_layout

MASTER_SCHEMA = T.StructType([
    T.StructField("ID_PRODUCTO_DATOS", T.IntegerType()),
    T.StructField("ID_TIPO_PROCESO", T.IntegerType()),
    T.StructField("NOMBRE_PRODUCTO_DATOS", T.StringType()),
    T.StructField("TAG_NEGOCIO", T.StringType()),
    T.StructField("DATASET_DESTINO_MST", T.StringType()),
    T.StructField("NOMBRE_TABLA", T.StringType()),
    T.StructField("CATEGORIA_VOLUMETRIA", T.StringType()),
    T.StructField("QUERY", T.StringType()),
    T.StructField("AUTOMATIZACION", T.StringType()),
    T.StructField("PERIODICIDAD", T.StringType()),
    T.StructField("FLAG_ACTIVO", T.BooleanType()),
    T.StructField("FLAG_NOTIFICACION", T.BooleanType()),
    T.StructField("CORREO_NOTIFICACION", T.StringType()),
    T.StructField("ASUNTO", T.StringType()),
    T.StructField("CUERPO", T.StringType()),
    T.StructField("FLG_ADJUNTOS", T.BooleanType()),
    T.StructField("FECHA_REGISTRO", T.DateType()),
])

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("ID_PRODUCTO_DATOS", T.IntegerType()),
    T.StructField("NOMBRE_PRODUCTO_DATOS", T.StringType()),
    T.StructField("ID_REPORTE", T.StringType()),
    T.StructField("NOMBRE_REPORTE", T.StringType()),
    T.StructField("TIPO_SALIDA", T.StringType()),
    T.StructField("TIPO_EJECUCION", T.StringType()),
    T.StructField("SCRIPT_PATH", T.StringType()),
    T.StructField("FILTRO", T.StringType()),
    T.StructField("ENCODING", T.StringType()),
    T.StructField("FORMATO_NOMBRE_ARCHIVO", T.StringType()),
    T.StructField("EXTENSION", T.StringType()),
    T.StructField("DELIMITADOR", T.StringType()),
    T.StructField("FLAG_ENCABEZADO", T.BooleanType()),
    T.StructField("RUTA_DESTINO", T.StringType()),
    T.StructField("FORMATO_FECHA", T.StringType()),
    T.StructField("N_REGISTROS_X_ARCHIVO", T.IntegerType()),
    T.StructField("FLAG_COMPLETITUD_INFORMACION", T.BooleanType()),
    T.StructField("FLAG_CONSECUTIVO", T.BooleanType()),
    T.StructField("CONSECUTIVO_INICIO", T.IntegerType()),
    T.StructField("CONSECUTIVO_FIN", T.IntegerType()),
    T.StructField("FLAG_ACTIVO", T.BooleanType()),
    T.StructField("FECHA_REGISTRO", T.DateType()),
])


def _select_list(layout) -> str:
    return ",\n       ".join(f"CAST(NULL AS STRING) AS `{n}`" if e is None else f"{e} AS `{n}`" for n, e in layout)


METADATA_SQL = """
SELECT o.ORDEN, o.file_content_string, g.grupo, g.periodo
FROM (SELECT DISTINCT grupo_salida AS grupo, periodo FROM IDENTIFIER(:producto)
      WHERE grupo_salida IS NOT NULL AND (:desde IS NULL OR periodo BETWEEN :desde AND :hasta)) g
LATERAL VIEW inline(array(
  named_struct('ORDEN', 1, 'file_content_string', concat('Metadata version number : ', CAST(:version AS STRING))),
  named_struct('ORDEN', 2, 'file_content_string', concat('Application Short Name : ', CAST(:application AS STRING)))
)) o
"""

HEADER_SQL = f"""
SELECT {_select_list(header_layout())},
       grupo, periodo
FROM (SELECT DISTINCT codigo_transaccion, tipo_evento, tipo_libro_contable, fecha_efectiva,
                      desc_origen_transaccion, tipo_de_comprobante, origen_transaccion, moneda,
                      grupo_salida AS grupo, periodo
      FROM IDENTIFIER(:producto) WHERE :desde IS NULL OR periodo BETWEEN :desde AND :hasta)
"""

LINES_SQL = f"""
SELECT {_select_list(lines_layout())},
       grupo_salida AS grupo, periodo
FROM IDENTIFIER(:producto) WHERE :desde IS NULL OR periodo BETWEEN :desde AND :hasta
"""

CONTROL_SQL = """
WITH c AS (
  SELECT periodo, grupo_salida AS grupo, count(1) AS lineas, count(DISTINCT codigo_transaccion) AS cabeceras
  FROM IDENTIFIER(:producto) WHERE :desde IS NULL OR periodo BETWEEN :desde AND :hasta
  GROUP BY periodo, grupo_salida
)
SELECT date_format(periodo, 'yyyyMMdd') AS periodo_formateado, t.tipo_registro, t.recuento, grupo, periodo
FROM c LATERAL VIEW stack(2, 'LINE', lineas, 'HEADER', cabeceras) t AS tipo_registro, recuento
"""

# a text that reads the run's numbers, one a day
RUNS_SQL = """
SELECT p.periodo, CAST(n.rerun AS BIGINT) AS reproceso, count(1) AS lineas, count(DISTINCT p.codigo_transaccion) AS cabeceras
FROM IDENTIFIER(:producto) p JOIN IDENTIFIER(:numeros) n ON p.periodo = n.periodo
WHERE :desde IS NULL OR p.periodo BETWEEN :desde AND :hasta
GROUP BY p.periodo, n.rerun
"""

DISCOVERY_SQL = """
SELECT d.ID_PRODUCTO_DATOS, d.NOMBRE_REPORTE, d.ENCODING, d.FORMATO_NOMBRE_ARCHIVO, d.EXTENSION, d.DELIMITADOR,
       d.FLAG_ENCABEZADO, d.RUTA_DESTINO, d.FLAG_CONSECUTIVO, d.CONSECUTIVO_INICIO, d.CONSECUTIVO_FIN,
       d.FORMATO_FECHA, m.QUERY AS SQL_SUBREPORTE, m.TAG_NEGOCIO
FROM report_document d
JOIN report_master m ON d.ID_PRODUCTO_DATOS = m.ID_PRODUCTO_DATOS AND d.NOMBRE_PRODUCTO_DATOS = m.NOMBRE_PRODUCTO_DATOS
WHERE d.FLAG_ACTIVO = TRUE
  AND d.NOMBRE_PRODUCTO_DATOS = :product
  AND upper(d.NOMBRE_REPORTE) LIKE concat('%', upper(:source), '%')
  AND d.EXTENSION != 'zip'
ORDER BY d.NOMBRE_REPORTE
"""

PRODUCT_NAME = "FAH"
KINDS = ("METADATA", "HEADER", "LINES", "CONTROL")
# Fixed values of the five registered reports, by kind:
# (id, stored text, encoding, file prefix, extension, delimiter, header flag)
REPORT_KINDS = {
    "METADATA": (19, METADATA_SQL, "ISO-8859-1", "Metadata", "txt", ",", False),
    "HEADER": (20, HEADER_SQL, "UTF-8", "XlaTrxH", "csv", ",", True),
    "LINES": (21, LINES_SQL, "UTF-8", "XlaTrxL", "csv", ",", True),
    "CONTROL": (22, CONTROL_SQL, "UTF-8", "XlaCtl", "txt", ",", False),
    "ZIP": (23, DISCOVERY_SQL, "UTF-8", "XlaTransaction", "zip", None, False),
}
NAME_TEMPLATE = "{prefix}_{source}_{{FORMATO_FECHA}}_{{CONTADOR}}_de_{{TOTAL_ARCHIVOS}}_{{VAR_REPROCESO}}.{{EXTENCION}}"


def report_name(kind: str, source: str) -> str:
    return f"GENERAR_FAH_{source}_COMPLETO_ZIP" if kind == "ZIP" else f"ARCHIVO_{kind}_{source}"


def registry_rows(source: str, registered: dt.date, destination: str | None = None):
    """Master and document rows of the five reports of ``source``, registered on ``registered``."""
    master, document = [], []
    for kind, (rid, query, encoding, prefix, extension, delimiter, header) in REPORT_KINDS.items():
        name, bundle = report_name(kind, source), kind == "ZIP"
        table, dataset = (name, "reports") if bundle else (f"{source}_FAH", "ledger")
        entity = "ZIP" if bundle else "ARCHIVO"
        tag = f'{{"formato": "{name}", "entidad": "{entity}"}}'
        master.append((rid, 1, PRODUCT_NAME, tag, dataset, table, "BAJA", query, None, "Diaria", True, False,
                       None, None, None, False, registered))
        document.append((rid, PRODUCT_NAME, f"RPT-{source}-{entity}-V1", name, "Archivo", "PySpark" if bundle else "SQL",
                         None, None, encoding, NAME_TEMPLATE.format(prefix=prefix, source=source), extension, delimiter,
                         header, destination, "YYYYMMDD", None, True, False, None, None, True, registered))
    return master, document


def registry_frames(spark: SparkSession, source: str, registered: dt.date,
                    destination: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(report_master, report_document) DataFrames (config-sized: five rows each)."""
    master, document = registry_rows(source, registered, destination)
    return (spark.createDataFrame(master, MASTER_SCHEMA), spark.createDataFrame(document, DOCUMENT_SCHEMA))
