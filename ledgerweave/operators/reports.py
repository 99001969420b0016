"""The four reports over the product (C4-C7) and their fixed layouts.

Every report carries the technical columns ``grupo`` (file group) and
``periodo`` (processing date) so one job serves any number of days; the
exporter drops technical columns from the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.columns import format_date

GROUP = "grupo"
PERIOD = "periodo"

# Fixed values of the metadata report: version and the texts before it and before the application's name.
METADATA_VERSION = "3"
METADATA_TEXTS = ("Metadata version number : ", "Application Short Name : ")


def _null(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _names(prefix: str, first: int, last: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(first, last + 1)]


def header_fillers() -> list[str]:
    """NULL columns of the header layout, in order (71 columns)."""
    return (_names("Character", 5, 50) + _names("Number", 1, 10) + _names("Date", 1, 10)
            + _names("Long Character", 1, 5))


def header_layout() -> list[tuple[str, str | None]]:
    """(name, Spark SQL expression) of the 80 header columns; ``None`` marks a NULL filler."""
    real = [
        ("TRANSACTION_NUMBER", "codigo_transaccion"),
        ("EVENT_TYPE_CODE", "tipo_evento"),
        ("LEDGER_NAME", "tipo_libro_contable"),
        ("TRANSACTION_DATE", "date_format(fecha_efectiva, 'yyyy-MM-dd')"),
        ("TRANSACTION_REVERSAL_FLAG", "'N'"),
        ("DESCRIPCION_ORIGEN_TRANSACCION", "desc_origen_transaccion"),
        ("COMPROBANTE_CONTABLE", "tipo_de_comprobante"),
        ("ORIGEN_TRANSACCION", "origen_transaccion"),
        ("MONEDA", "moneda"),
    ]
    return real + [(n, None) for n in header_fillers()]


def lines_layout() -> list[tuple[str, str | None]]:
    """(name, Spark SQL expression) of the 147 lines columns; ``None`` marks a NULL filler."""
    head = [
        ("TRANSACTION_NUMBER", "codigo_transaccion"),
        ("LINE_NUMBER", "contador_linea"),
        ("COD_SUCURSAL", None),
        ("OFICINA_ORIGEN_TRANSACCION", "dependencia"),
        ("CUENTA_CONTABLE", "cuenta"),
        ("NATURALEZA", "naturaleza"),
        ("DESC_TRANSACCION", "desc_origen_transaccion"),
        ("REFERENCIA_01", "referencia"),
        ("REFERENCIA_02", "'0'"),
        ("TIPO_COMPROBANTE", "tipo_de_comprobante"),
    ]
    fill = [(n, None) for n in _names("Character", 9, 100) + _names("Number", 1, 2)]
    amounts = [("VALOR_COP_1", "valor_movimiento"), ("VALOR_MO_1", "valor_movimiento")]
    tail = [(n, None) for n in _names("Number", 5, 30) + _names("Date", 1, 10) + ["RAZON_SOCIAL_TITULAR"]
            + _names("Long Character", 2, 5)]
    return head + fill + amounts + tail


def apply_layout(layout: list[tuple[str, str | None]]) -> list[Column]:
    return [_null(n) if e is None else F.expr(e).alias(n) for n, e in layout]


def report_metadata(product: DataFrame, application: str) -> DataFrame:
    """Two text lines per (period, group) (C4): (ORDEN, file_content_string, grupo, periodo)."""
    groups = (product.where(F.col("grupo_salida").isNotNull())
              .select(F.col(PERIOD), F.col("grupo_salida").alias(GROUP)).distinct())
    lines = F.array(*[F.struct(F.lit(o).cast("int").alias("ORDEN"),
                               F.concat(F.lit(a), F.lit(b).cast("string")).alias("file_content_string"))
                      for o, (a, b) in enumerate(zip(METADATA_TEXTS, (METADATA_VERSION, application)), 1)])
    return (groups.select(F.inline(lines), GROUP, PERIOD)
            .select("ORDEN", "file_content_string", GROUP, PERIOD))


def report_header(product: DataFrame) -> DataFrame:
    """One row per distinct transaction and group (C5): 80 columns + grupo + periodo.

    DISTINCT runs on the nine real columns (the 71 NULL fillers are added
    after), with map-side partial deduplication.
    """
    layout = header_layout()
    real = [(n, e) for n, e in layout if e is not None]
    dedup = product.select(*[F.expr(e).alias(n) for n, e in real], F.col("grupo_salida").alias(GROUP),
                           PERIOD).distinct()
    return dedup.select(*[F.col(n) if e is not None else _null(n) for n, e in layout], GROUP, PERIOD)


def report_lines(product: DataFrame) -> DataFrame:
    """One row per line (C6): 147 columns + grupo + periodo; a pure projection."""
    return product.select(*apply_layout(lines_layout()), F.col("grupo_salida").alias(GROUP), PERIOD)


def control_counts(product: DataFrame) -> DataFrame:
    """LINE and HEADER counts per (period, group) from one aggregation.

    ``count`` is combined map-side; the distinct count is planned by Spark as
    a partial aggregation on (period, group, code) first, so a group holding
    one huge transaction is still reduced before the shuffle.
    """
    return (product.groupBy(PERIOD, F.col("grupo_salida").alias(GROUP))
            .agg(F.count(F.lit(1)).alias("lineas"), F.countDistinct("codigo_transaccion").alias("cabeceras")))


def report_control(product: DataFrame) -> DataFrame:
    """(periodo_formateado, tipo_registro, recuento, grupo, periodo) (C7): two rows per group."""
    c = control_counts(product)
    return c.select(
        format_date(PERIOD).alias("periodo_formateado"),
        F.expr("stack(2, 'LINE', lineas, 'HEADER', cabeceras) AS (tipo_registro, recuento)"),
        GROUP, PERIOD,
    ).select("periodo_formateado", "tipo_registro", "recuento", GROUP, PERIOD)


REPORTS = {"METADATA": report_metadata, "HEADER": report_header, "LINES": report_lines, "CONTROL": report_control}
