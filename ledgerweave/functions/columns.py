"""Scalar column expressions (F1-F14).  All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pattern of a master report name, GENERAR_FAH_<SOURCE>_..., and
# the JSON fields of the business tag of a report.
MASTER_NAME_PATTERN = r"^GENERAR_FAH_([A-Z0-9]+)_"
TAG_SCHEMA = T.StructType([
    T.StructField("formato", T.StringType()),
    T.StructField("entidad", T.StringType()),
])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lpad_zero(c: str | Column, width: int) -> Column:
    """``LPAD(s, n, '0')``: pads on the left and truncates to ``n`` from the left (F1)."""
    return F.lpad(_col(c).cast("string"), width, "0")


def format_date(c: str | Column, compact: bool = True) -> Column:
    """``FORMAT_DATE('%Y%m%d')`` (compact) or ``'%Y-%m-%d'``."""
    return F.date_format(_col(c), "yyyyMMdd" if compact else "yyyy-MM-dd")


def compact_day(c: str | Column) -> Column:
    """``format_date`` of a DATE by its numbers: a formatter takes most of the time of a code, twice a line."""
    day = _col(c).cast("date")
    number = F.year(day) * 10000 + F.month(day) * 100 + F.day(day)
    return F.when(F.year(day).between(1000, 9999), number.cast("string")).otherwise(format_date(day))


def transaction_code(voucher: str | Column, effective: str | Column, posted: str | Column,
                     sequence: str | Column, rerun: str | Column,
                     widths: tuple[int, int, int] = (2, 4, 1)) -> Column:
    """Voucher(2) + effective date(8) + posting date(8) + sequence(4) + re-run(1).

    ``F.concat`` propagates NULL like ``||``: a NULL date or sequence gives a
    NULL code (the transaction later vanishes in the group join).
    """
    v = F.lit(voucher) if isinstance(voucher, str) else voucher
    return F.concat(
        lpad_zero(v, widths[0]),
        compact_day(effective),
        compact_day(posted),
        lpad_zero(sequence, widths[1]),
        lpad_zero(rerun, widths[2]),
    )


def normalise_date(c: str | Column) -> Column:
    """'yyyyMMdd' or 'yyyy-MM-dd' text -> DATE."""
    return F.to_date(F.regexp_replace(_col(c), "-", ""), "yyyyMMdd")


def source_from_name(c: str | Column) -> Column:
    """Source system from a master report name, NULL when the name does not match."""
    return F.nullif(F.regexp_extract(_col(c), MASTER_NAME_PATTERN, 1), F.lit(""))


def parse_tag(c: str | Column, schema: T.StructType = TAG_SCHEMA) -> Column:
    """JSON business tag -> struct; malformed text gives a struct of NULLs."""
    return F.from_json(_col(c), schema, {"mode": "PERMISSIVE"})


def export_text(c: str | Column) -> Column:
    """Value -> text for export, NULL -> empty field.

    Amounts stay DECIMAL so they print as ``123.45``, never ``1.0E16``.
    """
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def delimited_line(cols: list[str], delimiter: str) -> Column:
    """One export line: fields joined by the delimiter, no quoting."""
    return F.concat_ws(delimiter, *[export_text(F.col(f"`{c}`")) for c in cols])


def effective_delimiter(delimiter: str | None) -> str:
    """Delimiter of a report; ``;`` when unset or ``{}`` (reference default)."""
    return delimiter if delimiter and delimiter != "{}" else ";"
