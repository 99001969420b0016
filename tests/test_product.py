"""Checked values of FIXTURES §3 and the invariants of SURVEY §5.2, at sf0.01."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from ledgerweave.functions.columns import compact_day, format_date
from ledgerweave.operators import journal, reports
from ledgerweave.sources.fixtures import feed_params
from ledgerweave.plans import product
from ledgerweave.sources import fixtures

DAY = dt.date(1995, 7, 1)


@pytest.fixture(scope="module")
def inputs(spark):
    return (fixtures.movements(spark, SF001), fixtures.account_mapping(spark, SF001),
            fixtures.run_log(spark, SF001))


@pytest.fixture(scope="module")
def day_product(spark, inputs):
    mov, mp, log = inputs
    p = feed_params(periods=(DAY,), rerun=3, large_limit=3, bin_width=100)
    return product.ledger_product(mov, mp, log, p).cache()


def test_movement_counts(inputs):
    mov = inputs[0]
    assert mov.count() == 60000
    assert mov.where(F.col("VLRDEB").isNotNull()).count() == 40074
    assert mov.where(F.col("PERIODO") == DAY).count() == 925


def test_debit_credit_lines(inputs):
    mov = journal.filter_period(journal.movements_projection(inputs[0]), [DAY])
    lines = journal.unpivot_movements(mov)
    agg = {r["naturaleza"]: (r["n"], r["s"]) for r in
           lines.groupBy("naturaleza").agg(F.count("*").alias("n"), F.sum("valor_movimiento").alias("s")).collect()}
    assert agg["1"] == (608, decimal.Decimal("31517615.68"))
    assert agg["2"] == (606, decimal.Decimal("17322421.37"))


def test_day_product_checked_values(day_product):
    p = day_product
    assert p.count() == 1297
    assert p.select("codigo_transaccion").distinct().count() == 920
    assert p.select("grupo_salida").distinct().count() == 32
    assert p.agg(F.sum("valor_movimiento")).first()[0] == decimal.Decimal("52118955.58")
    sizes = {r["grupo_salida"]: r["n"] for r in p.groupBy("grupo_salida").agg(F.count("*").alias("n")).collect()}
    # group 1 is that of the five lines without a code, which vanish; then the large codes, then bins of about 100
    assert {g: n for g, n in sizes.items() if g < 21} == {g: 4 for g in range(2, 21)}
    assert [sizes[g] for g in range(21, 34)] == [99, 101, 100, 100, 100, 100, 99, 101, 100, 99, 101, 99, 22]
    assert p.where(~F.col("cuenta").rlike("^[0-9]+$")).count() == 504
    ctl = reports.report_control(p)
    assert ctl.where(F.col("tipo_registro") == "HEADER").agg(F.sum("recuento")).first()[0] == 920


def test_codes_have_rerun_digit_and_truncated_sequence(day_product):
    codes = [r[0] for r in day_product.select("codigo_transaccion").distinct().collect()]
    assert all(len(c) == 23 and c.startswith("AK") and c.endswith("3") for c in codes)


def test_invariants(day_product):
    p = day_product
    # each code in exactly one group
    assert p.groupBy("codigo_transaccion").agg(F.countDistinct("grupo_salida").alias("g")).where("g != 1").count() == 0
    # line numbers are 1..n per code; copies made by duplicate mapping rows share them
    per = p.groupBy("codigo_transaccion").agg(F.count("*").alias("n"), F.min("contador_linea").alias("lo"),
                                              F.max("contador_linea").alias("hi"),
                                              F.countDistinct("contador_linea").alias("d"))
    assert per.where("lo != 1 OR hi != d OR n < d").count() == 0
    # control LINE / HEADER equal the lines and header reports per group
    ctl = reports.report_control(p)
    lines = reports.report_lines(p).groupBy("grupo").count()
    header = reports.report_header(p).groupBy("grupo").count()
    got_l = {r["grupo"]: r["recuento"] for r in ctl.where("tipo_registro = 'LINE'").collect()}
    got_h = {r["grupo"]: r["recuento"] for r in ctl.where("tipo_registro = 'HEADER'").collect()}
    assert got_l == {r["grupo"]: r["count"] for r in lines.collect()}
    assert got_h == {r["grupo"]: r["count"] for r in header.collect()}


def test_amounts_preserved_all_periods(spark, inputs):
    mov, mp, log = inputs
    lines = journal.unpivot_movements(journal.filter_period(journal.movements_projection(mov), None))
    prod = product.ledger_product(mov, mp, log, feed_params())
    # lines without a posting date have no code; accounts mapped twice give two lines
    mapped = journal.map_accounts(lines.where("fecha_posteo IS NOT NULL"), mp, feed_params())
    assert mapped.agg(F.sum("valor_movimiento")).first()[0] == prod.agg(F.sum("valor_movimiento")).first()[0]


def test_pending_periods(inputs):
    mov, _, log = inputs
    assert 0 < product.pending_periods(mov, log, "SOURCEA").count() < 80


def test_slicing_does_not_change_line_numbers(spark):
    """Forcing many slices per transaction (a tiny line_block) gives the same product."""
    from conftest import SF0001
    mov, mp, log = (fixtures.movements(spark, SF0001), fixtures.account_mapping(spark, SF0001),
                    fixtures.run_log(spark, SF0001))
    a = product.ledger_product(mov, mp, log, feed_params(line_block=2))
    b = product.ledger_product(mov, mp, log, feed_params())
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_code_is_stored_once(spark):
    lines = product._work_table(fixtures.movements(spark, SF0001), fixtures.run_log(spark, SF0001), fixtures.feed_params())
    assert "codigo_transaccion" not in lines.columns and "_tkey" in lines.columns


def test_day_of_a_code_is_the_formatted_day(spark):
    days = ["0001-01-01", "0999-12-31", "1000-01-01", "1996-02-29", "9999-12-31", "10000-01-01", "-0044-03-15"]
    df = spark.range(1).selectExpr(f"explode(array({', '.join(f'''date'{d}' ''' if len(d) == 10 else f'''cast('{d}' as date)''' for d in days)}, cast(null as date))) as d")
    rows = df.select(compact_day("d").alias("a"), format_date("d").alias("b"), "d").select("a", "b").collect()
    assert len(rows) == 8 and all(r.a == r.b for r in rows)
