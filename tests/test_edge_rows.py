"""Edge rows on a hand-made movements table, against brute-force expectations."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerweave.sources.fixtures import feed_params
from ledgerweave.plans import export, product

SCHEMA = ("FECHA_EFECTIVA date, FECHA_POSTEO date, CTACON long, MONEDA string, CTRCTO long, CONSECUTIVO long, "
          "DESCRIPCION string, VLRDEB decimal(18,2), VLRCRE decimal(18,2), PERIODO date, CONSECUTIVO_EXTRACCION long")
MAP_SCHEMA = "FUENTE string, CAMPO_ORIGEN string, VALOR_ORIGEN string, VALOR_SALIDA string"
LOG_SCHEMA = "FUENTE string, PERIODO_EJECUTADO_FAH date, NUM_VECES_REPROCESADO int, ULT_FECHA_DE_CARGUE timestamp_ntz"
D1 = dt.date(2024, 3, 1)
D2 = dt.date(2024, 3, 2)


@pytest.fixture(scope="module")
def frames(spark):
    e, p = dt.date(2024, 3, 1), dt.date(2024, 3, 4)
    rows = [
        (e, p, 10, "COP", 1, 7, "a", D("5.00"), D("3.00"), D1, 70),        # both sides positive
        (e, p, 11, "COP", 1, 7, "b", D("0.00"), D("-1.00"), D1, 71),       # zero and negative: no line
        (e, p, 12, "COP", 1, 7, "c", None, D("2.50"), D1, 72),             # NULL debit
        (None, p, 13, "COP", 1, 8, "d", D("9.00"), None, D1, 73),          # NULL date: NULL code
        (e, p, 14, "COP", 1, 12345, "e", D("1.00"), None, D1, 74),         # sequence truncates to 1234
        (e, p, 15, "COP", 1, 1234, "f", D("1.00"), None, D1, 75),          # ... and collides with 1234
        (e, p, 16, "COP", 1, 9, "g", D("4.00"), None, D2, 80),             # second day, re-run 10
        (e, p, 17, "COP", 1, 9, "h", D("4.00"), None, None, 81),           # NULL period: never processed
    ]
    mov = spark.createDataFrame(rows, SCHEMA)
    mapping = spark.createDataFrame([
        ("SOURCEA", "Cuenta", "10", "A10"), ("SOURCEA", "Cuenta", "10", "B10"),   # duplicate key
        ("SOURCEA", "Cuenta", "12", None),                                          # NULL target
        ("OTRA", "Cuenta", "14", "X"), ("SOURCEA", "Otro", "15", "Y"),              # other source / field
    ], MAP_SCHEMA)
    log = spark.createDataFrame([
        ("SOURCEA", D2, 9, dt.datetime(2024, 3, 3)), ("SOURCEA", D2, 4, dt.datetime(2024, 3, 2)),
        ("OTRA", D1, 5, dt.datetime(2024, 3, 2)),
    ], LOG_SCHEMA)
    return mov, mapping, log


def test_journal_lines_edge_rows(frames):
    mov, mapping, log = frames
    j = product.journal_lines(mov, mapping, log, feed_params())
    got = sorted(((r["periodo"], r["codigo_transaccion"], r["cuenta"], r["naturaleza"], r["valor_movimiento"],
                  r["contador_linea"]) for r in j.collect()), key=repr)
    c7 = "AK202403012024030400071"
    c1234 = "AK202403012024030412341"
    want_codes = {r[1] for r in got}
    assert c7 in want_codes and c1234 in want_codes and None in want_codes
    # duplicate mapping rows multiply the debit line of account 10, with the same line number
    lines_10 = [r for r in got if r[1] == c7 and r[4] == D("5.00")]
    assert sorted(r[2] for r in lines_10) == ["A10", "B10"] and {r[5] for r in lines_10} == {1}
    # NULL target falls back to the account
    assert [r[2] for r in got if r[4] == D("2.50")] == ["12"]
    # mapping rows of another source or field are ignored
    assert {r[2] for r in got if r[1] == c1234} == {"14", "15"}
    # both-sided row gives two lines, numbered by extraction sequence then nature
    assert sorted((r[3], r[5]) for r in got if r[1] == c7 and r[2] != "B10") == [("1", 1), ("2", 2), ("2", 3)]
    # NULL period is not processed; zero/negative amounts make no line
    assert all(r[0] is not None for r in got)
    assert not any(r[4] <= 0 for r in got)
    # re-run for day 2 is max(9, 4) + 1 = 10, truncated to one digit by LPAD
    day2 = [r[1] for r in got if r[0] == D2]
    assert day2 and all(c.endswith("1") and c[-5:-1] == "0009" for c in day2)


def test_product_drops_null_code_and_groups(frames):
    mov, mapping, log = frames
    p = product.ledger_product(mov, mapping, log, feed_params(large_limit=1, bin_width=2))
    rows = p.collect()
    assert all(r["codigo_transaccion"] is not None for r in rows)
    # day 1 codes: NULL (1 line, vanishes), c1234 (2 lines), c7 (4 lines): both large (> 1)
    g = {r["codigo_transaccion"]: r["grupo_salida"] for r in rows if r["periodo"] == D1}
    assert sorted(g.values()) == [1, 2]
    assert g["AK202403012024030400071"] == 1


def test_empty_day(spark, frames):
    mov, mapping, log = frames
    p = product.ledger_product(mov, mapping, log, feed_params(periods=(dt.date(2030, 1, 1),)))
    assert p.count() == 0 and len(p.columns) == 20


def test_feed_checks_count_the_quirks(frames):
    from ledgerweave.plans.run import feed_checks
    mov, mapping, log = frames
    table, transactions = product.product_and_transactions(mov, mapping, log, feed_params())
    checks = feed_checks(transactions, mapping, table.agg(*export.product_totals(table)).first().asDict(), feed_params())
    # 12345 and 1234 share code ...12341; the NULL-date line has no code; key 10 has two rows
    assert checks == {"codigos_con_colision": 1, "lineas_sin_codigo": 1, "claves_mapeo_duplicadas": 1,
                      "valores_con_delimitador": 0}


def runs(spark, frames, root, params, **kwargs):
    from ledgerweave.plans.run import run_feed
    from ledgerweave.sources import fixtures
    mov, mapping, log = frames
    return run_feed(spark, mov, mapping, kwargs.pop("log", log), params, kwargs.pop("registered", fixtures.registered(spark)), fixtures.MASTER_NAME, str(root), **kwargs)


def test_fixed_number_is_used_everywhere(spark, frames, tmp_path):
    """The run's number in codes, file names and the log is one and the same."""
    res = runs(spark, frames, tmp_path, feed_params(periods=(D1,), rerun=7))
    files = [r["archivo"] for r in res["files"].collect()]
    assert files and all(f.rsplit(".", 1)[0].endswith("_7") for f in files)
    log = spark.read.parquet(res["run_log"]).where("FUENTE = 'SOURCEA'")
    assert [r["NUM_VECES_REPROCESADO"] for r in log.where(F.col("PERIODO_EJECUTADO_FAH") == D1).collect()] == [7]
    codes = spark.read.parquet(f"{tmp_path}/product").select("codigo_transaccion").collect()
    assert all(c[0].endswith("7") for c in codes)


def test_empty_day_ends_cleanly(spark, frames, tmp_path):
    with pytest.warns(UserWarning, match="no movements"):
        res = runs(spark, frames, tmp_path, feed_params(periods=(dt.date(2030, 1, 1),)))
    assert res["summary"]["ARCHIVOS"] == 0 and res["run_log"] is None


def test_no_sub_reports_end_cleanly(spark, frames, tmp_path):
    from ledgerweave.sources import fixtures
    master, document = fixtures.registered(spark)
    only_master = document.where("EXTENSION = 'zip'")
    with pytest.warns(UserWarning, match="sub-reports"):
        res = runs(spark, frames, tmp_path, feed_params(periods=(D1,)), registered=(master, only_master))
    assert res["run_log"] is None and not (tmp_path / "product").exists()


def test_second_run_in_the_same_folder(spark, frames, tmp_path):
    """Another day in the same lasting folder leaves the first alone; the same day again replaces its files and counts up."""
    one = runs(spark, frames, tmp_path, feed_params(periods=(D1,)))
    two = runs(spark, frames, tmp_path, feed_params(periods=(D2,)))
    assert {r["periodo"] for r in two["manifest"].collect()} == {D2}
    assert {r["periodo"] for r in spark.read.parquet(f"{tmp_path}/product").select("periodo").distinct().collect()} == {D1, D2}
    log = spark.read.parquet(one["run_log"])
    again = runs(spark, frames, tmp_path, feed_params(periods=(D1,)), log=log)
    assert {r["archivo"].rsplit("_", 1)[1] for r in one["files"].collect()} == {"1.txt", "1.csv"}
    assert {r["archivo"].rsplit("_", 1)[1] for r in again["files"].collect()} == {"2.txt", "2.csv"}
    retry = runs(spark, frames, tmp_path, feed_params(periods=(D1,)), log=log)        # as after a failure
    assert sorted(map(tuple, retry["files"].collect())) == sorted(map(tuple, again["files"].collect()))


def test_report_goes_to_its_own_destination(spark, frames, tmp_path):
    from ledgerweave.sources import fixtures
    master, document = fixtures.registered(spark)
    document = document.withColumn("RUTA_DESTINO", F.when(F.col("NOMBRE_REPORTE").contains("CONTROL"), f"{tmp_path}/elsewhere"))
    runs(spark, frames, tmp_path, feed_params(periods=(D1,)), registered=(master, document))
    assert [p for p in (tmp_path / "elsewhere").iterdir() if p.name.startswith("XlaCtl")]
    assert not [p for p in (tmp_path / "delivery").iterdir() if p.name.startswith("XlaCtl")]
