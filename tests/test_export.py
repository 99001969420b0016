"""Export (S7-S13, C9): golden bytes, encodings, file names, manifest = control."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ledgerweave.functions.filenames import file_name
from ledgerweave import catalog, session
from ledgerweave.plans import export
from ledgerweave.plans.run import export_feed, run_days
from ledgerweave.sources import fixtures
from ledgerweave.sources.fixtures import feed_params


def _files(root):
    out = {}
    for name in sorted(os.listdir(root)):
        if name.startswith("."):          # checksum files of the local file system
            continue
        with open(os.path.join(root, name), "rb") as fh:
            out[name] = fh.read()
    return out


def deliver(spark, df, spec, out, rerun=1, rows_per_file=None, piece_bytes=None):
    """One report through counts, manifest and delivery."""
    specs, loaded = {spec.name: spec}, {spec.name: df}
    rows = export.file_rows(specs, loaded, counts_of(spark), rows_per_file)
    man = session.materialize(export.manifest(rows, specs, rerun, str(out)), "manifest")
    export.write_files({spec.name: export.render_report(df, spec, rows_per_file=rows_per_file)}, specs, man, str(out), loaded=loaded, piece_bytes=piece_bytes)
    return man


def counts_of(spark):
    return spark.createDataFrame([], "periodo date, grupo long, lineas long, cabeceras long")


def test_golden_bytes(spark, tmp_path):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame([(2, None, "b", 1, day), (1, "x", "a", 1, day), (1, "y", None, 2, day)],
                               "ORDEN int, A string, B string, grupo long, periodo date")
    spec = export.ReportSpec(name="R", query="own text", header=True, delimiter=",", extension="txt",
                             template="R_{FORMATO_FECHA}_{CONTADOR}_de_{TOTAL_ARCHIVOS}_{VAR_REPROCESO}.{EXTENCION}")
    deliver(spark, df, spec, tmp_path / "out", 3)
    assert _files(tmp_path / "out") == {"R_20240105_1_de_2_3.txt": b"A,B\r\nx,a\r\n,b\r\n",
                                        "R_20240105_2_de_2_3.txt": b"A,B\r\ny,\r\n"}


def test_group_texts_that_are_no_folder_names(spark, tmp_path):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame([("a", "x/y:z=1%", day), ("b", "", day), ("c", "q r", None)], "A string, grupo string, periodo date")
    spec = export.ReportSpec(name="T", query="own text", template="T_{FORMATO_FECHA}_{CONTADOR}_{TOTAL_ARCHIVOS}.{EXTENCION}")
    deliver(spark, df, spec, tmp_path / "out")
    assert _files(tmp_path / "out") == {"T_20240105_x_y_z=1%_1.txt": b"a\r\n", "T__q_r_1.txt": b"c\r\n"}


def test_iso_8859_1_and_strict(spark, tmp_path):
    day = dt.date(2024, 1, 5)
    spec = export.ReportSpec(name="M", query="own text", encoding="ISO-8859-1", delimiter=None, extension=None,
                             template="M_{CONTADOR}.{EXTENCION}")
    ok = spark.createDataFrame([(1, "año", "x", 1, day)], "ORDEN int, A string, B string, grupo long, periodo date")
    deliver(spark, ok, spec, tmp_path / "o")
    assert _files(tmp_path / "o") == {"M_1.txt": "año;x\r\n".encode("latin-1")}   # ';' when no delimiter
    bad = spark.createDataFrame([(1, "日本", "x", 1, day)], "ORDEN int, A string, B string, grupo long, periodo date")
    with pytest.raises(Exception):
        deliver(spark, bad, spec, tmp_path / "bad")
    assert not (tmp_path / "bad").exists() or os.listdir(tmp_path / "bad") == []
    one_col = export.ReportSpec(name="E", query="own text", encoding="ISO-8859-1", template="E.{EXTENCION}")
    empty = spark.createDataFrame([(1, None, 1, day)], "ORDEN int, A string, grupo long, periodo date")
    deliver(spark, empty, one_col, tmp_path / "empty")
    assert _files(tmp_path / "empty") == {"E.txt": b"\r\n"}


def test_group_routing(spark):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame([("a", None, day), ("b", 0, day), ("c", 4, day), ("d", None, dt.date(2024, 1, 6))],
                               "A string, GRUPO long, periodo date")
    got = sorted((r["A"], r["_file_group"]) for r in export.group_routing(df).collect())
    assert got == [("c", "4"), ("d", "SIN_GRUPO")]


def test_file_name_rules(spark):
    df = spark.createDataFrame([("X {FORMATO_FECHA}/{{FORMATO_FECHA}}_1.{EXTENCION}", None),
                                ("Y_{CANTIDAD_REGISTROS}_{VAR_REPROCESO}.{EXTENCION}", "csv")],
                               "t string, e string")
    names = [r[0] for r in df.select(file_name(F.col("t"), F.lit("20240105"), F.lit(7), F.lit("2"), F.lit(3),
                                               F.lit(4), F.col("e"))).collect()]
    assert names == ["X_20240105_20240105_4.txt", "Y_7_4.csv"]


@pytest.mark.parametrize("settings", [{}, dict(large_limit=6, bin_width=30)])
def test_export_feed_end_to_end(spark, tmp_path, settings):
    folder = session.work_dir(spark, "").replace("file:", "")
    before = set(os.listdir(folder))
    res = export_feed(spark, SF0001, feed_params(**settings), root=str(tmp_path / "run"), loaded_at=dt.datetime(2026, 1, 1))
    assert set(os.listdir(folder)) <= before                     # the run's work tables are gone
    files = {r["archivo"]: r["lineas"] for r in res["files"].collect()}
    man = res["manifest"].collect()
    assert len(files) == len(man) and res["summary"]["REGISTROS_LEIDOS"] == sum(r["registros"] for r in man)
    on_disk = _files(tmp_path / "run" / "delivery")
    assert {n: b.count(b"\r\n") for n, b in on_disk.items()} == files
    for r in man:
        if r["report"].startswith("ARCHIVO_CONTROL"):
            lines = on_disk[r["archivo"]].decode().split("\r\n")
            same = [x for x in man if (x["periodo"], x["grupo"]) == (r["periodo"], r["grupo"])]
            by = {x["report"].split("_")[1]: x["registros"] for x in same}
            assert lines[0].endswith(f",LINE,{by['LINES']}") and lines[1].endswith(f",HEADER,{by['HEADER']}")
    checks = res["summary"]["CONTROLES"]
    assert checks["lineas_sin_codigo"] > 0 and checks["claves_mapeo_duplicadas"] > 0
    log = spark.read.parquet(res["run_log"])
    done = {r[0] for r in log.where("FUENTE = 'SOURCEA' AND ULT_FECHA_DE_CARGUE = TIMESTAMP_NTZ '2026-01-01 00:00:00'").select("PERIODO_EJECUTADO_FAH").distinct().collect()}
    assert done == {r["periodo"] for r in man}


def test_rows_per_file(spark, tmp_path):
    """With a number of rows per file every part has a name, a header row and a manifest row of its own."""
    day = dt.date(2024, 1, 5)
    rows = [("T1", n, 1, day) for n in range(1, 8)] + [("T2", 1, 2, day)]
    df = spark.createDataFrame(rows, "TRANSACTION_NUMBER string, LINE_NUMBER long, grupo long, periodo date")
    spec = export.ReportSpec(name="L", query="own text", header=True, delimiter=",", extension="csv", template="L_{CONTADOR}.{EXTENCION}")
    man = deliver(spark, df, spec, tmp_path / "o", rows_per_file=3).collect()
    assert {(m["grupo"], m["parte"], m["registros"], m["lineas"]) for m in man} == {("1", 0, 3, 4), ("1", 1, 3, 4), ("1", 2, 1, 2), ("2", 0, 1, 2)}
    head = b"TRANSACTION_NUMBER,LINE_NUMBER\r\n"
    assert _files(tmp_path / "o") == {"L_1.csv": head + b"T1,1\r\nT1,2\r\nT1,3\r\n", "L_1_1.csv": head + b"T1,4\r\nT1,5\r\nT1,6\r\n",
                                      "L_1_2.csv": head + b"T1,7\r\n", "L_2.csv": head + b"T2,1\r\n"}
    deliver(spark, df, spec, tmp_path / "whole")
    assert sorted(_files(tmp_path / "whole")) == ["L_1.csv", "L_2.csv"]


def test_command_line(spark, tmp_path):
    from ledgerweave.__main__ import main
    master, document = fixtures.registered(spark)
    tables = {"movements": fixtures.movements(spark, SF0001), "mapping": fixtures.account_mapping(spark, SF0001),
              "run-log": fixtures.run_log(spark, SF0001), "report-master": master, "report-document": document}
    args = []
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        args += [f"--{name}", str(tmp_path / name)]
    assert main([*args, "--master", fixtures.MASTER_NAME, "--source", fixtures.SOURCE, "--book", fixtures.BOOK,
                 "--from", "1995-07-01", "--to", "19950801", "--root", str(tmp_path / "run")]) == 0
    assert {n.split("_")[2] for n in _files(tmp_path / "run" / "delivery")} == {"19950701", "19950801"} - set()


def test_run_days():
    assert run_days("20240105", "2024-01-07") == tuple(dt.date(2024, 1, d) for d in (5, 6, 7))
    with pytest.raises(ValueError):
        run_days("20240105", "20240104")


def test_run_pending_then_nothing_left(spark, tmp_path):
    from ledgerweave.plans.run import run_pending
    mov = fixtures.movements(spark, SF0001).where(F.col("PERIODO") <= dt.date(1995, 3, 1))
    mapping, log = fixtures.account_mapping(spark, SF0001), fixtures.run_log(spark, SF0001)
    args = (feed_params(), fixtures.registered(spark), fixtures.MASTER_NAME)
    res = run_pending(spark, mov, mapping, log, *args, root=str(tmp_path / "run1"), loaded_at=dt.datetime(2026, 1, 1))
    days = {r["periodo"] for r in res["manifest"].select("periodo").distinct().collect()}
    assert dt.date(1995, 1, 1) in days and dt.date(1995, 2, 1) not in days           # the log has the even months
    new_log = spark.read.parquet(res["run_log"])
    assert run_pending(spark, mov, mapping, new_log, *args, root=str(tmp_path / "run2")) is None


def test_header_rows_compute_the_product_once(spark):
    """The manifest reads the counts from a work table, not the product again for every report."""
    plan = catalog.q_report_header_row(spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "codigo_transaccion" not in plan
