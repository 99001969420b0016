"""Registry (S14, J4, P13, P14, C8) and scalar functions F10-F12 on config-sized inputs."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerweave.functions.columns import normalise_date, parse_tag, source_from_name
from ledgerweave.operators import registry_ops
from ledgerweave.sources import registry

DAY = dt.date(2026, 1, 1)
SOURCE = "SOURCEB"


def test_registry_upsert_idempotent(spark):
    master, document = registry.registry_frames(spark, SOURCE, DAY)
    once = registry_ops.keyed_replace(master, master, ["ID_PRODUCTO_DATOS", "NOMBRE_TABLA"])
    twice = registry_ops.keyed_replace(once, master, ["ID_PRODUCTO_DATOS", "NOMBRE_TABLA"])
    assert once.count() == 5 and sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    newer, _ = registry.registry_frames(spark, SOURCE, dt.date(2026, 2, 1))
    replaced = registry_ops.keyed_replace(master, newer.where("ID_PRODUCTO_DATOS = 20"),
                                          ["ID_PRODUCTO_DATOS", "NOMBRE_TABLA"])
    dates = {r["ID_PRODUCTO_DATOS"]: r["FECHA_REGISTRO"] for r in replaced.collect()}
    assert dates[20] == dt.date(2026, 2, 1) and dates[19] == DAY and len(dates) == 5


def test_master_lookup_and_discovery(spark):
    master, document = registry.registry_frames(spark, SOURCE, DAY)
    m = registry_ops.master_lookup(document, master, "GENERAR_FAH_SOURCEB_COMPLETO_ZIP").collect()
    assert len(m) == 1 and m[0]["fuente"] == SOURCE and m[0]["tag"]["entidad"] == "ZIP"
    assert registry_ops.master_lookup(document, master, "NO_SUCH").count() == 0
    sql_rows = registry_ops.subreport_discovery(spark, document, master, m[0]["QUERY"],
                                                {"product": "FAH", "source": SOURCE}).collect()
    names = [r["NOMBRE_REPORTE"] for r in sql_rows]
    assert names == sorted(names) and len(names) == 4 and all("ZIP" not in n for n in names)
    df_rows = registry_ops.subreports(document, master, "FAH", "sourceb").collect()
    assert [r["NOMBRE_REPORTE"] for r in df_rows] == names


def test_inactive_and_null_extension_are_skipped(spark):
    master, document = registry.registry_frames(spark, SOURCE, DAY)
    doc = (document.withColumn("FLAG_ACTIVO", F.when(F.col("ID_PRODUCTO_DATOS") == 19, False)
                               .otherwise(F.col("FLAG_ACTIVO")))
           .withColumn("EXTENSION", F.when(F.col("ID_PRODUCTO_DATOS") == 20, None).otherwise(F.col("EXTENSION"))))
    names = [r["NOMBRE_REPORTE"] for r in registry_ops.subreports(doc, master, "FAH", SOURCE).collect()]
    assert names == ["ARCHIVO_CONTROL_SOURCEB", "ARCHIVO_LINES_SOURCEB"]


def test_scalar_functions(spark):
    df = spark.createDataFrame([("20240105", "GENERAR_FAH_OTHERONE_COMPLETO_ZIP", '{"formato": "X", "entidad": "Y"}'),
                                ("2024-01-05", "OTRO", "{not json"), (None, None, None)],
                               "d string, n string, t string")
    out = df.select(normalise_date("d").alias("d"), source_from_name("n").alias("s"),
                    parse_tag("t").alias("t")).collect()
    assert out[0]["d"] == out[1]["d"] == dt.date(2024, 1, 5) and out[2]["d"] is None
    assert out[0]["s"] == "OTHERONE" and out[1]["s"] is None and out[2]["s"] is None
    assert out[0]["t"]["formato"] == "X" and out[1]["t"] is None or out[1]["t"]["formato"] is None
