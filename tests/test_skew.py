"""A hot transaction: every movement of the table in one code.

The movements are the driver's lineitem/orders rows with the dates and the
sequence made constant, so the whole table is one transaction of one day.
The product must equal the direct-window oracle, and the line numbering must
be spread over many slices (no task holds the transaction).
"""

import datetime as dt

from pyspark.sql import functions as F

import oracle_harness as H
from conftest import SF001
from ledgerweave import oracle_sql as O
from ledgerweave import session
from ledgerweave.operators import journal, numbering
from ledgerweave.sources.fixtures import feed_params
from ledgerweave.plans import product
from ledgerweave.sources import fixtures

DAY = dt.date(2024, 6, 1)


def hot_movements(spark):
    return (fixtures.movements(spark, SF001)
            .withColumn("FECHA_EFECTIVA", F.lit(DAY)).withColumn("FECHA_POSTEO", F.lit(DAY))
            .withColumn("CONSECUTIVO", F.lit(1).cast("long")).withColumn("PERIODO", F.lit(DAY)))


def hot_sql(limit):
    sql = O.with_product(limit=limit) + " SELECT * FROM product"
    return sql.replace("CAST(o.o_orderdate AS DATE) AS FECHA_EFECTIVA", f"DATE '{DAY}' AS FECHA_EFECTIVA") \
              .replace("CASE WHEN l.l_orderkey % 97 <> 0 THEN CAST(l.l_shipdate AS DATE) END AS FECHA_POSTEO", f"DATE '{DAY}' AS FECHA_POSTEO") \
              .replace("l.l_orderkey AS CONSECUTIVO,", "CAST(1 AS BIGINT) AS CONSECUTIVO,") \
              .replace("CAST(date_trunc('month', CAST(o.o_orderdate AS DATE)) AS DATE) AS PERIODO",
                       f"DATE '{DAY}' AS PERIODO")


def test_hot_transaction_matches_oracle(spark, duck001):
    p = feed_params(line_block=4096, large_limit=1000)
    mov, mp, log = hot_movements(spark), fixtures.account_mapping(spark, SF001), fixtures.run_log(spark, SF001)
    q = lambda s, sf: product.ledger_product(mov, mp, log, p)
    r = H.compare(spark, SF001, q, hot_sql(1000), duck001)
    assert r["ok"], r
    out = q(spark, SF001)
    assert out.select("codigo_transaccion").distinct().count() == 1
    assert out.agg(F.max("contador_linea")).first()[0] == out.select("contador_linea").distinct().count()


def test_hot_transaction_is_sliced(spark):
    p = feed_params(line_block=4096)
    coded = session.materialize(journal.coded_lines(hot_movements(spark), fixtures.run_log(spark, SF001), p))
    keys = [journal.TKEY]
    large = numbering.key_rows(coded, keys).where(F.col(numbering.KEY_ROWS) > p.line_block)
    bounds = numbering.slice_bounds(coded, large, keys, "consecutivo_extraccion", p.line_block)
    per = numbering.with_slices(coded, bounds, keys, "consecutivo_extraccion").groupBy(journal.TKEY, numbering.SLICE).count()
    stats = per.agg(F.count("*").alias("slices"), F.max("count").alias("biggest"), F.sum("count").alias("n")).first()
    assert stats["slices"] >= stats["n"] // p.line_block and stats["biggest"] <= 1.2 * p.line_block


def copies_movements(spark):
    """Every movement with the same extraction sequence and dates: one slice holds everything."""
    return (hot_movements(spark).withColumn("CONSECUTIVO_EXTRACCION", F.lit(7).cast("long")))


def test_copies_in_one_slice(spark, duck001):
    p = feed_params(line_block=4096, large_limit=1000, hot_slice_rows=2000)
    mov, mp, log = copies_movements(spark), fixtures.account_mapping(spark, SF001), fixtures.run_log(spark, SF001)
    q = lambda s, sf: product.ledger_product(mov, mp, log, p)
    sql = hot_sql(1000).replace("l.l_orderkey * 10 + l.l_linenumber AS CONSECUTIVO_EXTRACCION",
                                "CAST(7 AS BIGINT) AS CONSECUTIVO_EXTRACCION")
    r = H.compare(spark, SF001, q, sql, duck001)
    assert r["ok"], r


def test_all_slices_hot_equals_none_hot(spark):
    from conftest import SF0001
    mov, mp, log = (fixtures.movements(spark, SF0001), fixtures.account_mapping(spark, SF0001),
                    fixtures.run_log(spark, SF0001))
    a = product.ledger_product(mov, mp, log, feed_params(line_block=2, hot_slice_rows=1))
    b = product.ledger_product(mov, mp, log, feed_params())
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_journal_lines_all_slices_hot(spark):
    from conftest import SF0001
    mov, mp, log = (fixtures.movements(spark, SF0001), fixtures.account_mapping(spark, SF0001),
                    fixtures.run_log(spark, SF0001))
    a = product.journal_lines(mov, mp, log, feed_params(line_block=2, hot_slice_rows=1))
    b = product.journal_lines(mov, mp, log, feed_params())
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
