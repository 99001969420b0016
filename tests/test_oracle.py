"""Every registered query against its DuckDB oracle.

All keys run at sf0.001; the flagship and the daily run also at sf0.01 (the
driver's gate size).
"""

import pytest

import __spark_entry__ as E
from ledgerweave.catalog import QUERIES
from ledgerweave.oracles import ORACLE
import oracle_harness as H
from conftest import SF0001, SF001


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k in ORACLE))
def test_matches_oracle_sf0001(spark, duck0001, key):
    r = H.compare(spark, SF0001, QUERIES[key], ORACLE[key], duck0001)
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


@pytest.mark.parametrize("key", ["ledger_product", "ledger_product_day", "report_control", "run_manifest"])
def test_matches_oracle_sf001(spark, duck001, key):
    r = H.compare(spark, SF001, QUERIES[key], ORACLE[key], duck001)
    assert r["ok"], r


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[-1] == "periodo" and len(df.columns) == 20
    assert df.count() > 0
