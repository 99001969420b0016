"""Plan shape: pruning and pushdown reach the scan; no cartesian, nested-loop or Python operators."""

import datetime as dt

import pytest

from conftest import SF0001
from ledgerweave.catalog import QUERIES
from ledgerweave.operators import journal
from ledgerweave.sources import fixtures
from ledgerweave.sources.tables import scan_partitioned

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow",
             "FlatMapGroups", "FlatMapCoGroups")
WRITERS = {"export_run", "sink_encoded_report", "sink_report_lines", "file_order", "sink_replace_table", "sink_overwrite_partition",
           "daily_feed"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in WRITERS))
def test_no_forbidden_operators(spark, key):
    plan = _plan(QUERIES[key](spark, SF0001))
    assert not [w for w in FORBIDDEN if w in plan]
    # the only single-partition exchanges allowed: one-row aggregates and the per-bucket offsets
    if "SinglePartition" in plan:
        assert key in {"run_summary", "large_group_rank", "running_total", "balance_groups", "assign_groups_join"}


def test_partition_pruning_and_pushdown(spark, tmp_path):
    mov = fixtures.movements(spark, SF0001)
    path = str(tmp_path / "mov")
    mov.write.partitionBy("PERIODO").parquet(path)
    day = dt.date(1995, 7, 1)
    src = scan_partitioned(spark, path, [day], "PERIODO")
    lines = journal.unpivot_movements(journal.filter_period(journal.movements_projection(src), [day]))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(PERIODO" in plan and "1995-07-01" in plan
    assert "PushedFilters: [Or(GreaterThan(VLRDEB,0.00),GreaterThan(VLRCRE,0.00))]" in plan
    narrow = lines.select("periodo", "valor_movimiento")
    p2 = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<VLRDEB:decimal(18,2),VLRCRE:decimal(18,2)>" in p2


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _find(node, name):
    if node.nodeName() == name:
        return node
    for c in _children(node):
        hit = _find(c, name)
        if hit is not None:
            return hit
    return None


def test_product_shuffles_lines_once(spark):
    """Lines side of the join with the groups: work-table scan -> one exchange -> window -> merge join; lines are never broadcast."""
    df = QUERIES["ledger_product"](spark, SF0001)
    root = df._jdf.queryExecution().executedPlan().initialPlan()
    assert "_sketch" not in root.toString()         # no large transaction: nothing of slices is planned
    node, exchanges = root, 0
    while True:
        if node.nodeName() == "Exchange":
            exchanges += 1
        if node.nodeName() in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin"):
            assert "BuildLeft" not in str(node.simpleString(100))
            node = node.left()
            continue
        kids = _children(node)
        if not kids:
            break
        node = kids[0]
    assert node.nodeName().startswith("Scan") and exchanges == 1
