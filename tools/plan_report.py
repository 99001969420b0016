"""Print the physical plan shape of every registered query as a markdown table (PLANS.md).

Counts come from AQE's initial plan (before runtime re-planning), built on
sf0.001: scans with pushed filters, shuffle exchanges (by kind), broadcast
exchanges, join strategies, windows and single-partition exchanges.
"""

from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerweave.catalog import QUERIES  # noqa: E402
from ledgerweave.session import local_session  # noqa: E402

WRITERS = {"export_run", "sink_encoded_report", "sink_report_lines", "file_order", "sink_replace_table",
           "sink_overwrite_partition", "daily_feed", "pending_by_files", "bucketed_header", "bucketed_control", "balance_kept"}


def walk(node, out: Counter, seen: set | None = None) -> None:
    seen = set() if seen is None else seen
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":              # e.g. the plan of a persisted table
        walk(node.initialPlan(), out, seen)
        return
    out[name] += 1
    if name == "Exchange":
        text = node.toString()
        if "SinglePartition" in text:
            out["Exchange:single"] += 1
        elif "rangepartitioning" in text:
            out["Exchange:range"] += 1
        elif "REPARTITION" in text:
            out["Exchange:repartition"] += 1
        else:
            out["Exchange:hash"] += 1
    seq = node.children()
    for i in range(seq.size()):
        walk(seq.apply(i), out, seen)
    # a persisted table is computed once however often it is read: count its plan once
    if name == "InMemoryTableScan":
        cached = node.relation().cachedPlan()
        key = cached.toString()
        if key not in seen:
            seen.add(key)
            walk(cached, out, seen)


def main() -> None:
    spark = local_session(8, 8)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    rows = []
    for key, fn in QUERIES.items():
        if key in WRITERS:
            rows.append((key, "writes files; see the plans of the queries it is built from"))
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan()
        root = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        c: Counter = Counter()
        walk(root, c)
        scans = sum(v for k, v in c.items() if k.startswith("Scan"))
        rows.append((key, f"{scans} | {c['Exchange:hash']} | {c['Exchange:repartition']} | {c['BroadcastExchange']} | "
                          f"{c['BroadcastHashJoin']} | {c['SortMergeJoin']} | {c['Window']} | {c['Generate']} | "
                          f"{c['Exchange:single']}"))
    print("| query | scans | hash exch. | repartition | broadcast | BHJ | SMJ | windows | generate | single-partition |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for key, text in rows:
        if "|" in text:
            print(f"| `{key}` | {text} |")
        else:
            print(f"| `{key}` | {text} ||||||||| ")
    spark.stop()


if __name__ == "__main__":
    main()
