"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with the ``noop`` sink (every row is
computed, nothing is collected to the driver), once, after an untimed
warm-up pass of all queries on the smallest scale (JIT and codegen warm-up).  ``balance_plain_window`` is
the reference's formulation (one window per period over all codes) kept as a
baseline for the prefix-level sums in ``ledger_product``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerweave import catalog  # noqa: E402
from ledgerweave.operators import balance, journal  # noqa: E402
from ledgerweave.sources.fixtures import feed_params  # noqa: E402
from ledgerweave.session import local_session  # noqa: E402
from ledgerweave.sources import fixtures  # noqa: E402


def balance_plain_window(spark, sf):
    """Group assignment the way the reference states it: windows over every code of a period."""
    p = feed_params()
    mapped = journal.map_accounts(catalog._coded(spark, sf, p), fixtures.account_mapping(spark, sf), p)
    c = balance.transaction_counts(mapped, ["periodo"], journal.CODE)
    large = F.col(balance.COUNT) > p.large_limit
    w = Window.partitionBy("periodo").orderBy(journal.CODE)
    big = c.where(large).withColumn("grupo_salida", F.dense_rank().over(w).cast("long"))
    nbig = big.groupBy("periodo").agg(F.max("grupo_salida").alias("m"))
    small = (c.where(~large).join(nbig, "periodo", "left")
             .withColumn("grupo_salida", F.coalesce("m", F.lit(0)) + F.expr(
                 f"(sum(total_registros) OVER (PARTITION BY periodo ORDER BY codigo_transaccion) - 1) div {p.large_limit}")
                 + 1).drop("m"))
    return big.unionByName(small)


def balance_prefix_levels(spark, sf):
    p = feed_params()
    mapped = journal.map_accounts(catalog._coded(spark, sf, p), fixtures.account_mapping(spark, sf), p)
    c = balance.transaction_counts(mapped, ["periodo"], journal.CODE)
    return balance.assign_groups(c, ["periodo"], journal.CODE, p.large_limit, p.bucket_length)


def export_run_large(spark, sf):
    """A whole run with the feed's own limits: few files a day, each as large as its group (``export_run`` has many small ones)."""
    return catalog.delivered(spark, sf, feed_params())


HEADLINE = {
    "ledger_product": catalog.q_ledger_product,
    "ledger_product_day": catalog.q_ledger_product_day,
    "journal_lines": catalog.q_journal_lines,
    "balance_prefix_levels": balance_prefix_levels,
    "balance_plain_window": balance_plain_window,
    "report_header": catalog.q_report_header,
    "report_lines": catalog.q_report_lines,
    "report_control": catalog.q_report_control,
    "run_manifest": catalog.q_run_manifest,
    "run_log_upsert": catalog.q_run_log_upsert,
    "export_run": catalog.q_export_run,
    "export_run_large": export_run_large,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # shuffle partitions = cores in local mode (AQE coalesces further); a cluster sets its own
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8"))
    spark = local_session(cpus, parts, app="ledgerweave-bench")
    only = os.environ.get("BENCH_ONLY")
    # warm-up: every headline query once on the smallest scale (JIT, codegen), untimed;
    # nothing of the measured scale is read or cached by it
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name, fn in HEADLINE.items():
            if not only or name in only.split(","):
                fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        if only and name not in only.split(","):
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
