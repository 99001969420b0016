"""Command line: run the feed over parquet tables and export its reports.

    python -m ledgerweave --movements PATH --mapping PATH --run-log PATH --report-master PATH --report-document PATH
                          --master NAME --source NAME --book NAME --from 20240105 [--to 20240107] --root PATH
    (or spark-submit ledgerweave/__main__.py ... with the package on the Python path)

The movements table is pruned to the run's days.  The summary is printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ledgerweave.params import FeedParams
from ledgerweave.plans.run import run_days, run_feed
from ledgerweave.session import ensure_checkpoint_dir
from ledgerweave.sources.tables import period_predicate

TABLES = ("movements", "mapping", "run-log", "report-master", "report-document")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerweave")
    for name in (*TABLES, "master", "source", "book", "from", "root"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--to")
    p.add_argument("--exclude", default="GRUPO,ORDEN", help="technical columns left out of the files")
    ns = vars(p.parse_args(argv))
    spark = SparkSession.builder.appName(f"ledgerweave-{ns['master']}").getOrCreate()
    ensure_checkpoint_dir(spark)
    movements, mapping, log, master, document = (spark.read.parquet(ns[t.replace("-", "_")]) for t in TABLES)
    days = run_days(ns["from"], ns["to"])
    excluded = tuple(c.strip().upper() for c in ns["exclude"].split(",") if c.strip()) + ("PERIODO",)
    result = run_feed(spark, movements.where(period_predicate("PERIODO", days)), mapping, log,
                      FeedParams(source=ns["source"], book=ns["book"], periods=days), (master, document), ns["master"],
                      ns["root"], excluded=excluded)
    print(json.dumps(result["summary"], ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
