"""Largest task under skew: line numbering and group balancing, plain window vs our forms.

``plain|sliced``: every movement of the table is made one transaction
(constant dates and sequence), as in tests/test_skew.py, and the lines are
numbered.  ``balance-plain|balance-levels``: every movement is put on one
processing day and the output groups are assigned.  Each variant runs in its
own session with the event log written to a scratch folder; the report is the
largest number of shuffle records one task read, and the total.

    python tools/skew_report.py sliced [/root/testdata/sf0.1]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def session(log_dir: str) -> SparkSession:
    s = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
         .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", log_dir).config("spark.eventLog.compress", "false")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


def largest_task(log_dir: str) -> tuple[int, int]:
    biggest, total = 0, 0
    for f in glob.glob(f"{log_dir}/*"):
        files = glob.glob(f"{f}/events_*") if os.path.isdir(f) else [f]
        for path in files:
            for line in open(path):
                e = json.loads(line)
                if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    n = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                    biggest, total = max(biggest, n), total + n
    return biggest, total


def run(variant: str, sf: str) -> None:
    log_dir = tempfile.mkdtemp(prefix=f"skew-{variant}-")
    spark = session(log_dir)
    from ledgerweave import session as S
    from ledgerweave.operators import journal, numbering
    from ledgerweave.sources.fixtures import feed_params
    from ledgerweave.sources import fixtures
    S.ensure_checkpoint_dir(spark)
    day = F.lit("2024-06-01").cast("date")
    if variant.startswith("balance"):
        # hot day: every movement in one processing day, codes as they are (about 150k per sf0.1)
        from ledgerweave.operators import balance
        mov = fixtures.movements(spark, sf).withColumn("PERIODO", day)
        coded = S.materialize(journal.coded_lines(mov, fixtures.run_log(spark, sf), feed_params()), "coded")
        counts = S.materialize(balance.transaction_counts(coded, ["periodo"], journal.CODE), "counts")
        levels = None if variant == "balance-plain" else feed_params().bucket_length
        out = balance.assign_groups(counts, ["periodo"], journal.CODE, 150000, levels)
        out.select("grupo_salida").write.format("noop").mode("overwrite").save()
        spark.stop()
        biggest, total = largest_task(log_dir)
        print(json.dumps({"variant": variant, "codes": "one day", "largest_task_records": biggest,
                          "shuffle_records": total}))
        return
    mov = (fixtures.movements(spark, sf).withColumn("FECHA_EFECTIVA", day).withColumn("FECHA_POSTEO", day)
           .withColumn("CONSECUTIVO", F.lit(1).cast("long")).withColumn("PERIODO", day))
    p = feed_params(line_block=4096)
    coded = S.materialize(journal.coded_lines(mov, fixtures.run_log(spark, sf), p), "coded")
    keys = ["periodo", journal.TKEY]
    if variant == "sliced":
        out = numbering.ordered_row_number(coded, keys, journal.LINE_ORDER, p.line_block, "rn", p.hot_slice_limit)
    else:
        out = coded.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*journal.line_order())))
    out.select("rn").write.format("noop").mode("overwrite").save()
    spark.stop()
    biggest, total = largest_task(log_dir)
    print(json.dumps({"variant": variant, "largest_task_records": biggest, "shuffle_records": total}))


if __name__ == "__main__":
    run(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1")
