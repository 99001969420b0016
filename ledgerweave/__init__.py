"""Spark-native ledger feed: movements -> journal lines -> balanced groups -> reports.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame``; only
``plans.export`` and ``operators.runlog.write_run_log`` write anything.
"""

from ledgerweave.params import FeedParams

__all__ = ["FeedParams"]
