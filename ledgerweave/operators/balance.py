"""Output balancing (C3): size-bounded groups of whole transactions.

Reference semantics, per period:

* ``total_registros`` = lines per transaction code (A1);
* codes with more than ``limit`` lines get their own group, numbered by
  ``DENSE_RANK() OVER (ORDER BY code)`` (W2);
* the other codes are binned by the running total of their lines ordered by
  code (W3): ``n_large + floor((running - 1) / limit) + 1``;
* lines join their code's group (J1); a NULL code still shifts the running
  total but matches nothing, so its lines vanish.

Both windows order *all* codes of a period.  A plain window would put them in
one task.  Here they are a prefix sum over levels of code prefixes (for
strings, x < y implies prefix(x) <= prefix(y)): codes are ranked inside the
finest prefix in parallel and shifted by the totals of the earlier prefixes,
computed the same way one level up over one row per prefix.  With the code
layout voucher + effective date + posting date + sequence + re-run, the
levels are bounded by the calendar (effective dates of a day, posting dates
per effective date) and by the code format (at most 10**5 codes per date
pair), whatever the shape of the day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.session import keep

CODE = "codigo_transaccion"
COUNT = "total_registros"
GROUP = "grupo_salida"


def transaction_counts(lines: DataFrame, keys: Sequence[str] = ("periodo",), code: str = CODE) -> DataFrame:
    """``COUNT(*)`` per (keys, code) (A1); map-side partial aggregation, so a hot code costs nothing extra."""
    return lines.groupBy(*keys, code).agg(F.count(F.lit(1)).alias(COUNT))


def _prefix_levels(b: DataFrame, keys: list[str], order_col: str, prefixes: list[int],
                   names: list[str]) -> DataFrame:
    """Recursive step: ``b`` has ``keys``, ``order_col`` and ``_v_<name>``; adds ``_run_`` and ``_all_``."""
    if not prefixes:
        w = (Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_first())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        w_all = Window.partitionBy(*keys)
        return b.select("*", *[F.sum(f"_v_{n}").over(w).alias(f"_run_{n}") for n in names],
                        *[F.sum(f"_v_{n}").over(w_all).alias(f"_all_{n}") for n in names])
    level = f"_b{len(prefixes)}"
    # '' is below every other string, so a NULL order key (which sorts first) can share it;
    # the non-null bucket keeps the join back a plain equi-join
    b = b.withColumn(level, F.coalesce(F.substring(F.col(order_col), 1, prefixes[-1]), F.lit("")))
    w_in = (Window.partitionBy(*keys, level).orderBy(F.col(order_col).asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(f"_v_{n}").over(w_in).alias(f"_l_{n}") for n in names])
    # one row per bucket and task moves; kept where it feeds two branches, so that the rows are read and moved once for all levels above
    totals = b.groupBy(*keys, level).agg(*[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in names])
    if prefixes[:-1]:
        totals = keep(totals)
    upper = _prefix_levels(totals, keys, level, prefixes[:-1], names)
    offsets = upper.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)], F.col(level).alias("_bb"),
                           *[(F.col(f"_run_{n}") - F.col(f"_v_{n}")).alias(f"_o_{n}") for n in names],
                           *[F.col(f"_all_{n}").alias(f"_a_{n}") for n in names])
    # keys are non-null (callers filter them), so a plain equi-join keeps the rows where they are
    cond = [local[k] == offsets[f"_k_{i}"] for i, k in enumerate(keys)] + [local[level] == offsets["_bb"]]
    joined = local.join(offsets, cond)
    return joined.select(*[local[c] for c in b.columns],
                         *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(f"_run_{n}") for n in names],
                         *[F.col(f"_a_{n}").alias(f"_all_{n}") for n in names])


def prefix_running_sums(df: DataFrame, keys: Sequence[str], order_col: str, prefixes: Sequence[int],
                        values: Mapping[str, Column]) -> DataFrame:
    """Running sums of ``values`` ordered by ``order_col`` within ``keys``, plus key totals.

    ``order_col`` is a string, unique within ``keys`` (one row per code);
    NULL sorts first, as in both reference engines.  ``keys`` must be non-null
    and ``values`` non-negative (counts and 0/1 flags).  ``prefixes`` are
    increasing prefix lengths: rows are summed inside the finest prefix,
    each bucket is shifted by the running total of the earlier buckets, which
    is the same computation one level up over one row per bucket, down to a
    window per key over the coarsest buckets.  For strings x < y implies
    prefix(x) <= prefix(y), so the result equals one window over all rows.
    Adds ``_run_<name>`` (inclusive) and ``_all_<name>`` (key total).
    """
    names = list(values)
    b = df.select(*df.columns, *[v.alias(f"_v_{n}") for n, v in values.items()])
    out = _prefix_levels(b, list(keys), order_col, sorted(set(prefixes)), names)
    return out.select(*df.columns, *[F.col(f"_run_{n}").cast("long").alias(f"_run_{n}") for n in names],
                      *[F.col(f"_all_{n}").cast("long").alias(f"_all_{n}") for n in names])


def ranked_counts(counts: DataFrame, keys: Sequence[str] = ("periodo",), code: str = CODE,
                  limit: int = 150000, bucket_length: int | Sequence[int] | None = (10, 18)) -> DataFrame:
    """Counts plus ``es_grande`` (P11), ``rango_grande`` (W2) and ``acumulado``.

    ``bucket_length``: prefix length(s) of the code used as levels of the
    prefix sum (``None``: one window per key).
    """
    large = F.col(COUNT) > F.lit(limit)
    prefixes = [] if not bucket_length else ([bucket_length] if isinstance(bucket_length, int) else list(bucket_length))
    r = prefix_running_sums(counts, keys, code, prefixes, {
        "large": F.when(large, F.lit(1)).otherwise(F.lit(0)),
        "small": F.when(large, F.lit(0)).otherwise(F.col(COUNT)),
    })
    return r.select(
        *counts.columns,
        large.alias("es_grande"),
        F.when(large, F.col("_run_large")).alias("rango_grande"),
        F.when(~large, F.col("_run_small")).alias("acumulado"),
        F.col("_all_large").alias("n_grandes"),
    )


def assign_groups(counts: DataFrame, keys: Sequence[str] = ("periodo",), code: str = CODE,
                  limit: int = 150000, bucket_length: int | Sequence[int] | None = (10, 18),
                  bin_width: int | None = None) -> DataFrame:
    """(keys, code, total_registros, grupo_salida): the group of every code.

    ``bin_width`` defaults to ``limit`` (the reference uses one number for both).
    """
    width = int(bin_width or limit)
    r = ranked_counts(counts, keys, code, limit, bucket_length)
    grupo = F.when(F.col("es_grande"), F.col("rango_grande")).otherwise(
        F.col("n_grandes") + F.expr(f"(acumulado - 1) div {width}") + F.lit(1))
    return r.select(*keys, code, COUNT, grupo.cast("long").alias(GROUP))


def balance_groups(lines: DataFrame, keys: Sequence[str] = ("periodo",), code: str = CODE,
                   limit: int = 150000, bucket_length: int | Sequence[int] | None = (10, 18),
                   bin_width: int | None = None) -> DataFrame:
    """Lines plus ``grupo_salida``; lines of a NULL code are dropped (J1, inner join)."""
    groups = assign_groups(transaction_counts(lines, keys, code), keys, code, limit, bucket_length, bin_width)
    return lines.join(groups.select(*keys, code, GROUP), [*keys, code])
