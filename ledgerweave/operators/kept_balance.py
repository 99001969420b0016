"""Output balancing that is kept (C3, W2, W3): prefix totals of a day as a stored tree, so that late lines change only what they touch.

``operators.balance`` sums the codes of a day over levels of code prefixes.  Here the same levels are stored.  A *leaf* holds the codes of one (day,
prefix) with their running totals inside the prefix; a *node* is a row per leaf with its totals and its folder.  Late lines rewrite
the leaves of their own prefixes, in a new folder, and the nodes, a row per prefix, in one commit; leaves of other prefixes are not read.  What
the new totals shift in later prefixes is in the nodes alone: a code's group is its running total in the leaf plus the totals of the
earlier prefixes of its day, one window over the day's nodes.

Nodes are a versioned table (``sources.versioned``): a reader sees one version, of two writers one starts again, and an update that fails changes nothing.
Counts may go down as well; a code without lines is gone.  A NULL code sorts first and shifts the running totals, as in the full computation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerweave.operators.balance import CODE, COUNT, GROUP, prefix_running_sums
from ledgerweave.operators.joins import broadcast_if_small
from ledgerweave.sources.versioned import ATTEMPTS, Conflict, VersionedTable

DAY, PREFIX = "periodo", "prefijo"
SMALL, LARGE, FOLDER = "chicas", "grandes", "carpeta"
LEAF = f"{CODE} string, {COUNT} long, acumulado long, rango long, {DAY} date, {PREFIX} string"
NODES = f"{DAY} date, {PREFIX} string, {SMALL} long, {LARGE} long, {FOLDER} string"
BROADCAST_BYTES = 8 << 20


class KeptBalance:
    """Groups of the codes of each day, kept under ``root``; ``prefixes`` are the code's prefix lengths, of which the first is a leaf's."""

    def __init__(self, spark: SparkSession, root: str, limit: int, bin_width: int | None = None, prefixes: tuple[int, ...] = (10, 18)):
        self.spark, self.root = spark, root.rstrip("/")
        self.limit, self.width, self.prefixes = int(limit), int(bin_width or limit), tuple(prefixes)
        self.nodes = VersionedTable(spark, f"{self.root}/nodes")

    def _prefixed(self, counts: DataFrame) -> DataFrame:
        # a letter before the prefix: a folder's name is never empty, and '' (the NULL code) still sorts first
        return counts.select(DAY, CODE, COUNT, F.concat(F.lit("p"), F.coalesce(F.substring(CODE, 1, self.prefixes[0]), F.lit(""))).alias(PREFIX))

    def _by_leaf(self, counts: DataFrame) -> DataFrame:
        """``counts`` with a leaf's rows in one task: they are moved once and sorted once, for their running totals and for their file."""
        return counts.withColumn(PREFIX, F.coalesce(PREFIX, F.lit("p"))).repartition(DAY, PREFIX)   # not null, or the write sorts again

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _write(self, counts: DataFrame) -> tuple[str, DataFrame]:
        """Folder of the leaves of ``counts`` (periodo, code, lines, prefijo; a leaf's in one task), written, and their nodes."""
        large = F.col(COUNT) > self.limit
        run = prefix_running_sums(counts, [DAY, PREFIX], CODE, (), {
            "small": F.when(large, 0).otherwise(F.col(COUNT)), "large": F.when(large, 1).otherwise(0)})
        folder = f"leaves-{uuid.uuid4().hex}"
        leaves = run.select(CODE, COUNT, F.col("_run_small").alias("acumulado"), F.col("_run_large").alias("rango"), DAY, PREFIX)
        leaves.write.partitionBy(DAY, PREFIX).parquet(f"{self.root}/{folder}")
        # values are not negative, so the largest running total is the leaf's
        nodes = self._read(folder).groupBy(DAY, PREFIX).agg(F.max("acumulado").alias(SMALL), F.max("rango").alias(LARGE), F.lit(folder).alias(FOLDER))
        return folder, nodes

    def _read(self, folder: str, keys: list | None = None) -> DataFrame:
        """The leaves of a folder, or of its (day, prefix) ``keys`` alone."""
        base = f"{self.root}/{folder}"
        paths = [base] if keys is None else [f"{base}/{DAY}={k[DAY]}/{PREFIX}={k[PREFIX]}" for k in keys]
        return self.spark.read.schema(LEAF).option("basePath", base).parquet(*paths)

    def _leaves(self, nodes: DataFrame) -> DataFrame:
        """The leaves that ``nodes`` (a row per leaf) name, and no other file."""
        by_folder: dict[str, list] = {}
        for r in nodes.select(DAY, PREFIX, FOLDER).collect():
            by_folder.setdefault(r[FOLDER], []).append(r)
        out = None
        for folder, keys in by_folder.items():
            part = self._read(folder, keys)
            out = part if out is None else out.unionByName(part)
        return out if out is not None else self.spark.createDataFrame([], LEAF)

    def build(self, counts: DataFrame) -> int:
        """The first version, from the lines of each (periodo, code)."""
        _, nodes = self._write(self._by_leaf(self._prefixed(counts.where(F.col(COUNT) > 0))))
        return self.nodes.commit(nodes, None, "build")

    def update(self, late: DataFrame) -> list[tuple]:
        """Add the lines of ``late`` (periodo, code, lines; less than 0 takes lines away); returns the (day, prefix) leaves rewritten."""
        late = self._prefixed(late.groupBy(DAY, CODE).agg(F.sum(COUNT).alias(COUNT)))
        work = f"late-{uuid.uuid4().hex}"       # summed once, read for the touched prefixes and for their leaves
        late.write.parquet(f"{self.root}/{work}")
        try:
            return self._add(self.spark.read.schema(late.schema).parquet(f"{self.root}/{work}"))
        finally:
            self._delete(work)

    def _add(self, late: DataFrame) -> list[tuple]:
        touched = late.select(DAY, PREFIX).distinct()
        hit = self.spark.createDataFrame(touched.collect(), touched.schema)  # a row per touched prefix
        for _ in range(ATTEMPTS):
            base = self.nodes.current()
            old = self.nodes.read(base)
            leaves = self._leaves(old.join(F.broadcast(hit), [DAY, PREFIX]))
            # leaves first, then their sums: the rows are moved to their leaf's task and summed there
            moved = self._by_leaf(leaves.select(DAY, CODE, COUNT, PREFIX).unionByName(late))
            folder, new = self._write(moved.groupBy(DAY, CODE, PREFIX).agg(F.sum(COUNT).alias(COUNT)).where(F.col(COUNT) > 0))
            nodes = old.join(F.broadcast(hit), [DAY, PREFIX], "left_anti").unionByName(new)
            try:
                self.nodes.commit(nodes, base, f"update {folder}")
                return sorted(tuple(r) for r in hit.collect())
            except Conflict:
                self._delete(folder)
        raise Conflict(f"{self.root}: {ATTEMPTS} attempts")

    def groups(self, days: list | None = None) -> DataFrame:
        """(periodo, code, total_registros, grupo_salida) of the current version, of all days or of some."""
        nodes = self.nodes.read()
        if days is not None:
            nodes = nodes.where(F.col(DAY).isin(*days)) if days else nodes.where(F.lit(False))
        before = Window.partitionBy(DAY).orderBy(PREFIX).rowsBetween(Window.unboundedPreceding, -1)  # a row per prefix of the day
        zero = lambda c: F.coalesce(c, F.lit(0))
        offsets = nodes.select(DAY, PREFIX, zero(F.sum(SMALL).over(before)).alias("_small"), zero(F.sum(LARGE).over(before)).alias("_large"),
                               F.sum(LARGE).over(Window.partitionBy(DAY)).alias("_all"))
        rows = self._leaves(nodes).join(broadcast_if_small(offsets, BROADCAST_BYTES), [DAY, PREFIX])
        group = F.when(F.col(COUNT) > self.limit, F.col("_large") + F.col("rango")).otherwise(
            F.col("_all") + F.expr(f"(_small + acumulado - 1) div {self.width}") + 1)
        return rows.select(DAY, CODE, COUNT, group.cast("long").alias(GROUP))
