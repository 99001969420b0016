"""Mixing sources to target weights by capped water-filling.

The words of the mix are shared among sources in proportion to their weights; a source's target stops at
``max_epochs`` times its own words, and what it leaves is shared among the others by weight, again until none is above
(each step is one aggregation of a table with a row per source; two numbers come back).  A source's target is then
met by whole repetitions of all its documents plus a fractional one: documents in a seeded order until the
remaining words are reached.  The order is cut without sorting a source: words are summed per slice of the hash, so only the slice
in which the target falls is looked at row by row.  The last document of a fractional repetition gives only its first words.

A null source is a source (the last one); null and empty texts have size 0 and give 0 words; a source without words has target 0;
repeated rows are documents of their own; the choice depends on the seed, doc_id and size alone (rows equal in all of
source, doc_id and size are interchangeable); an empty table gives no rows; clashing input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.llm.base import saved, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240
#: Slices of the hash order of a source.
SLICES = 4096
#: A source table is broadcast up to this many rows and bytes of names; beyond, rows meet it by a salted join.
BROADCAST_ROWS, BROADCAST_BYTES, SALTS = 10_000, 2 << 20, 64


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def slice_of(seed: int):
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size"), 52).cast("int")


def by_rank(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``sources`` with weights repeating in code point order of the names, null last (one row per source in one window)."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(w) - 1) % len(weights) + 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), k))


def water_fill(sources: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with target: shares of all words by weight, capped, the excess reshared."""
    cap = F.col("source_size") * float(max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight; sources whose cap lies below weight * level are full
    while True:
        full = cap <= F.col("weight") * level
        r = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("taken"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        new = (total - (r.taken or 0.0)) / r.open if r.open else float("inf")
        if not new > level:
            break
        level = new
    if level == float("inf"):
        return sources.withColumn("target", cap)
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def plan_mix(sized: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per source of ``sized`` (doc_id, source, size): source_size, target, whole, extra, cut (slice) and before.

    Slices below ``cut`` take one more repetition; ``before`` words of ``extra`` are given by then.
    """
    slices = saved(sized.groupBy("source", slice_of(seed).alias("slice")).agg(F.sum("size").alias("words")), "slices")
    src = water_fill(saved(by_rank(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights), "sources"), max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    src = src.withColumn("whole", whole).withColumn("extra", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    w = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    run = slices.withColumn("upto", F.sum("words").over(w))
    # the first slice that goes beyond the words still wanted
    edge = (run.alias("r").join(src.select(F.col("source").alias("s"), "extra").alias("x"), F.col("r.source").eqNullSafe(F.col("s")))
            .where("upto > extra").groupBy("s").agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("before"))).alias("edge"))
            .select("s", "edge.slice", "edge.before"))
    out = (src.join(edge, src.source.eqNullSafe(edge.s), "left")
           .select("source", "source_size", "weight", "target", "whole", "extra", F.coalesce("slice", F.lit(SLICES)).alias("cut"), F.coalesce("before", F.lit(0)).alias("before")))
    return saved(out, "mixplan")


def with_source(rows: DataFrame, plan: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``columns`` of their source's row of ``plan``."""
    p = plan.select(F.col("source").alias("_source"), *[F.col(c).alias(f"_{c}") for c in columns])
    n = plan.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 8 * len(columns)).alias("b")).first()
    same = rows.source.eqNullSafe(F.col("_source"))
    if n.n <= BROADCAST_ROWS and (n.b or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(p), same, "left").drop("_source")
    p = p.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    return rows.join(p, rows.source.eqNullSafe(p._source) & (F.col("_part") == F.col("_salt")), "left").drop("_source", "_salt", "_part")


def mix(sized: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``sized`` (doc_id, source, size, more columns) with _whole (repetitions) and _part (words of the fractional one), _target and _source_size."""
    r = with_source(sized, plan, "source_size", "target", "whole", "extra", "cut", "before").withColumn("_slice", slice_of(seed))
    sure = r.where(F.col("_slice") != F.col("_cut")).withColumn("_part", F.when(F.col("_slice") < F.col("_cut"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    # the slice in which the target falls: about 1/SLICES of a source, in hash order
    w = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "doc_id", "size"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = r.where(F.col("_slice") == F.col("_cut")).withColumn("_upto", F.sum("size").over(w) + F.col("_before"))
    left = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_extra") - (F.col("_upto") - F.col("size"))))
    edge = edge.withColumn("_part", left.cast("long")).drop("_upto")
    return sure.unionByName(edge).drop("_slice", "_cut", "_before", "_extra")


def repeated(docs: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken (a part of at least half a document counts as whole).

    A document without words is kept once.
    """
    sized = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source", word_count().alias("size"))
    small = saved(sized.select("doc_id", "source", "size"), "sized")
    m = mix(sized, plan_mix(small, weights, max_epochs, seed), seed)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("_whole") + (2 * F.col("_part") >= F.col("size")).cast("int")).cast("int")
    return m.select("_row", times.alias("_times")).where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    docs = saved(docs, "sized")
    m = mix(docs, plan_mix(docs))
    return m.select("doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                    (F.col("_whole") * F.col("size") + F.col("_part")).alias("taken"))
