"""From raw documents to token ids: five stages, each one operator, each written as Parquet and read again.

1. toxicity: a document the classifier (learned from the training fold of ``labels``) scores 0.5 or more goes.
2. near_duplicates: of each group of documents linked by word shingles (five words, similarity 0.75) one row stays, of the smallest doc_id;
   documents without a doc_id stay, rows equal in doc_id and text become one; rows of one doc_id with other texts are judged each by itself.
3. repeated_passages: of a passage of 200 bytes or more that occurs several times only the first copy stays (cut at whole characters).
   A text may become empty; the document stays, and n_chars follows the text.
4. source_mix: documents are taken as often as their source's target asks for, none more than three times.
5. token_ids: every text as the ids of the public piece model, with the digest of what they decode to.

Stages 1 to 4 return the columns of ``documents``.  Empty tables pass through.

Texts reach the Python tasks in Arrow batches of ``BATCH_BYTES``: a task's JVM and its worker each hold a batch or two, beside a heap that is full.
A stage sets this for its session, as the frame it returns is computed later; ``run``, which writes every stage, sets it back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm import jaccard_join, piece_codec, source_mix, suffix_dedup, toxicity
from ledgerweave.llm.base import key_filter, saved, table
from ledgerweave.session import Owned, owned


BATCH_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` with Arrow batches of ``BATCH_BYTES``; what a batch holds changes no result."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(ARROW_BYTES, f"{BATCH_BYTES}b")
        return stage(spark, docs, sf_dir)
    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.toxic_model(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = saved(jaccard_join.set_components(docs).where("doc_id is not null").withColumn("first", F.expr("f is null or (doc_id = component_id and f = first_f)")), "components")
    gone = saved(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("first").alias("first")).where("rows > 1 or not first"), "gone")
    # only documents that may be gone, or stand more than once, are shuffled
    own = spark.sparkContext.broadcast(key_filter(gone, "doc_id"))

    # a row travels whole in one column, so its own columns clash with none here; it is known by its doc_id and the id of its shingle set,
    # as another text of the same doc_id is another row
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("x", jaccard_join.set_ids_of(own)(F.col("row.doc_id").cast("long"), F.col("row.text")))
    rest = rows.where("x.may").select("row", "row.doc_id", "x.f")
    rest = rest.join(found.where("not first").select("doc_id", "f").distinct(), ["doc_id", "f"], "left_anti")
    one = rest.groupBy("doc_id", "f", F.when(F.col("f").isNull(), F.col("row.text")).alias("t")).agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return rows.where("not x.may").select("row.*").unionByName(one.select("row.*"))


@in_small_batches
def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut_texts(docs, keep_first=True, whole_chars=True, carry=[c for c in docs.columns if c not in ("doc_id", "text")])
    cut = cut.withColumn("text", F.col("kept").cast("string")).select("doc_id", "text", "more.*")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.repeated(docs)


@in_small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path(piece_codec.MODEL)
    both = piece_codec.encode_and_decode(docs, path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_passages),
    ("source_mix", mix_sources),
    ("token_ids", token_ids),
]

#: No SQL for classifiers, links or suffix arrays: the tests hold ``run`` against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before, batch = table(spark, sf_dir, "documents"), None, spark.conf.get(ARROW_BYTES)
    try:
        for name, stage in STAGES:
            with owned(spark) as work:
                docs = saved(stage(spark, docs, sf_dir), name)
                written = work.tables.pop()     # a stage's own table stays until the next one is written, its other work tables go now
            if before:
                Owned(spark, [before]).release()
            before = written
    finally:
        spark.conf.set(ARROW_BYTES, batch)
    return docs
