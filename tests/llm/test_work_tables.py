"""Work tables of the operators have an owner, and rows keep columns of any name."""

import os

import pyarrow as pa

import corpus_pipeline
from ledgerweave.llm import base, best_fit_packing, jaccard_join, suffix_dedup
from ledgerweave.session import owned


def folders(spark):
    root = base.shared_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(root)}


def docs_of(spark):
    text = lambda w, n=30: " ".join(f"{w}{i}" for i in range(n))
    return spark.createDataFrame([(1, text("a"), 7, "x"), (2, text("a") + " more", 8, "y"), (3, text("b"), 9, None), (None, None, 1, "z")], "doc_id long, text string, _may int, f string")


def test_owned_tables_go(spark):
    before = folders(spark)
    with owned(spark):
        assert jaccard_join.jaccard_components(docs_of(spark)).count() == 4
        assert len(folders(spark) - before) > 3
    assert folders(spark) <= before


def test_pipeline_keeps_its_result_only(spark, tmp_path):
    before = folders(spark)
    docs = docs_of(spark).selectExpr("doc_id", "text", "'en' as lang", "f as source", "cast(length(text) as int) as n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    rows = out.count()
    assert {n.rsplit("-", 1)[0] for n in folders(spark) - before} == {"token_ids"} and out.count() == rows


def test_columns_of_any_name_stay(spark):
    docs = docs_of(spark)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r["_may"], r["f"]) for r in got.collect()) == [(0, 1, "z"), (1, 7, "x"), (3, 9, None)]


def test_packed_rows_without_an_owner(spark):
    pieces = spark.createDataFrame([(1, 10), (2, 20)], "row long, length long")
    assert best_fit_packing.pack(pieces, 32).count() == 2


def test_a_session_of_its_own(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "77m")
    try:
        before = spark.conf.get(key, None)
        own = base.session_with(spark, {key: "true"})
        assert own.conf.get(key) == "true" and spark.conf.get(key, None) == before
        assert own.conf.get("spark.sql.files.maxPartitionBytes") == "77m"
        assert base.shared_dir(own) == base.shared_dir(spark)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stages_read_small_batches(spark):
    """A stage's tasks hold a few megabytes of texts at once, and a few repeated anchors need no filter of full size."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    before = spark.conf.get(corpus_pipeline.ARROW_BYTES)
    try:
        docs = spark.range(0, 64, 1, 1).selectExpr("id as doc_id", "repeat('x', 500000) as text")
        stage = corpus_pipeline.in_small_batches(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long"))
        held = [r.n for r in stage(spark, docs, "").collect()]
        assert sum(held) > 64 * 500_000 and max(held) < 2 * corpus_pipeline.BATCH_BYTES
    finally:
        spark.conf.set(corpus_pipeline.ARROW_BYTES, before)
    assert suffix_dedup.anchor_bits(0) == 1 << 20 and suffix_dedup.anchor_bits(50_000) == 1 << 24
    assert suffix_dedup.anchor_bits(10 ** 9) == suffix_dedup.ANCHOR_BITS
