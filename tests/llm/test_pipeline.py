"""The pipeline's stages on a small corpus."""

import random

import corpus_pipeline
from tests.llm.test_llm import brute_lines, documents, prose, written


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    texts = [prose(rng, 60, 5000) for _ in range(120)]
    texts += [texts[0], texts[1], "", None]
    folder = written(documents(spark, texts), tmp_path)
    written(spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "mixing to target weights", "SentencePiece encoding"]
    kept = corpus_pipeline.toxic(spark, docs, folder)
    assert kept.columns == docs.columns and kept.count() == len(texts)
    cleaned = corpus_pipeline.repeated_lines(spark, docs, folder)
    assert cleaned.columns == docs.columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == {i: t for i, (t, _) in brute_lines(texts, range(len(texts))).items()}
    single = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == set(range(120)) | {122}
    mixed = corpus_pipeline.mix(spark, docs, folder)
    assert mixed.columns == docs.columns
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 50


def test_stages_keep_columns_of_any_name_and_take_any_row(spark, tmp_path):
    """Nulls in every column, repeated rows, clashing names, a long text, and an empty table."""
    from pyspark.sql import functions as F

    rng = random.Random(2)
    texts = [prose(rng, 60, 5000) for _ in range(30)] + [None, "", prose(rng, 20000, 9000), "one line\none line"]
    docs = documents(spark, texts, ids=[*range(33), None], sources=[None, *["s"] * 33]).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.union(docs.where("doc_id < 3 OR doc_id IS NULL"))
    for name in ("n_lines", "n_removed", "copy", "cdf", "__node", "__doc", "__toxic_text", "__u", "node", "a.b"):
        docs = docs.withColumn(name, F.lit(name))
    folder = written(docs, tmp_path)
    written(spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        rows = out.collect()
        assert out.columns == docs.columns and rows and all(r["a.b"] == "a.b" and r["copy"] == "copy" and r["__node"] == "__node" for r in rows)
        assert stage(spark, docs.limit(0), folder).count() == 0
    ids = corpus_pipeline.tokens(spark, docs, folder)
    assert ids.count() == docs.count() and corpus_pipeline.tokens(spark, docs.limit(0), folder).count() == 0
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, folder).select("doc_id").where("doc_id IS NOT NULL").collect()) == [*range(31), 32]
