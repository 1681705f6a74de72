"""The pipeline's stages on odd tables."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with null and repeated ids, null and empty texts, repeated rows, null sources, and columns named as stages name theirs."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 4 = 0")
    docs = docs.unionByName(docs.where("doc_id < 40")).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.col("source")))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") % 50))
    blank = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, None, 0), (None, None, None, None, None)], docs.schema)
    other = {c: F.concat(F.lit("x"), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")) for c in ("size", "copies", "ids", "score", "lang_pred", "__key", "times", "pii")}
    return docs.unionByName(blank).withColumns(other).cache()


@pytest.mark.parametrize("number", range(5))
def test_stage(spark, odd, number):
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (odd, odd.limit(0)):
        out = stage(spark, docs, SMALL)
        if name == "BPE":
            assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() == docs.count()
            continue
        assert out.columns == docs.columns
        rows = out.collect()
        # What goes along stays with its row.
        assert all(r["size"] == r["copies"] == f"x{-1 if r['doc_id'] is None else r['doc_id']}" for r in rows)
        if docs is odd:
            assert rows and (name == "mixing sources" or len(rows) <= odd.count())
        else:
            assert not rows
        if name == "PII":
            assert len(rows) == docs.count()
