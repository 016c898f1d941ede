"""Columns of documents that are named like those of labels or of results."""

from pyspark.sql import functions as F

from roadpulse.llm.quality import score_quality, train_quality_model


def test_clashing_columns_change_nothing(spark):
    texts = [(i, f"good clean words number {i}" if i % 2 else f"zzz {i} qq # {i}") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit("x").alias("text"))
    clash = docs.withColumns({c: F.lit(1) for c in ("quality", "score", "difference", "pieces", "part", "toxic")})
    want = train_quality_model(docs, labels)
    got = train_quality_model(clash, labels)
    assert got == want

    def scores(df):
        return sorted((r.doc_id, r.score) for r in score_quality(df, want).select("doc_id", "score").collect())

    assert scores(clash) == scores(docs)
