"""The views over the given tables."""

from pyspark.sql import functions as F

from cartwheel.sources import tables as V


def test_document_features_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def text(s):
        made.add(1)
        return s

    t = V.Tables(spark, "unused")
    rows = [(1, "Ab ab x  cd\n", "en", "a", 13), (2, "", "en", "b", 0), (3, None, "de", "b", None), (4, " \t ", None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, s string, lang string, source string, n_chars int")
    t._cache["documents"] = docs.withColumn("text", F.udf(text)("s"))
    t._cache["labels"] = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 1), (9, 1)], "doc_id long, quality int")
    c = V.clf(t)
    got = sorted((r["doc_id"], r["quality"], r["n_chars"], r["n_words"], r["mean_word_len"], r["distinct_share"]) for r in c.collect())
    assert got == [(1, 1, 13.0, 3.0, 8 / 3, 1.0), (2, 0, 0.0, 0.0, 0.0, 0.0), (3, 1, None, None, 0.0, 0.0), (4, 0, 3.0, 0.0, 0.0, 0.0), (4, 1, 3.0, 0.0, 0.0, 0.0)]
    assert c.count() == V.clf(t).count() == V.sc(t).count() == 5
    assert made.value == 4  # every text once, however often the view is read
