"""Samples by hash: rows that repeat change nothing, and an id with many texts is rated once."""

import pytest
from pyspark.sql import functions as F

from cohortline.llm import ordinal_quality
from cohortline.llm.inputs import hashed_sample


@pytest.mark.parametrize("times", [1, 17, 1000])
def test_sample_does_not_depend_on_repeats(spark, times):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("grade"))
    once = {tuple(r) for r in hashed_sample(rows, ["doc_id", "grade"], 1000).collect()}
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy").repartition(7)
    assert {tuple(r) for r in hashed_sample(many, ["doc_id", "grade"], 1000).collect()} == once
    assert len(once) == 1000


def test_one_row_that_fills_the_table_hides_no_other(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") < 12, F.col("id")).otherwise(F.lit(99)).alias("doc_id"))
    assert {r.doc_id for r in hashed_sample(rows, ["doc_id"], 1200).collect()} == {*range(12), 99}
    assert hashed_sample(rows.limit(0), ["doc_id"], 5).collect() == []
    assert hashed_sample(spark.createDataFrame([(None,)], "doc_id long"), ["doc_id"], 5).count() == 1


def test_an_id_with_many_texts_is_rated_once(spark):
    docs = spark.createDataFrame([(1, f"text {i:02d}") for i in range(50)] + [(2, "other"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, ordinal_quality.graded(docs, labels).collect())) == [(0, "other"), (2, "text 00")]
