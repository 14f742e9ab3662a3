"""Exact nearest neighbours: test rows against train rows of the same table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.operators.nearest import fit_nearest
from cohortline.operators.nearest_quantised import fit_quantised
from cohortline.operators.split import with_split
from cohortline.sources.tables import read_table
from workload.registry import query
from workload.sqltext import split_80_10_10

WIDTH = 64


def _nearest_sql(source: str, distance: str, k: int) -> str:
    """SQL: all (test, train) distances, the k nearest, as ``near``."""
    return f"""
WITH source AS ({source}),
near AS (
  SELECT q.key AS key, q.label AS truth, s.key AS neighbour, s.label AS label, {distance} AS d
  FROM source q, source s WHERE q.split = 'test' AND s.split = 'train'
  QUALIFY row_number() OVER (PARTITION BY q.key ORDER BY d, s.key) <= {k})"""


VOTED = """
, votes AS (SELECT key, truth, label, count(*) AS n FROM near GROUP BY ALL)
SELECT key, truth AS label, label AS prediction FROM votes
QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, label) = 1"""

_EMBEDDED = f"""SELECT vec_id AS key, label, embedding::DOUBLE[] AS e,
  {split_80_10_10("CAST(vec_id AS VARCHAR)")} AS split FROM embeddings"""
_EMBEDDED_DISTANCE = " + ".join(
    f"(q.e[{i}] - s.e[{i}]) * (q.e[{i}] - s.e[{i}])" for i in range(1, WIDTH + 1))

ORDER_LABEL = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
ORDER_MONTH = "(year(o_orderdate) * 12 + month(o_orderdate))"
_ORDERS = f"""SELECT o_orderkey AS key, {ORDER_LABEL} AS label,
  CAST(o_totalprice / 10000 AS DOUBLE) AS a, CAST({ORDER_MONTH} AS DOUBLE) AS b,
  CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS c,
  {split_80_10_10("CAST(o_orderkey AS VARCHAR)")} AS split FROM orders"""
_ORDERS_DISTANCE = " + ".join(f"(q.{x} - s.{x}) * (q.{x} - s.{x})" for x in "abc")


def _parts(df, key):
    df = with_split(df, [key])
    return df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test").drop("split")


def _embedded(spark, folder):
    vectors = read_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("key"), "label", "embedding")
    return _parts(vectors, "key")


def _orders(spark, folder):
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), F.expr(ORDER_LABEL).alias("label"),
        (F.col("o_totalprice") / 10000).alias("a"),
        F.expr(ORDER_MONTH).cast("double").alias("b"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("c"))
    return _parts(orders, "key")


@query("knn_exact", _nearest_sql(_EMBEDDED, _EMBEDDED_DISTANCE, 3) + VOTED)
def knn_exact(spark, folder):
    train, test = _embedded(spark, folder)
    model = fit_nearest(train, "embedding", "key", "label", k=3)
    return model.predict(test).select("key", "label", "prediction")


@query("knn_tuned_k", _nearest_sql(_EMBEDDED, _EMBEDDED_DISTANCE, 7) + VOTED)
def knn_tuned_k(spark, folder):
    train, test = _embedded(spark, folder)
    model = fit_nearest(train, "embedding", "key", "label", k=7)
    return model.predict(test).select("key", "label", "prediction")


@query("knn_neighbours", _nearest_sql(_EMBEDDED, _EMBEDDED_DISTANCE, 3) + """
SELECT key, neighbour, label, round(sqrt(d), 6) AS distance,
       row_number() OVER (PARTITION BY key ORDER BY d, neighbour) AS rank FROM near""")
def knn_neighbours(spark, folder):
    train, test = _embedded(spark, folder)
    model = fit_nearest(train, "embedding", "key", "label", k=3)
    asked = test.select("key", F.col("embedding").cast("array<double>").alias("point"))
    found = model.neighbours(asked).withColumnRenamed("key", "neighbour")
    return asked.join(found, "point").select(
        "key", "neighbour", "label", F.round("distance", 6).alias("distance"),
        F.col("rank").cast("bigint").alias("rank"))


@query("knn_orders", _nearest_sql(_ORDERS, _ORDERS_DISTANCE, 3) + VOTED)
def knn_orders(spark, folder):
    """Few dimensions: boxes cut most of the table off for every test row."""
    train, test = _orders(spark, folder)
    model = fit_nearest(train, ["a", "b", "c"], "key", "label", k=3)
    return model.predict(test).select("key", "label", "prediction")


@query("knn_approx")
def knn_approx(spark, folder):
    """Neighbours by quantised codes: every train row is indexed, the best hundred are measured exactly."""
    train, test = _embedded(spark, folder)
    model = fit_quantised(train, "embedding", "key", "label", k=3)
    return model.predict(test).select("key", "label", "prediction")
