"""Splits, seeded order, class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.functions.codes import encode
from cohortline.operators.metrics import class_balance, with_class_weight
from cohortline.operators.order import seeded_shuffle
from cohortline.operators.rows import drop_placeholder
from cohortline.operators.split import TRAIN_TEST, with_split
from cohortline.sources.tables import read_table
from workload.encoding import PRIORITIES
from workload.registry import query
from workload.sqltext import split_80_10_10, split_80_20

LINE_KEY = "CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)"


@query("priority_by_split", f"""
WITH kept AS (
  SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgent,
         {split_80_10_10("CAST(o_orderkey AS VARCHAR)")} AS split
  FROM orders WHERE o_orderpriority IS DISTINCT FROM '4-NOT SPECIFIED')
SELECT split, count(*) AS n, CAST(sum(urgent) AS BIGINT) AS n_urgent, avg(urgent) AS urgent_share
FROM kept GROUP BY split""")
def priority_by_split(spark, folder):
    """Placeholder rows out, ordinal code, split, share of urgent orders per split."""
    orders = drop_placeholder(
        read_table(spark, folder, "orders"), "o_orderpriority", "4-NOT SPECIFIED")
    coded = with_split(orders, ["o_orderkey"]).withColumn(
        "urgent", (encode("o_orderpriority", PRIORITIES) <= 1).cast("int"))
    return coded.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("urgent").alias("n_urgent"),
        F.avg("urgent").alias("urgent_share"))


@query("split_80_10_10", f"""
SELECT l_orderkey, l_linenumber, {split_80_10_10(LINE_KEY)} AS split FROM lineitem""")
def split_80_10_10(spark, folder):
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return with_split(lines, ["l_orderkey", "l_linenumber"])


@query("split_80_20", f"""
SELECT o_orderkey, {split_80_20("CAST(o_orderkey AS VARCHAR)")} AS split FROM orders""")
def split_80_20_orders(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    return with_split(orders, ["o_orderkey"], TRAIN_TEST)


@query("seeded_shuffle", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       row_number() OVER (ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42'))) - 1
       AS position FROM orders""")
def seeded_shuffle_orders(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return seeded_shuffle(orders, ["o_orderkey"])


@query("seeded_shuffle_copies", """
WITH numbered AS (
  SELECT l_returnflag, l_linestatus, l_linenumber,
         md5(concat_ws('|', l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR), '42')) AS h,
         row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber) - 1 AS copy
  FROM lineitem)
SELECT l_returnflag, l_linestatus, l_linenumber,
       row_number() OVER (ORDER BY CASE WHEN copy = 0 THEN h
                                        ELSE md5(concat_ws('|', h, CAST(copy AS VARCHAR))) END) - 1
       AS position FROM numbered""")
def seeded_shuffle_copies(spark, folder):
    """Few different rows with very many copies each."""
    return seeded_shuffle(read_table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber"))


@query("class_weight", """
SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag <> 'R') AS negatives,
       count(*) FILTER (WHERE l_returnflag = 'R') AS positives,
       round(count(*) FILTER (WHERE l_returnflag <> 'R')
             / count(*) FILTER (WHERE l_returnflag = 'R'), 10) AS pos_weight
FROM lineitem GROUP BY l_linestatus""")
def class_weight(spark, folder):
    lines = read_table(spark, folder, "lineitem").select(
        "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return class_balance(lines, "label", ["l_linestatus"]).withColumn(
        "pos_weight", F.round("pos_weight", 10))


@query("class_weight_rows", """
WITH w AS (SELECT count(*) FILTER (WHERE toxic = 0) / count(*) FILTER (WHERE toxic = 1) AS r
           FROM labels)
SELECT doc_id, toxic, round(CASE WHEN toxic = 1 THEN (SELECT r FROM w) ELSE 1.0 END, 10) AS weight
FROM labels""")
def class_weight_rows(spark, folder):
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic")
    return with_class_weight(labels, "toxic").withColumn("weight", F.round("weight", 10))
