"""Encodings and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.functions.codes import conditional_code, encode
from cohortline.operators.impute import impute_means
from cohortline.operators.split import with_split
from cohortline.plans.specs import SEX_WITH_OTHER
from cohortline.sources.tables import read_table
from workload.registry import query
from workload.sqltext import split_80_10_10

PRIORITIES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": 4}
INDUSTRIAL = {"MACHINERY": 1, "BUILDING": 1, "AUTOMOBILE": 1, "FURNITURE": 0, "HOUSEHOLD": 0}


@query("dict_encode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS status FROM orders""")
def dict_encode(spark, folder):
    return read_table(spark, folder, "orders").select(
        "o_orderkey", encode("o_orderstatus", {"F": 1, "O": 0}).alias("status"))


@query("conditional_encode", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 END AS level
FROM customer""")
def conditional_encode(spark, folder):
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        conditional_code([(F.col("c_acctbal") < 0, 0), (F.col("c_acctbal") < 5000, 1)]).alias("level"))


@query("ordinal_encode", """
SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS priority FROM orders""")
def ordinal_encode(spark, folder):
    return read_table(spark, folder, "orders").select(
        "o_orderkey", encode("o_orderpriority", PRIORITIES).alias("priority"))


@query("collapse_encode", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN 1
                       WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 0 END AS industrial
FROM customer""")
def collapse_encode(spark, folder):
    return read_table(spark, folder, "customer").select(
        "c_custkey", encode("c_mktsegment", INDUSTRIAL).alias("industrial"))


@query("sex_encode", """
SELECT sex, n, CASE sex WHEN 'Male' THEN 0 WHEN 'Female' THEN 1 WHEN 'Other' THEN 2 END AS code
FROM (SELECT CASE l_returnflag WHEN 'A' THEN 'Male' WHEN 'N' THEN 'Female' ELSE 'Other' END AS sex,
             count(*) AS n FROM lineitem GROUP BY 1)""")
def sex_encode(spark, folder):
    lines = read_table(spark, folder, "lineitem").select(F.expr(
        "CASE l_returnflag WHEN 'A' THEN 'Male' WHEN 'N' THEN 'Female' ELSE 'Other' END").alias("sex"))
    return lines.groupBy("sex", encode("sex", SEX_WITH_OTHER).alias("code")).agg(
        F.count(F.lit(1)).alias("n"))


@query("mean_impute", """
WITH known AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS DOUBLE) END AS nation FROM customer)
SELECT c_custkey, round(coalesce(balance, (SELECT avg(balance) FROM known)), 6) AS balance,
       round(coalesce(nation, (SELECT avg(nation) FROM known)), 6) AS nation
FROM known""")
def mean_impute(spark, folder):
    customers = read_table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.lit("No Info")).otherwise(
            F.col("c_acctbal").cast("string")).alias("balance"),
        F.expr("nullif(c_nationkey, 7)").alias("nation"))
    filled = impute_means(customers, ["balance", "nation"])
    return filled.select("c_custkey", F.round("balance", 6).alias("balance"),
                         F.round("nation", 6).alias("nation"))


@query("mean_impute_train", f"""
WITH known AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         {split_80_10_10("CAST(c_custkey AS VARCHAR)")} AS split FROM customer)
SELECT c_custkey, split,
       round(coalesce(balance, (SELECT avg(balance) FROM known WHERE split = 'train')), 6) AS balance
FROM known""")
def mean_impute_train(spark, folder):
    customers = read_table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    parts = with_split(customers, ["c_custkey"])
    filled = impute_means(parts, ["balance"], fit_where=F.col("split") == "train")
    return filled.withColumn("balance", F.round("balance", 6))
