"""Sources, projections, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.functions.markers import to_number
from cohortline.operators import columns, rows
from cohortline.operators.features import split_features
from cohortline.operators.union import union_sources
from cohortline.plans.cleaning import clean
from cohortline.plans.specs import TableSpec
from cohortline.sources.tables import read_table
from pyspark.ml.functions import vector_to_array
from workload.registry import query

PARTY_ALIASES = {
    "name": ("name", "c_name", "s_name"),
    "nation": ("nation", "c_nationkey", "s_nationkey"),
    "balance": ("balance", "c_acctbal", "s_acctbal"),
    "segment": ("segment", "c_mktsegment"),
}
SEGMENTS = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}


@query("canonical_union", """
SELECT 'customer' AS source, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def canonical_union(spark, folder):
    parties = union_sources({
        name: columns.rename_by_alias(read_table(spark, folder, name), PARTY_ALIASES)
        for name in ("customer", "supplier")})
    return columns.keep_columns(parties, ["source", "name", "nation", "balance", "segment"])


@query("source_merge", """
WITH raw AS (
  SELECT 'c-' || CAST(c_custkey AS VARCHAR) AS party, c_nationkey AS nation,
         c_acctbal AS balance,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
              WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS segment
  FROM customer WHERE c_acctbal >= 0),
coded AS (
  SELECT 's-' || CAST(s_suppkey AS VARCHAR) AS party, s_nationkey AS nation,
         s_acctbal AS balance, s_suppkey % 5 AS segment FROM supplier),
merged AS (SELECT 'raw' AS source, * FROM raw UNION ALL SELECT 'coded', * FROM coded)
SELECT source, party, CAST(nation AS DOUBLE) AS nation, balance,
       CAST(segment AS DOUBLE) AS segment
FROM merged
WHERE party NOT IN (SELECT 'c-' || CAST(o_custkey AS VARCHAR) FROM orders
                    WHERE o_totalprice > 490000)""")
def source_merge(spark, folder):
    raw = read_table(spark, folder, "customer").select(
        F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("party"), "c_name",
        F.col("c_nationkey").alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit("N/A")).otherwise(
            F.col("c_acctbal").cast("string")).alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    coded = read_table(spark, folder, "supplier").select(
        F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("party"),
        "s_nationkey", F.col("s_acctbal").alias("balance"),
        (F.col("s_suppkey") % 5).alias("segment"))
    raw_spec = TableSpec(label="", drop=("c_name",), required=("balance", "segment"),
                         codes={"segment": SEGMENTS})
    both = union_sources({
        "raw": clean(raw, raw_spec, ["party"]),
        "coded": clean(columns.rename_columns(coded, {"s_nationkey": "nation"}),
                       TableSpec(label=""), ["party"])})
    denied = read_table(spark, folder, "orders").filter("o_totalprice > 490000").select(
        F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("party"))
    return rows.drop_denied(both, denied, ["party"]).select(
        "source", "party", "nation", "balance", F.col("segment").cast("double").alias("segment"))


@query("rename_column", "SELECT o_orderkey AS order_id, o_orderstatus FROM orders")
def rename_column(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return columns.rename_columns(orders, {"o_orderkey": "order_id"})


@query("select_canonical", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def select_canonical(spark, folder):
    return columns.keep_columns(
        read_table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])


@query("drop_listed", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def drop_listed(spark, folder):
    return columns.drop_columns(read_table(spark, folder, "part"), ["p_name", "p_retailprice"])


@query("reorder_front", """
SELECT c_mktsegment, c_nationkey, c_custkey, c_name, c_acctbal FROM customer""")
def reorder_front(spark, folder):
    return columns.move_to_front(
        read_table(spark, folder, "customer"), ["c_mktsegment", "c_nationkey"])


@query("feature_label_stats", """
SELECT CAST(l_returnflag = 'R' AS INT)::DOUBLE AS label, count(*) AS n,
       round(sum(l_quantity), 2) AS sum_quantity, round(sum(l_extendedprice), 2) AS sum_price,
       round(sum(l_discount), 4) AS sum_discount, round(sum(l_tax), 4) AS sum_tax,
       max(l_extendedprice) AS max_price
FROM lineitem GROUP BY 1""")
def feature_label_stats(spark, folder):
    lines = read_table(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    features = columns.feature_columns(lines, "returned")
    vectors = split_features(lines, "returned", features).withColumn(
        "x", vector_to_array("features"))
    return vectors.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("x")[0]), 2).alias("sum_quantity"),
        F.round(F.sum(F.col("x")[1]), 2).alias("sum_price"),
        F.round(F.sum(F.col("x")[2]), 4).alias("sum_discount"),
        F.round(F.sum(F.col("x")[3]), 4).alias("sum_tax"),
        F.max(F.col("x")[1]).alias("max_price"))


@query("drop_placeholder_label", """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
WHERE nullif(o_orderpriority, '5-LOW') IS DISTINCT FROM '4-NOT SPECIFIED'""")
def drop_placeholder_label(spark, folder):
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    return rows.drop_placeholder(orders, "priority", "4-NOT SPECIFIED")


@query("require_valid", """
SELECT * FROM (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'N/A' ELSE o_orderpriority END AS priority,
         CASE WHEN o_totalprice < 1000 THEN NULL ELSE o_totalprice END AS price FROM orders)
WHERE status IS NOT NULL AND priority IS NOT NULL AND priority <> 'N/A' AND price IS NOT NULL""")
def require_valid(spark, folder):
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("N/A"))
        .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(~(F.col("o_totalprice") < 1000), F.col("o_totalprice")).alias("price"))
    return rows.require_valid(orders, ["status", "priority", "price"])


@query("exclude_code", """
SELECT c_custkey, nullif(c_nationkey, 3) AS nation FROM customer
WHERE nullif(c_nationkey, 3) IS DISTINCT FROM 2""")
def exclude_code(spark, folder):
    customers = read_table(spark, folder, "customer").select(
        "c_custkey", F.expr("nullif(c_nationkey, 3)").alias("nation"))
    return rows.exclude_code(customers, "nation", 2)


@query("min_non_null", """
SELECT * FROM (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
         CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS price,
         CASE WHEN o_custkey < 700 THEN o_custkey END AS customer FROM orders)
WHERE (CASE WHEN status IS NULL THEN 0 ELSE 1 END) + (CASE WHEN priority IS NULL THEN 0 ELSE 1 END)
    + (CASE WHEN price IS NULL THEN 0 ELSE 1 END) + (CASE WHEN customer IS NULL THEN 0 ELSE 1 END)
    + (CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END) >= 4""")
def min_non_null(spark, folder):
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("priority"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_custkey") < 700, F.col("o_custkey")).alias("customer"))
    return rows.min_non_null(orders, 4)


@query("deny_list_anti_join", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem
                  WHERE l_orderkey = o_orderkey AND l_quantity >= 49 AND l_discount >= 0.09)""")
def deny_list_anti_join(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    denied = read_table(spark, folder, "lineitem").filter(
        "l_quantity >= 49 AND l_discount >= 0.09").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.drop_denied(orders, denied, ["o_orderkey"])


@query("safe_cast", """
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       try_cast(CASE WHEN event_type = 'error' THEN 'No Info' ELSE '1.5' END AS DOUBLE) AS reading
FROM events""")
def safe_cast(spark, folder):
    return read_table(spark, folder, "events").select(
        "event_id", to_number(F.get_json_object("props", "$.k")).alias("k"),
        to_number(F.when(F.col("event_type") == "error", F.lit("No Info"))
                  .otherwise(F.lit("1.5"))).alias("reading"))
