"""Accuracy, leaderboards, metric records, promotion: rule-based classifiers per part."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.functions.scores import class_from_probability
from cohortline.operators.metrics import (
    accuracy_by, best_model, promotion, report, rule_metrics,
)
from cohortline.operators.split import with_split
from cohortline.sources.tables import read_table
from workload.registry import query
from workload.splitting import LINE_KEY
from workload.sqltext import split_80_10_10

RULES = {
    "LogisticRegression": "l_discount > 0.05",
    "XGBoost": "l_quantity > 25",
    "RandomForest": "l_tax >= 0.04",
    "KNN": "l_linenumber >= 4",
}


def _per_model(by: str, where: str = "TRUE") -> str:
    """SQL: accuracy of every rule per group."""
    return " UNION ALL ".join(
        f"SELECT {by}, '{model}' AS model, {rank} AS rank, "
        f"avg(CASE WHEN ({rule}) = (l_returnflag = 'R') THEN 1.0 ELSE 0.0 END) AS accuracy "
        f"FROM lines WHERE {where} GROUP BY {by}"
        for rank, (model, rule) in enumerate(RULES.items()))


PER_PART = f"WITH lines AS (SELECT * FROM lineitem), m AS ({_per_model('l_partkey')})"


def _lines(spark, folder):
    return read_table(spark, folder, "lineitem").withColumn(
        "label", (F.col("l_returnflag") == "R").cast("int"))


def _rules(lines, by):
    predictions = {model: F.expr(rule).cast("int") for model, rule in RULES.items()}
    return rule_metrics(lines, by, "label", predictions)


@query("accuracy_by_split", f"""
SELECT split, count_if(label IS NULL) AS n_unlabelled, count_if(prediction IS NULL) AS n_unpredicted,
       count(hit) AS n, CAST(sum(hit) AS BIGINT) AS n_correct, avg(hit) AS accuracy
FROM (SELECT *, CASE WHEN label = prediction THEN 1.0 WHEN label <> prediction THEN 0.0 END AS hit
      FROM (SELECT {split_80_10_10(LINE_KEY)} AS split,
                   CASE WHEN l_tax > 0 THEN CAST(l_returnflag = 'R' AS INT) END AS label,
                   CASE WHEN l_linenumber < 7 THEN CAST(l_discount > 0.05 AS INT) END AS prediction FROM lineitem))
GROUP BY split""")
def accuracy_by_split(spark, folder):
    """Some rows have no label, some no prediction: they are counted, not lost."""
    lines = with_split(_lines(spark, folder), ["l_orderkey", "l_linenumber"])
    scored = lines.withColumns({"label": F.when(F.col("l_tax") > 0, F.col("label")),
                                "prediction": F.when(F.col("l_linenumber") < 7, (F.col("l_discount") > 0.05).cast("int"))})
    return accuracy_by(scored, ["split"])


@query("threshold_class", """
SELECT l_discount AS discount, CAST(l_discount * 10 > 0.5 AS DOUBLE) AS prediction,
       count(*) AS n FROM lineitem GROUP BY 1, 2""")
def threshold_class(spark, folder):
    lines = read_table(spark, folder, "lineitem").select(F.col("l_discount").alias("discount"))
    return lines.groupBy(
        "discount", class_from_probability(F.col("discount") * 10).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("leaderboard_best", PER_PART + """
SELECT l_partkey, model, accuracy FROM m
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY accuracy DESC, rank) = 1""")
def leaderboard_best(spark, folder):
    metrics = _rules(_lines(spark, folder), ["l_partkey"])
    return best_model(metrics.withColumn("model_path", F.lit(None).cast("string")),
                      ["l_partkey"]).drop("model_path")


@query("leaderboard_report", PER_PART + """
, t AS (SELECT l_partkey, model, rank, accuracy,
               CAST(CAST(accuracy AS DECIMAL(8, 6)) AS VARCHAR) AS shown FROM m),
best AS (SELECT * FROM t
         QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY accuracy DESC, rank) = 1),
lines_of AS (SELECT l_partkey, string_agg(
               CASE WHEN length(model) < 17 THEN rpad(model, 17, ' ') ELSE model END
               || ' : ' || shown || chr(10), '' ORDER BY rank) AS body FROM t GROUP BY l_partkey)
SELECT l_partkey, 'Best Model is ' || model || ' : ' || shown || chr(10) || 'Accuracy:' || chr(10)
       || body AS report
FROM best JOIN lines_of USING (l_partkey)""")
def leaderboard_report(spark, folder):
    metrics = _rules(_lines(spark, folder), ["l_partkey"])
    shown = F.col("accuracy").cast("decimal(8,6)").cast("string")
    return report(metrics, ["l_partkey"], number=shown)


@query("metrics_table", f"""
WITH lines AS (SELECT *, {split_80_10_10(LINE_KEY)} AS split FROM lineitem),
m AS ({_per_model('l_partkey, split')})
SELECT 'part-' || CAST(l_partkey AS VARCHAR) AS run_id, model, split, accuracy,
       'models/part-' || CAST(l_partkey AS VARCHAR) || '/' || model AS model_path FROM m""")
def metrics_table(spark, folder):
    lines = with_split(_lines(spark, folder), ["l_orderkey", "l_linenumber"])
    run = F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))
    return _rules(lines, ["l_partkey", "split"]).select(
        run.alias("run_id"), "model", "split", "accuracy",
        F.concat_ws("/", F.lit("models"), run, "model").alias("model_path"))


@query("champion_challenger", """
WITH hits AS (
  SELECT l_partkey, l_linestatus, l_tax,
         CASE WHEN (l_discount > 0.05) = (l_returnflag = 'R') THEN 1.0 ELSE 0.0 END AS hit
  FROM lineitem),
champ AS (
  SELECT l_partkey AS task, TRUE AS stored,
         CASE WHEN count(*) >= 8 THEN CAST(avg(hit) AS DECIMAL(8, 6)) END AS a
  FROM hits WHERE l_linestatus = 'F' GROUP BY l_partkey HAVING min(l_tax) = 0),
chall AS (
  SELECT l_partkey AS task, CAST(CAST(avg(hit) AS DECIMAL(8, 6)) AS DOUBLE) AS a
  FROM hits WHERE l_linestatus = 'O' GROUP BY l_partkey HAVING max(l_tax) = 0.08),
j AS (SELECT task, stored, CAST(champ.a AS DOUBLE) AS champion_accuracy,
             chall.a AS challenger_accuracy FROM champ FULL JOIN chall USING (task)),
k AS (SELECT *, CASE WHEN challenger_accuracy IS NULL THEN 'retain'
                     WHEN stored IS NULL THEN 'save_new'
                     WHEN champion_accuracy IS NULL THEN 'replace'
                     WHEN challenger_accuracy > champion_accuracy THEN 'replace'
                     ELSE 'retain' END AS action FROM j)
SELECT task, champion_accuracy, challenger_accuracy, action,
       CASE WHEN action = 'retain' THEN champion_accuracy ELSE challenger_accuracy END
       AS stored_accuracy FROM k""")
def champion_challenger(spark, folder):
    """Stored models scored on old lines, new ones on open lines; small records are unreadable."""
    lines = _lines(spark, folder)
    hit = ((F.col("l_discount") > 0.05).cast("int") == F.col("label")).cast("double")
    exact = F.avg(hit).cast("decimal(8,6)")
    tasks = lines.groupBy(F.col("l_partkey").alias("task"), "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), exact.alias("exact"),
        F.min("l_tax").alias("low"), F.max("l_tax").alias("high"))
    champions = tasks.filter("l_linestatus = 'F' AND low = 0").select(
        "task", F.when(F.col("n") < 8, F.lit("{broken")).otherwise(
            F.col("exact").cast("string")).alias("accuracy_text"))
    challengers = tasks.filter("l_linestatus = 'O' AND high = 0.08").select(
        "task", F.col("exact").cast("double").alias("accuracy"))
    return promotion(champions, challengers)
