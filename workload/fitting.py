"""Classifiers on order lines, most of them on a planted rule that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.functions.keys import hash_fraction_bucket
from cohortline.operators import classifiers, search
from cohortline.operators.boosting import Boosting, fit_boosted
from cohortline.operators.metrics import with_class_weight
from cohortline.operators.pure_forest import fit_forest
from cohortline.operators.split import TRAIN_TEST, TRAIN_VAL_TEST, with_split
from cohortline.plans.comparison import Settings, compare_models
from cohortline.plans.holding import held
from cohortline.plans.tuned import space_of, tuned_run
from cohortline.sources.tables import read_table
from workload.registry import query
from workload.sqltext import bucket, draws, split_80_10_10, split_80_20

FEATURES = ["quantity", "discount", "tax", "price", "line"]
KEY = "line_key"


def _lines(spark, folder, shares=TRAIN_VAL_TEST):
    """Order lines with a label that follows from price per piece."""
    lines = read_table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias(KEY),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"), (F.col("l_extendedprice") / 1000).alias("price"),
        F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) > F.col("l_quantity") * 1800)
        .cast("int").alias("dear"))
    return with_split(lines, [KEY], shares)


PLANTED = ["discount", "tax", "line"]
LINE_KEY = "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))"


def _planted(spark, folder, shares=TRAIN_VAL_TEST):
    """Order lines whose mark follows a rule on the discount, turned round on a tenth of the rows.

    Any sound fit finds the rule, so its predictions have a SQL form.
    """
    lines = read_table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias(KEY),
        F.round(F.col("l_discount") * 100).alias("discount"), F.round(F.col("l_tax") * 100).alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"))
    turned = hash_fraction_bucket([KEY], 10, "turned") == 0
    return with_split(lines.withColumn("marked", ((F.col("discount") > 5.5) != turned).cast("int")), [KEY], shares)


def _planted_sql(split: str) -> str:
    """The rule's class of every test row."""
    turned = f"{bucket(LINE_KEY, 10, 'turned')} = 0"
    return f"""
SELECT {LINE_KEY} AS {KEY}, round(l_discount * 100) AS discount, round(l_tax * 100) AS tax,
       CAST(l_linenumber AS DOUBLE) AS line,
       CAST((round(l_discount * 100) > 5.5) <> ({turned}) AS INT) AS marked,
       CAST(round(l_discount * 100) > 5.5 AS INT)::DOUBLE AS prediction
FROM lineitem WHERE {split} = 'test'"""


def _found(model, lines):
    return classifiers.score(model, _part(lines, "test")).select(KEY, *PLANTED, "marked", "prediction")


def _part(df, name):
    return df.filter(F.col("split") == name)


@query("lr_predict", _planted_sql(split_80_10_10(LINE_KEY)))
def lr_predict(spark, folder):
    lines = _planted(spark, folder)
    with held(_part(lines, "train")) as (train, rows):
        model = classifiers.fit(classifiers.logistic(rows, max_iter=10_000), train, PLANTED, "marked")
    return _found(model, lines)


@query("lr_probability")
def lr_probability(spark, folder):
    lines = _lines(spark, folder, TRAIN_TEST)
    with held(_part(lines, "train")) as (train, rows):
        model = classifiers.fit(
            classifiers.logistic(rows, max_iter=10_000), train, FEATURES, "dear")
    scored = classifiers.score_by_threshold(model, _part(lines, "test"))
    return scored.select(KEY, "dear", F.round("p", 6).alias("p"), "prediction")


@query("rf_predict", _planted_sql(split_80_10_10(LINE_KEY)))
def rf_predict(spark, folder):
    """Five trees on bagged rows, grown until every leaf is pure or holds equal points."""
    lines = _planted(spark, folder)
    model = fit_forest(_part(lines, "train"), PLANTED, "marked", KEY, trees=5)
    return _scored(model, lines, PLANTED)


@query("rf_pure_train", f"""
SELECT {LINE_KEY} AS {KEY}, dear, CAST(dear AS DOUBLE) AS prediction, CAST(dear AS DOUBLE) AS p
FROM (SELECT *, CAST(l_extendedprice * (1 - l_discount) > l_quantity * 1800 AS INT) AS dear FROM lineitem)
WHERE {split_80_10_10(LINE_KEY)} = 'train'""")
def rf_pure_train(spark, folder):
    """One tree without bagging, scored on its own rows: no two of them are alike and differ in class."""
    lines = _lines(spark, folder)
    train = _part(lines, "train")
    model = fit_forest(train, FEATURES, "dear", trees=1)
    return model.score(train).select(KEY, "dear", "prediction", "p")


@query("rf_default_predict", _planted_sql(split_80_20(LINE_KEY)))
def rf_default_predict(spark, folder):
    lines = _planted(spark, folder, TRAIN_TEST)
    with held(_part(lines, "train")) as (train, _):
        model = classifiers.fit(classifiers.default_forest(), train, PLANTED, "marked")
    return _found(model, lines)


def _scored(model, lines, features, label="marked"):
    return model.score(_part(lines, "test")).select(KEY, *features, label, "prediction")


@query("gbt_predict", _planted_sql(split_80_10_10(LINE_KEY)))
def gbt_predict(spark, folder):
    """Weighted boosting of up to 1000 rounds that stops on the validation split."""
    lines = _planted(spark, folder)
    train = with_class_weight(_part(lines, "train"), "marked")
    val = with_class_weight(_part(lines, "val"), "marked", mode="none")
    model = fit_boosted(train, PLANTED, "marked", Boosting(1000, 0.3, 3, patience=10), val, "weight")
    return _scored(model, lines, PLANTED)


@query("gbt_slow_predict", _planted_sql(split_80_20(LINE_KEY)))
def gbt_slow_predict(spark, folder):
    """1000 rounds of small steps, without an early stop."""
    lines = _planted(spark, folder, TRAIN_TEST)
    model = fit_boosted(_part(lines, "train"), PLANTED, "marked", Boosting(1000, 0.01, 6))
    return _scored(model, lines, PLANTED)


def _with_gaps(lines):
    """The planted lines without the discount of every third line number; such rows are marked by rule."""
    gap = F.col("line") % 3 == 0
    turned = hash_fraction_bucket([KEY], 10, "turned") == 0
    return lines.withColumns({
        "marked": F.when(gap, (~turned).cast("int")).otherwise(F.col("marked")),
        "discount": F.when(~gap, F.col("discount"))}).drop("line")


@query("gbt_gaps_predict", f"""
SELECT {LINE_KEY} AS {KEY}, CASE WHEN l_linenumber % 3 > 0 THEN round(l_discount * 100) END AS discount,
       round(l_tax * 100) AS tax,
       CAST((l_linenumber % 3 = 0 OR round(l_discount * 100) > 5.5)
            <> ({bucket(LINE_KEY, 10, 'turned')} = 0) AS INT) AS marked,
       CAST(l_linenumber % 3 = 0 OR round(l_discount * 100) > 5.5 AS INT)::DOUBLE AS prediction
FROM lineitem WHERE {split_80_10_10(LINE_KEY)} = 'test'""")
def gbt_gaps_predict(spark, folder):
    """Boosting on a table with missing values: the side they belong to is learnt, nothing is filled."""
    lines = _with_gaps(_planted(spark, folder))
    features = ["discount", "tax"]
    model = fit_boosted(_part(lines, "train"), features, "marked", Boosting(1000, 0.3, 3, patience=10), _part(lines, "val"))
    return _scored(model, lines, features)


def _best_cut_sql(rows: str, node: str, name: str) -> str:
    """The best cut of the rows of each side, from sums of gradients (0.5 - y) and hessians (0.25) up to every value."""
    return f"""
{name}_sums AS (
  SELECT {node} AS node, f, v, sum(0.5 - marked) AS g, 0.25 * count(*) AS h FROM {rows} GROUP BY 1, 2, 3),
{name}_cuts AS (
  SELECT node, f, v + (lead(v) OVER w - v) / 2 AS threshold, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
         sum(g) OVER (PARTITION BY node, f) AS g, sum(h) OVER (PARTITION BY node, f) AS h
  FROM {name}_sums WINDOW w AS (PARTITION BY node, f ORDER BY v)),
{name} AS (
  SELECT node, f, threshold, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain,
         -gl / (hl + 1) AS low, -(g - gl) / (h - hl + 1) AS high
  FROM {name}_cuts WHERE threshold IS NOT NULL AND hl >= 1 AND h - hl >= 1
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, threshold) = 1)"""


@query("gbt_first_tree", f"""
WITH planted AS ({_planted_sql(split_80_20(LINE_KEY)).replace("= 'test'", "= 'train'")}),
flat AS (
  SELECT 0 AS f, discount AS v, * FROM planted UNION ALL SELECT 1, tax, * FROM planted UNION ALL
  SELECT 2, line, * FROM planted),
{_best_cut_sql("flat", "0", "root")},
sides AS (
  SELECT CASE WHEN CASE root.f WHEN 0 THEN discount WHEN 1 THEN tax ELSE line END <= threshold THEN 1 ELSE 2 END AS side,
         flat.* FROM flat, root),
{_best_cut_sql("sides", "side", "below")}
SELECT CAST(node AS INT) AS node, CAST(f AS INT) AS feature, threshold, round(gain, 6) AS gain,
       round(low, 6) AS low, round(high, 6) AS high
FROM (SELECT * FROM root UNION ALL SELECT * FROM below) WHERE gain > 1e-6""")
def gbt_first_tree(spark, folder):
    """The cuts of one tree of two levels, with their gains and the weights of their sides."""
    lines = _planted(spark, folder, TRAIN_TEST)
    model = fit_boosted(_part(lines, "train"), PLANTED, "marked", Boosting(1, 1.0, 2))
    tree = model.trees[0]
    rows = [(i, int(tree.feature[i]), float(model.cuts[tree.feature[i]][tree.cut[i]]), round(float(tree.gain[i]), 6),
             round(float(tree.value[2 * i + 1]), 6), round(float(tree.value[2 * i + 2]), 6))
            for i in range(3) if tree.feature[i] >= 0]
    return spark.createDataFrame(rows, "node int, feature int, threshold double, gain double, low double, high double")


def _held_out(spark, folder, shares):
    """The planted rule, turned round on a tenth of the rows outside the train split only."""
    lines = _planted(spark, folder, shares)
    rule = (F.col("discount") > 5.5).cast("int")
    return lines.withColumn("marked", F.when(F.col("split") == "train", rule).otherwise(F.col("marked")))


_RIGHT = f"round(avg(CASE WHEN {bucket(LINE_KEY, 10, 'turned')} = 0 THEN 0.0 ELSE 1.0 END), 6)"


@query("planted_leaderboard", f"""
SELECT 'planted' AS run_id, model, {split_80_10_10(LINE_KEY)} AS split, {_RIGHT} AS accuracy
FROM lineitem, (SELECT unnest(['LogisticRegression', 'XGBoost', 'RandomForest', 'KNN']) AS model)
GROUP BY 2, 3 HAVING split <> 'train'""")
def planted_leaderboard(spark, folder):
    """The four models with the parameters of a standard run, on a rule that each must find."""
    run = compare_models(_held_out(spark, folder, TRAIN_VAL_TEST), "marked", KEY, "planted", settings=Settings())
    return run.metrics.select("run_id", "model", "split", F.round("accuracy", 6).alias("accuracy"))


_SPACE_COUNTS = {"max_trial_counts": 3, "max_failed_trial_counts": 0, "parallel_trial_counts": 2}
_SPACE = {
    "lr": dict(iterators_min=20, iterators_max=100, iterators_step=20, **_SPACE_COUNTS),
    "xgboost": dict(learning_rate_min=0.1, learning_rate_max=0.5, learning_rate_step=0.1, n_estimators_min=10,
                    n_estimators_max=50, n_estimators_step=10, **_SPACE_COUNTS),
    "random_forest": dict(n_estimators_min=3, n_estimators_max=9, n_estimators_step=2, **_SPACE_COUNTS),
    "knn": dict(n_neighbors_min=1, n_neighbors_max=9, n_neighbors_step=2, **_SPACE_COUNTS)}
#: Combinations of each method's steps above.
_SIZES = {"lr": (1, 5), "xgboost": (5, 5), "random_forest": (1, 4), "knn": (1, 5)}


@query("tuned_trials", "WITH RECURSIVE space(method, seed, total, most) AS (VALUES "
       + ", ".join(f"('{m}', CAST(42 AS BIGINT), CAST({a * b} AS BIGINT), CAST(3 AS BIGINT))" for m, (a, b) in _SIZES.items())
       + f"), {draws('space', 'method')} SELECT method, CAST(number AS VARCHAR) AS trial, (SELECT {_RIGHT} FROM lineitem "
       f"WHERE {split_80_20(LINE_KEY)} = 'test') AS accuracy FROM drawn")
def tuned_trials(spark, folder):
    """Random search over all four methods, scored on the test split; the finished trials.

    A tenth of the test rows is turned round, so no trial reaches the goal and all run.
    """
    run = tuned_run(_held_out(spark, folder, TRAIN_TEST), space_of(spark, **_SPACE), "marked", KEY, "tuned", goal=search.GOAL)
    return run.trials.select("method", "trial", F.round("accuracy", 6).alias("accuracy"))
