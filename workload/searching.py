"""Search spaces per part, derived from its order lines; grids, draws, best trials."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline.operators import search
from cohortline.sources.tables import read_table
from workload.registry import query
from workload.sqltext import draws

# Bounds as text, some missing, unreadable or even: valid in both SQL dialects.
BOUNDS = {
    "learning_rate_min": "'0.01'",
    "learning_rate_max": "CAST(max(l_discount) AS STRING)",
    "learning_rate_step": "CASE WHEN min(l_linenumber) > 1 THEN NULL ELSE '0.02' END",
    "n_estimators_min": "CAST(CAST(min(l_quantity) AS INT) AS STRING)",
    "n_estimators_max": "CAST(CAST(max(l_quantity) AS INT) AS STRING)",
    "n_estimators_step": "CASE WHEN count(*) < 24 THEN 'ten' ELSE '10' END",
    "n_neighbors_min": "CAST(min(l_linenumber) AS STRING)",
    "n_neighbors_max": "CAST(2 * max(l_linenumber) + 1 AS STRING)",
    "n_neighbors_step": "'2'",
    "iterators_min": "'100'",
    "iterators_max": "CAST(100 * max(l_linenumber) AS STRING)",
    "iterators_step": "'50'",
    "random_state": "CASE WHEN max(l_tax) < 0.08 THEN NULL WHEN count(*) > 40 THEN '4.2' "
                    "ELSE CAST(count(*) AS STRING) END",
    "max_trial_counts": "CASE WHEN max(l_quantity) < 47 THEN NULL ELSE '3' END",
    "max_failed_trial_counts": "'1'",
    "parallel_trial_counts": "'2'",
}
METHODS = ("xgboost", "random_forest", "knn", "lr")

_FIELDS = ", ".join(f"{text} AS {name}" for name, text in BOUNDS.items())
_WHOLE = "regexp_full_match(trim({0}), '[+-]?[0-9]+')"


def _axis_checks(method: str, prefix: str, kind: str) -> str:
    names = [f"{prefix}_{b}" for b in ("min", "max", "step")]
    absent = " OR ".join(f"{n} IS NULL" for n in names)
    if kind == "int":
        readable = " AND ".join(_WHOLE.format(n) for n in names)
        positive = f"CAST({names[2]} AS BIGINT) <= 0"
    else:
        readable = " AND ".join(f"try_cast({n} AS DOUBLE) IS NOT NULL" for n in names)
        positive = f"CAST({names[2]} AS DOUBLE) <= 0"
    odd = ""
    if prefix == "n_neighbors":
        odd = (f" WHEN method = '{method}' AND NOT (CAST({names[0]} AS BIGINT) % 2 = 1"
               f" AND CAST({names[1]} AS BIGINT) % 2 = 1 AND CAST({names[2]} AS BIGINT) % 2 = 0)"
               f" THEN 'n_neighbors must stay odd'")
    return (f" WHEN method = '{method}' AND ({absent}) THEN '{prefix} needs min, max and step'"
            f" WHEN method = '{method}' AND NOT ({readable}) THEN '{prefix} must be {kind}'"
            f"{odd} WHEN method = '{method}' AND {positive} THEN '{prefix} step must be positive'")


_AXES = (("xgboost", "learning_rate", "double"), ("xgboost", "n_estimators", "int"),
         ("random_forest", "n_estimators", "int"), ("knn", "n_neighbors", "int"),
         ("lr", "iterators", "int"))
_COUNT_CHECKS = "".join(
    f" WHEN {c} IS NULL THEN '{c} is missing' WHEN NOT {_WHOLE.format(c)} THEN '{c} must be int'"
    for c in ("max_trial_counts", "max_failed_trial_counts", "parallel_trial_counts"))

CHECKED = f"""
WITH bounds AS (SELECT l_partkey AS task, {_FIELDS.replace('STRING', 'VARCHAR')}
                FROM lineitem GROUP BY l_partkey),
space AS (SELECT * FROM bounds,
          (SELECT unnest(['xgboost', 'random_forest', 'knn', 'lr']) AS method)),
checked AS (
  SELECT *, CASE {''.join(_axis_checks(*a) for a in _AXES)}
    WHEN random_state IS NOT NULL AND NOT {_WHOLE.format('random_state')} THEN 'random_state must be int'
    {_COUNT_CHECKS} END AS reason,
    CASE WHEN {_WHOLE.format('random_state')} THEN CAST(random_state AS BIGINT) ELSE 42 END AS seed
  FROM space)"""


def _steps(prefix: str, kind: str) -> str:
    low, high, step = (f"CAST({prefix}_{b} AS DOUBLE)" for b in ("min", "max", "step"))
    return f"unnest(range(CAST(floor(({high} - {low}) / {step} + 1e-9) AS BIGINT) + 1))"


def _value(prefix: str, index: str) -> str:
    return f"CAST({prefix}_min AS BIGINT) + {index} * CAST({prefix}_step AS BIGINT)"


def _part(method: str, axis: str, prefix: str) -> str:
    values = {n: "CAST(NULL AS BIGINT)" for n in ("ne", "nn", "it")}
    values[axis] = _value(prefix, "i")
    columns = ", ".join(f"{v} AS {n}" for n, v in values.items())
    return (f"SELECT task, method, seed, max_trial_counts, CAST(NULL AS DOUBLE) AS lr, {columns} "
            f"FROM (SELECT *, {_steps(prefix, 'int')} AS i FROM checked "
            f"WHERE reason IS NULL AND method = '{method}')")


GRID = CHECKED + f""",
parts AS (
  SELECT task, method, seed, max_trial_counts,
         round(CAST(learning_rate_min AS DOUBLE) + i * CAST(learning_rate_step AS DOUBLE), 10) AS lr,
         {_value('n_estimators', 'j')} AS ne, CAST(NULL AS BIGINT) AS nn, CAST(NULL AS BIGINT) AS it
  FROM (SELECT *, {_steps('n_estimators', 'int')} AS j
        FROM (SELECT *, {_steps('learning_rate', 'double')} AS i FROM checked
              WHERE reason IS NULL AND method = 'xgboost'))
  UNION ALL {_part('random_forest', 'ne', 'n_estimators')}
  UNION ALL {_part('knn', 'nn', 'n_neighbors')}
  UNION ALL {_part('lr', 'it', 'iterators')}),
grid AS (
  SELECT *, 'ne=' || coalesce(CAST(ne AS VARCHAR), '') || ',nn=' || coalesce(CAST(nn AS VARCHAR), '')
         || ',it=' || coalesce(CAST(it AS VARCHAR), '')
         || ',lr=' || coalesce(CAST(CAST(round(lr * 1000000) AS BIGINT) AS VARCHAR), '') AS trial
  FROM parts)"""


def search_space(spark, folder):
    """One row per (part, method); the bounds come from one aggregate of the lines."""
    bounds = read_table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("task")).agg(
        *[F.expr(text).alias(name) for name, text in BOUNDS.items()])
    methods = F.array(*[F.lit(m) for m in METHODS])
    return bounds.withColumn("method", F.explode(methods))


@query("trial_space_check", CHECKED + " SELECT task, method, reason, seed FROM checked")
def trial_space_check(spark, folder):
    return search.space_problems(search_space(spark, folder)).select(
        "task", "method", "reason", "seed")


@query("trial_grid", GRID + " SELECT task, method, trial, seed, lr, ne, nn, it FROM grid")
def trial_grid(spark, folder):
    checked = search.space_problems(search_space(spark, folder))
    return search.trial_grid(checked, ["task"]).select(
        "task", "method", "trial", "seed", "lr", "ne", "nn", "it")


_COUNT = "greatest(floor((CAST({0}_max AS DOUBLE) - CAST({0}_min AS DOUBLE)) / CAST({0}_step AS DOUBLE) + 1e-9) + 1, 0)"
_TOTAL = " ".join(f"WHEN '{m}' THEN {' * '.join(_COUNT.format(p) for q, p, _ in _AXES if q == m)}" for m in METHODS)


@query("trial_sample", CHECKED.replace("WITH", "WITH RECURSIVE", 1) + f""",
spaces AS (SELECT task, method, seed, CAST(CASE method {_TOTAL} END AS BIGINT) AS total,
                  CAST(max_trial_counts AS BIGINT) AS most FROM checked WHERE reason IS NULL),
{draws('spaces', 'task, method')}
SELECT task, method, CAST(number AS VARCHAR) AS trial, draw FROM drawn""")
def trial_sample(spark, folder):
    checked = search.space_problems(search_space(spark, folder))
    return search.draw_trials(checked, ["task"]).select("task", "method", "trial", "draw")


@query("best_trial", """
WITH scored AS (
  SELECT l_partkey AS task,
         CASE l_returnflag WHEN 'R' THEN 'random_forest' WHEN 'A' THEN 'knn' ELSE 'lr' END AS method,
         l_linenumber AS trial,
         avg(CASE WHEN (l_discount > 0.05) = (l_linestatus = 'F') THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM lineitem GROUP BY 1, 2, 3)
SELECT task, method, trial, accuracy FROM scored
QUALIFY row_number() OVER (PARTITION BY task, method ORDER BY accuracy DESC, trial) = 1""")
def best_trial(spark, folder):
    method = (F.when(F.col("l_returnflag") == "R", "random_forest")
              .when(F.col("l_returnflag") == "A", "knn").otherwise("lr"))
    hit = ((F.col("l_discount") > 0.05) == (F.col("l_linestatus") == "F")).cast("double")
    scored = read_table(spark, folder, "lineitem").groupBy(
        F.col("l_partkey").alias("task"), method.alias("method"),
        F.col("l_linenumber").alias("trial")).agg(F.avg(hit).alias("accuracy"))
    return search.best_trial(scored, ["task"])
