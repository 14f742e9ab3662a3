"""The tuned run: search each method, fit its best trial, choose, promote."""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortline.operators import classifiers, metrics, search
from cohortline.operators.boosting import BoostedModel, Boosting, boost_cells, boosting_cells, feature_cuts
from cohortline.operators.columns import feature_columns
from cohortline.operators.nearest import index_nearest, nearest_rows
from cohortline.operators.pure_forest import forest_points, grow_forest
from cohortline.plans.comparison import KNN, LR, RF, XGB, evaluate
from cohortline.plans.holding import ROWS_PER_TASK, held
from cohortline.sources.metrics import metrics_rows
from cohortline.sources.models import promote

#: How many rows a row of the kinds stands for.
COPIES = "_copies"

# Which model each searched method stands for.
MODEL_OF = {"lr": LR, "xgboost": XGB, "random_forest": RF, "knn": KNN}


@dataclass(frozen=True)
class TunedRun:
    trials: DataFrame
    best_trials: DataFrame
    metrics: DataFrame
    best: str
    accuracy: float
    action: str | None


class TrialTables:
    """The train split in the forms that the methods fit on.

    Only making them passes over all rows. Each is made when a trial first asks for it
    and shared by all trials of its method; a trial that fails to make it leaves none.
    ``kinds`` are the rows with those alike in features and label as one, their number in ``COPIES``.
    """

    def __init__(self, train: DataFrame, kinds: DataFrame, rows: int, features: Sequence[str], label: str, key: str):
        self.train, self.kinds, self.rows, self.features, self.label, self.key = train, kinds, rows, features, label, key
        self._made: dict = {}
        self._locks: dict[str, threading.Lock] = {method: threading.Lock() for method in MODEL_OF}

    def _once(self, method: str, name, make: Callable):
        with self._locks[method]:
            if (method, name) not in self._made:
                self._made[method, name] = make()
            return self._made[method, name]

    def cells(self):
        def make():
            cuts = feature_cuts(self.train, self.features, kinds=self.kinds)
            return boosting_cells(self.kinds, self.features, self.label, weight=COPIES,
                                  begin=BoostedModel(tuple(self.features), cuts))
        return self._once("xgboost", None, make)

    def points(self, trees: int, seed: int) -> DataFrame:
        return self._once("random_forest", (trees, seed), lambda: forest_points(
            self.train, self.features, self.label, self.key, trees, seed))

    def nearest(self, k: int) -> DataFrame:
        return self._once("knn", k, lambda: nearest_rows(self.train, self.features, self.key, self.label, k))


def fit_trial(method: str, params: dict, tables: TrialTables, most: int, depth: int = 6):
    """Fit one method with the parameters of a trial; forests grow to purity.

    ``most`` are the trees or neighbours of the largest trial that shares its table.
    """
    seed = int(params.get("seed") or search.DEFAULT_SEED)
    features, label = tables.features, tables.label
    if method == "lr":
        return classifiers.fit(classifiers.logistic(tables.rows, int(params["it"]), copies=COPIES), tables.kinds, features, label)
    if method == "xgboost":
        return boost_cells(tables.cells(), Boosting(int(params["ne"]), float(params["lr"]), depth))
    if method == "random_forest":
        return grow_forest(tables.points(most, seed), features, int(params["ne"]), seed)
    if method == "knn":
        return index_nearest(tables.nearest(most), features, int(params["nn"]))
    raise ValueError(f"unknown method {method!r}")


def tuned_run(df: DataFrame, space: DataFrame, label: str, key: str, run_id: str,
              store: str | None = None, task: str | None = None,
              goal: float = search.GOAL) -> TunedRun:
    """Search, fit and choose on a table with ``split`` in (train, test).

    The space has one row per method; methods without a row are left out.
    With ``store`` and ``task`` the winner is promoted if it beats the stored
    model.
    """
    spark: SparkSession = df.sparkSession
    checked = search.sound_space(space)
    drawn = search.draw_trials(checked)
    per_method: dict[str, list[dict]] = {}
    for row in drawn.orderBy("method", "draw").collect():
        per_method.setdefault(row["method"], []).append(row.asDict())
    features = feature_columns(df, label, [key, "split"])
    # Trees or neighbours of the largest trial: what it needs of the rows does for the others as well.
    most = {method: max(int(p["ne"] or p["nn"] or 0) for p in trials) for method, trials in per_method.items()}
    with (held(df.select(key, *features, label, "split")) as (frame, _),
          held(frame.groupBy(*features, label, "split").agg(F.count("*").alias(COPIES))) as (kinds, kind_rows)):
        # Few kinds in as many pieces as a shuffle makes would cost every trial more in tasks than in work.
        kinds = kinds.coalesce(max(1, math.ceil(kind_rows / ROWS_PER_TASK)))
        train = frame.filter(F.col("split") == "train")
        train_kinds = kinds.filter(F.col("split") == "train")
        test = kinds.filter(F.col("split") == "test")
        rows = train_kinds.agg(F.sum(COPIES)).first()[0] or 0
        tables = TrialTables(train, train_kinds, rows, features, label, key)

        def objective(method: str, params: dict) -> float:
            return evaluate(fit_trial(method, params, tables, most[method]), test, label, COPIES)

        results = {
            method: search.run_trials(
                spark, trials, lambda p, m=method: objective(m, p),
                parallel=int(trials[0]["parallel_trial_counts"]), goal=goal,
                max_failed=int(trials[0]["max_failed_trial_counts"]))
            for method, trials in per_method.items()
        }
        trials = search.trials_table(spark, results)
        best_trials = search.best_trial(trials, params=("trial", "lr", "ne", "nn", "it"))
        models, found = {}, []
        for row in best_trials.collect():
            name = MODEL_OF[row.method]
            models[name] = fit_trial(row.method, row.asDict(), tables, most[row.method])
            found.append((run_id, name, "test", evaluate(models[name], test, label, COPIES), None))
        table = metrics_rows(spark, found)
        best = metrics.best_model(table).first()
        action = None
        if store and task:
            action = promote(spark, store, task, best.model, best.accuracy, models[best.model])
    return TunedRun(trials, best_trials, table, best.model, best.accuracy, action)


def space_of(spark: SparkSession, **methods: dict) -> DataFrame:
    """A search space from keyword arguments, one per method, for use without a file."""
    names = ("method",) + search.SPACE_FIELDS
    rows = [tuple({"method": m, **{k: str(v) for k, v in given.items()}}.get(n) for n in names)
            for m, given in methods.items()]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
