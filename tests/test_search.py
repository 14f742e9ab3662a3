import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortline.operators import boosting, classifiers, nearest, pure_forest, search
from cohortline.operators.split import with_split
from cohortline.plans.comparison import evaluate
from cohortline.plans.tuned import space_of, tuned_run

COUNTS = {"max_trial_counts": 4, "max_failed_trial_counts": 1, "parallel_trial_counts": 2}
LR = dict(iterators_min=10, iterators_max=30, iterators_step=10, **COUNTS)
KNN = dict(n_neighbors_min=1, n_neighbors_max=5, n_neighbors_step=2, **COUNTS)
XGB = dict(learning_rate_min=0.1, learning_rate_max=0.3, learning_rate_step=0.1,
           n_estimators_min=10, n_estimators_max=20, n_estimators_step=5, **COUNTS)


@pytest.mark.parametrize("method, given, reason", [
    ("lr", LR, None), ("knn", KNN, None), ("xgboost", XGB, None),
    ("lr", {**LR, "iterators_min": "x"}, "iterators must be int"),
    ("lr", {**LR, "iterators_min": "1.5"}, "iterators must be int"),
    ("lr", {k: v for k, v in LR.items() if k != "iterators_max"}, "iterators needs min, max and step"),
    ("lr", {**LR, "iterators_step": 0}, "iterators step must be positive"),
    ("lr", {**LR, "random_state": "abc"}, "random_state must be int"),
    ("lr", {**LR, "parallel_trial_counts": "many"}, "parallel_trial_counts must be int"),
    ("lr", {k: v for k, v in LR.items() if k != "max_trial_counts"}, "max_trial_counts is missing"),
    ("knn", {**KNN, "n_neighbors_min": 2}, "n_neighbors must stay odd"),
    ("knn", {**KNN, "n_neighbors_max": 6}, "n_neighbors must stay odd"),
    ("knn", {**KNN, "n_neighbors_step": 1}, "n_neighbors must stay odd"),
    ("xgboost", {**XGB, "learning_rate_step": "small"}, "learning_rate must be double"),
    ("xgboost", {**XGB, "n_estimators_min": "1.0"}, "n_estimators must be int"),
])
def test_checks(spark, method, given, reason):
    row = search.space_problems(space_of(spark, **{method: given})).first()
    assert row.reason == reason
    if reason:
        with pytest.raises(ValueError, match=reason.split()[0]):
            search.sound_space(space_of(spark, **{method: given}))


def test_seed_default(spark):
    rows = search.space_problems(space_of(spark, lr=LR, knn={**KNN, "random_state": 7})).collect()
    assert {r.method: r.seed for r in rows} == {"lr": 42, "knn": 7}


def test_grid(spark):
    grid = search.trial_grid(search.sound_space(space_of(spark, lr=LR, knn=KNN, xgboost=XGB))).collect()
    assert sorted(r.it for r in grid if r.method == "lr") == [10, 20, 30]
    assert sorted(r.nn for r in grid if r.method == "knn") == [1, 3, 5]
    assert sorted((r.lr, r.ne) for r in grid if r.method == "xgboost") == [
        (a, b) for a in (0.1, 0.2, 0.3) for b in (10, 15, 20)]
    assert len({r.trial for r in grid}) == len(grid)


def test_reversed_bounds_give_no_trials(spark):
    space = search.sound_space(space_of(spark, lr={**LR, "iterators_min": 50}))
    assert search.trial_grid(space).count() == 0


def test_draw_is_bounded_repeatable_and_from_the_grid(spark):
    space = search.sound_space(space_of(spark, xgboost=XGB, lr=LR, knn={**KNN, "random_state": 5}))
    columns = ["method", "trial", "lr", "ne", "nn", "it"]
    one = sorted(map(str, search.draw_trials(space).select(columns).collect()))
    assert one == sorted(map(str, search.draw_trials(space.repartition(5)).select(columns).collect()))
    per_method = Counter(r.method for r in search.draw_trials(space).collect())
    assert per_method == {"xgboost": 4, "lr": 3, "knn": 3}
    grid = {(r.method, r.lr, r.ne, r.nn, r.it) for r in search.trial_grid(space).collect()}
    drawn = [(r.method, r.lr, r.ne, r.nn, r.it) for r in search.draw_trials(space).collect()]
    assert len(set(drawn)) == len(drawn) and set(drawn) <= grid


@pytest.mark.parametrize("total", [1, 2, 3, 5, 12, 97, 1000, 4099])
def test_draws_are_a_permutation(spark, total):
    space = search.sound_space(space_of(spark, lr={**LR, "iterators_min": 1, "iterators_max": total, "iterators_step": 1,
                                                   "max_trial_counts": total + 10, "random_state": total}))
    rows = search.draw_trials(space).collect()
    assert sorted(r.it for r in rows) == list(range(1, total + 1))
    assert sorted(r.draw for r in rows) == list(range(1, total + 1))
    if total >= 97:
        assert [r.it for r in sorted(rows, key=lambda r: r.draw)] != list(range(1, total + 1))


def test_a_space_of_10_to_the_12(spark):
    huge = {**XGB, "learning_rate_min": 0.000001, "learning_rate_max": 1.0, "learning_rate_step": 0.000001,
            "n_estimators_min": 1, "n_estimators_max": 1_000_000, "n_estimators_step": 1, "max_trial_counts": 200}
    rows = search.draw_trials(search.sound_space(space_of(spark, xgboost=huge))).collect()
    assert len({r.trial for r in rows}) == 200 == len({(r.lr, r.ne) for r in rows})
    assert max(int(r.trial) for r in rows) > 9 * 10 ** 11 and min(int(r.trial) for r in rows) < 10 ** 11


def test_reversed_bounds_give_no_draws(spark):
    space = search.sound_space(space_of(spark, lr={**LR, "iterators_min": 50}))
    assert search.draw_trials(space).collect() == []


def test_best_trial_takes_the_first_of_equals(spark, rows_of):
    trials = spark.createDataFrame(
        [("lr", 3, 0.9), ("lr", 1, 0.9), ("lr", 2, 0.1), ("knn", 5, None), ("knn", 6, 0.2)],
        "method string, trial int, accuracy double")
    assert rows_of(search.best_trial(trials)) == [("knn", 6, 0.2), ("lr", 1, 0.9)]


def _trials(n):
    return [{"trial": str(i), "i": i} for i in range(n)]


def test_search_stops_at_the_goal(spark):
    done = search.run_trials(spark, _trials(10), lambda p: 1.0 if p["i"] == 3 else 0.1)
    assert [r.trial for r in done] == ["0", "1", "2", "3"]


def test_search_allows_some_failures(spark):
    def objective(p):
        if p["i"] == 1:
            raise ArithmeticError("no fit")
        return 0.5
    done = search.run_trials(spark, _trials(4), objective, max_failed=1)
    assert [r.error for r in done] == [None, "no fit", None, None]
    with pytest.raises(RuntimeError, match="no fit"):
        search.run_trials(spark, _trials(4), objective, max_failed=0)


def test_search_runs_in_parallel(spark):
    together = threading.Barrier(3, timeout=20)

    def objective(p):
        together.wait()
        return 0.1
    assert len(search.run_trials(spark, _trials(6), objective, parallel=3)) == 6


def test_search_finds_a_planted_optimum(spark):
    grid = search.sound_space(space_of(spark, xgboost={**XGB, "max_trial_counts": 9}))
    trials = [r.asDict() for r in search.draw_trials(grid).collect()]
    done = search.run_trials(spark, trials, lambda p: 0.9 - abs(p["lr"] - 0.2) - abs(p["ne"] - 15) / 100)
    from cohortline.operators.search import trials_table
    best = search.best_trial(trials_table(spark, {"xgboost": done}), params=("lr", "ne")).first()
    assert (best.lr, best.ne) == (0.2, 15)


def test_the_goal_cancels_slow_trials(spark):
    """Trial 1 would take minutes; it is cancelled, between jobs or inside one, once trial 0 is at the goal."""
    begun = threading.Event()

    def slow(x):
        import time as clock
        clock.sleep(120)
        return x

    def objective(p):
        if p["i"]:
            begun.set()
            spark.range(2).rdd.map(slow).count()
            return 0.2
        begun.wait(20)
        time.sleep(1)
        return 0.995
    start = time.monotonic()
    done = search.run_trials(spark, _trials(5), objective, parallel=2)
    assert [(r.trial, r.accuracy) for r in done] == [("0", 0.995)]
    assert time.monotonic() - start < 60
    assert spark.range(10).count() == 10


def test_the_next_trial_starts_as_soon_as_one_ends(spark):
    """One slow trial beside four quick ones: nothing waits for it."""
    ended = []

    def objective(p):
        if p["i"] == 0:
            while len(ended) < 4:
                time.sleep(0.05)
            return 0.1
        ended.append(p["i"])
        return 0.1
    assert len(search.run_trials(spark, _trials(5), objective, parallel=2)) == 5


def test_too_many_failures_cancel_the_rest(spark):
    def objective(p):
        if p["i"] == 0:
            raise ArithmeticError("no fit")
        spark.range(1).rdd.map(lambda x: __import__("time").sleep(120)).count()
        return 0.5
    start = time.monotonic()
    with pytest.raises(RuntimeError, match="no fit"):
        search.run_trials(spark, _trials(3), objective, parallel=2)
    assert time.monotonic() - start < 60


def test_numbers_inside_the_space_take_one_pass_of_the_permutation(spark, monkeypatch):
    """A square space has no number outside, so its draws need none of the later passes."""
    monkeypatch.setattr(search, "_AGAIN", ())
    rows = spark.range(144).selectExpr("id AS i", "7L AS seed", "144L AS total")
    found = [r.out for r in search._permuted(rows, "i", "seed", "total", "out").collect()]
    assert sorted(found) == list(range(144)) and found != sorted(found)


def test_later_passes_bring_every_number_inside(spark):
    rows = spark.createDataFrame([(i, 5, t) for t in (1, 2, 3, 5, 7, 11, 13, 35) for i in range(t)], "i long, seed long, total long")
    found = search._permuted(rows, "i", "seed", "total", "out").groupBy("total").agg(
        F.count_distinct("out").alias("n"), F.min("out").alias("least"), F.max("out").alias("most")).collect()
    assert all((r.n, r.least, r.most) == (r.total, 0, r.total - 1) for r in found) and len(found) == 8


def _copied_rows(spark):
    """Rows that share few points, with labels at odds on many of them."""
    x, noise = F.pmod(F.xxhash64("id"), F.lit(7)), F.pmod(F.xxhash64(F.lit("n"), "id"), F.lit(4))
    rows = spark.range(3000).select(
        F.concat(F.lit("k"), "id").alias("key"), x.cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        F.when(noise == 0, (x <= 3)).otherwise(x > 3).cast("int").alias("y"))
    return with_split(rows, ["key"], {"train": 7, "test": 3})


def test_trials_share_the_passes_over_rows_and_equal_fits_of_their_own(spark, monkeypatch):
    calls = Counter()
    for module, name in ((pure_forest, "_points"), (boosting, "cells_of")):
        def counted(*given, f=getattr(module, name), name=name, **more):
            calls[name] += 1
            return f(*given, **more)
        monkeypatch.setattr(module, name, counted)
    df = _copied_rows(spark).persist()
    counts = {"max_trial_counts": 3, "max_failed_trial_counts": 0, "parallel_trial_counts": 2}
    run = tuned_run(df, space_of(
        spark, lr=LR | counts, knn=KNN | counts, xgboost=XGB | counts | dict(n_estimators_max=10),
        random_forest=dict(n_estimators_min=1, n_estimators_max=5, n_estimators_step=2, **counts)), "y", "key", "t", goal=1.1)
    assert calls == {"_points": 1, "cells_of": 1}
    train, test = (df.filter(F.col("split") == name) for name in ("train", "test"))
    trials = run.trials.collect()
    assert Counter(t.method for t in trials) == dict.fromkeys(search.METHODS, 3)
    for t in trials:
        if t.method == "lr":
            model = classifiers.fit(classifiers.logistic(train.count(), t.it), train, ["a", "b"], "y")
        elif t.method == "knn":
            model = nearest.fit_nearest(train, ["a", "b"], "key", "y", t.nn)
        elif t.method == "xgboost":
            model = boosting.fit_boosted(train, ["a", "b"], "y", boosting.Boosting(t.ne, t.lr, 6))
        else:
            model = pure_forest.fit_forest(train, ["a", "b"], "y", "key", t.ne)
        assert t.accuracy == evaluate(model, test, "y")


def test_a_fit_on_kinds_equals_one_on_rows(spark):
    rows = _copied_rows(spark)
    kinds = rows.groupBy("a", "b", "y").agg(F.count("*").alias("n"))
    one, two = (classifiers.fit(classifiers.logistic(3000, copies=copies), df, ["a", "b"], "y").stages[-1]
                for df, copies in ((rows, None), (kinds, "n")))
    assert one.coefficients.toArray() == pytest.approx(two.coefficients.toArray(), abs=1e-4)
    assert one.intercept == pytest.approx(two.intercept, abs=1e-4)


def test_the_method_whose_rows_cannot_be_used_fails_alone(spark):
    """Making a shared table fails in each trial that asks for it, as its own fit would."""
    df = _copied_rows(spark).withColumn("a", F.when(F.col("a") > 0, F.col("a")))
    counts = {"max_trial_counts": 2, "max_failed_trial_counts": 2, "parallel_trial_counts": 2}
    run = tuned_run(df, space_of(
        spark, xgboost=XGB | counts, random_forest=dict(n_estimators_min=1, n_estimators_max=3, n_estimators_step=2, **counts)),
        "y", "key", "t", goal=1.1)
    assert Counter((t.method, t.accuracy is None) for t in run.trials.collect()) == {
        ("random_forest", True): 2, ("xgboost", False): 2}
