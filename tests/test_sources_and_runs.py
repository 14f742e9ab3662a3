import csv
import json
import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cohortline.operators import search
from cohortline.operators.split import TRAIN_TEST, with_split
from cohortline.plans import runs
from cohortline.plans.comparison import Settings
from cohortline.plans.specs import AGE_BANDS
from cohortline.sources import metrics as metric_files
from cohortline.sources.csv_files import folder_headers, read_csv, read_csv_folder
from cohortline.sources.models import promote, read_record, stored_model
from cohortline.sources.tables import copy_splits, read_split, write_splits, write_table

QUICK = Settings(lr_iterations=50, boost_rounds=4, forest_trees=3, forest_depth=4)


def _write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


DIABETES_1 = (["gender", "age", "bmi", "HbA1c_level", "blood_glucose_level", "diabetes", "extra"], [
    ["Female", "50", "25.5", "6.1", "140", "0", "x"],
    ["Male", "No Info", "31", "7.0", "200", "1", "x"],
    ["Other", "99", "99", "99", "99", "1", "x"],
    ["Male", "40", "", "5.5", "100", "0", "x"],
    ["Female", "60", "20", "5.0", "90", "No Info", "x"],
    ["Male", "", "", "", "80", "0", "x"],
])
DIABETES_2 = (["Diabetes", "glucose", "hba1c", "BMI", "AGE", "Sex"], [
    ["1", "210", "8.0", "33", "70", "Male"],
    ["0", "95", "5.1", "N/A", "20", "Female"],
])


def test_diabetes_files_with_differing_headers(spark, tmp_path):
    paths = {"one": _write(tmp_path / "a" / "1.csv", *DIABETES_1),
             "two": _write(tmp_path / "a" / "2.csv", *DIABETES_2)}
    got = runs.load_diabetes(spark, paths)
    assert got.columns == ["row_key", "gender", "age", "bmi", "HbA1c_level",
                           "blood_glucose_level", "diabetes"]
    rows = sorted((r.gender, round(r.age, 4), round(r.bmi, 4), r.HbA1c_level, r.blood_glucose_level,
                   r.diabetes) for r in got.collect())
    age, bmi = (50 + 40 + 70 + 20) / 4, (25.5 + 31 + 33) / 3
    assert rows == sorted([
        (1, 50.0, 25.5, 6.1, 140.0, 0), (0, age, 31.0, 7.0, 200.0, 1),
        (0, 40.0, round(bmi, 4), 5.5, 100.0, 0), (0, 70.0, 33.0, 8.0, 210.0, 1),
        (1, 20.0, round(bmi, 4), 5.1, 95.0, 0)])
    folder = runs.load_diabetes_folder(spark, str(tmp_path / "a" / "*.csv"))
    assert sorted(r[1:] for r in folder.collect()) == sorted(r[1:] for r in got.collect())


def test_header_cells_that_differ_in_case(spark, tmp_path):
    path = _write(tmp_path / "c.csv", ["Age", "age", "y"], [["1", "2", "0"]])
    assert read_csv(spark, path, {"age": ("age", "Age")}).select("age").first()[0] == "2"


def test_folder_reads_one_plan_per_header(spark, tmp_path):
    for i in range(4):
        _write(tmp_path / "f" / f"{i}.csv", ["a", "b"] if i % 2 else ["b", "a"], [[f"{i}", "z"]])
    df = read_csv_folder(spark, str(tmp_path / "f" / "*.csv"), {})
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "z"), ("3", "z"), ("z", "0"), ("z", "2")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_headers_of_many_files_come_from_one_job(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / f"n{n}"
        for i in range(n):
            rows = [[str(i), f"x{j}" * 20] for j in range(300)]
            _write(folder / f"{i}.csv", ['a', 'say "b", c'] if i % 2 else ['say "b", c', 'a'], rows)
        group = f"headers-{n}"
        spark.sparkContext.setJobGroup(group, "headers")
        found = folder_headers(spark, str(folder / "*.csv"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {h: len(f) for h, f in found.items()} == {("a", 'say "b", c'): n // 2, ('say "b", c', "a"): n - n // 2}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert jobs(40) == jobs(90)  # Spark lists more than 32 paths in a job of its own
    (tmp_path / "n40" / "99.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        folder_headers(spark, str(tmp_path / "n40" / "*.csv"))


HEART_HEADER = ["HeartDisease", "BMI", "Smoking", "AlcoholDrinking", "Stroke", "PhysicalHealth",
                "MentalHealth", "DiffWalking", "Sex", "AgeCategory", "Race", "Diabetic",
                "PhysicalActivity", "GenHealth", "SleepTime", "Asthma", "KidneyDisease", "SkinCancer"]


def _heart_rows(n, rng):
    yes = lambda p: "Yes" if rng.random() < p else "No"
    for _ in range(n):
        band = rng.randrange(17)
        sick = "Yes" if band > 10 and rng.random() < 0.9 else "No"
        yield [sick, f"{rng.uniform(18, 40):.2f}", yes(.4), yes(.1), yes(.1), "3", "0", yes(.2),
               rng.choice(["Male", "Female"]), AGE_BANDS[band], "White",
               rng.choice(["Yes", "No", "No, borderline diabetes", "Yes (during pregnancy)"]),
               yes(.7), "Good", str(rng.randrange(4, 10)), yes(.1), yes(.1), yes(.1)]


def test_heart_run(spark, tmp_path):
    path = _write(tmp_path / "heart.csv", HEART_HEADER, _heart_rows(400, random.Random(1)))
    df = runs.load_heart(spark, path)
    assert df.columns[:3] == ["row_key", "Sex", "AgeCategory"]
    assert not set(df.columns) & {"PhysicalHealth", "MentalHealth", "Race", "GenHealth"}
    assert df.filter("Diabetic NOT IN (0, 1) OR AgeCategory NOT BETWEEN 0 AND 16").count() == 0
    assert dict(df.dtypes)["BMI"] == "double"
    run = runs.run_heart(spark, path, "h1", settings=QUICK)
    assert run.accuracy > 0.8


def test_hypertension_rows(spark, tmp_path):
    header = ["age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalach", "exang",
              "oldpeak", "slope", "ca", "thal", "target"]
    good = ["57", "1", "3", "145", "233", "1", "0", "150", "0", "2.3", "0", "0", "1", "1"]
    bad = [good[:i] + [v] + good[i + 1:] for i, v in
           ((1, "N/A"), (1, ""), (6, "2"), (13, "N/A"), (11, ""))]
    kept = good[:12] + ["", "0"]  # thal is not looked at
    path = _write(tmp_path / "h.csv", header, [good, *bad, kept])
    df = runs.load_hypertension(spark, path)
    assert sorted((r.age, r.restecg, r.target) for r in df.collect()) == [(57.0, 0.0, 0), (57.0, 0.0, 1)]
    assert "cp" not in df.columns and "thal" not in df.columns


def test_stroke_tables_and_deny_list(spark, tmp_path):
    raw = _write(tmp_path / "s1.csv", [
        "id", "gender", "age", "hypertension", "heart_disease", "ever_married", "work_type",
        "Residence_type", "avg_glucose_level", "bmi", "smoking_status", "stroke"], [
        ["1", "Male", "67", "0", "1", "Yes", "Private", "Urban", "228.69", "36.6", "smokes", "1"],
        ["2", "Female", "61", "0", "0", "Yes", "Private", "Rural", "202.21", "N/A", "Unknown", "1"],
        ["3", "Other", "26", "0", "0", "No", "Private", "Rural", "143.33", "22.4", "Unknown", "0"]])
    coded = _write(tmp_path / "s2.csv", [
        "sex", "age", "hypertension", "heart_disease", "ever_married", "work_type",
        "Residence_type", "avg_glucose_level", "bmi", "smoking_status", "stroke"], [
        ["1", "63", "0", "1", "1", "4", "1", "228.69", "36.6", "1", "1"],
        ["0", "42", "0", "1", "1", "4", "0", "105.92", "32.5", "0", "0"]])
    df = runs.load_stroke(spark, raw, coded)
    assert sorted((r.age, r.gender) for r in df.collect()) == [
        (26.0, None), (42.0, 0.0), (63.0, 1.0), (67.0, 0.0)]
    denied = df.filter("age = 42").select("row_key")
    left = runs.load_stroke(spark, raw, coded, denied)
    assert sorted(r.age for r in left.collect()) == [26.0, 63.0, 67.0]


def test_single_model_runs(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        sugar = rng.uniform(80, 250)
        rows.append([rng.choice(["Male", "Female"]), str(rng.randrange(20, 80)), f"{rng.uniform(18, 40):.1f}",
                     f"{rng.uniform(4, 9):.1f}", f"{sugar:.0f}", str(int(sugar > 160))])
    paths = {"a": _write(tmp_path / "d" / "a.csv", DIABETES_1[0][:6], rows)}
    one = runs.run_diabetes_logistic(spark, paths, "l1", settings=QUICK)
    two = runs.run_diabetes_boosted(
        spark, paths, "b1", settings=Settings(boost_rounds=3, boost_step=0.01, class_weight="none"))
    three = runs.run_diabetes_forest(spark, str(tmp_path / "d" / "*.csv"), "f1", settings=QUICK)
    assert (one.best, two.best, three.best) == ("LogisticRegression", "XGBoost", "RandomForest")
    assert min(one.accuracy, two.accuracy, three.accuracy) > 0.9


def test_tables_and_splits(spark, tmp_path):
    df = with_split(spark.range(200).withColumn("y", F.col("id") % 2), ["id"])
    write_splits(df, str(tmp_path / "s"))
    copy_splits(spark, str(tmp_path / "s"), str(tmp_path / "t"))
    test = read_split(spark, str(tmp_path / "t"), "test")
    assert sorted(r.id for r in test.collect()) == sorted(
        r.id for r in df.filter("split = 'test'").collect())
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    write_table(df, str(tmp_path / "c"), fmt="csv")
    assert read_csv(spark, str(tmp_path / "c")).columns == ["id", "y", "split"]
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "x"), fmt="xls")


def test_metrics_are_appended(spark, tmp_path):
    path = str(tmp_path / "m")
    for run in ("r1", "r2"):
        metric_files.append_metrics(metric_files.metrics_rows(
            spark, [(run, "KNN", "test", 0.5, None)]), path)
    assert metric_files.read_metrics(spark, path).count() == 2
    metric_files.write_accuracy(spark, str(tmp_path / "a"), 0.25)
    assert read_csv(spark, str(tmp_path / "a")).first().accuracy == "0.25"


class _Model:
    """Stands for a fitted model: only its saving is needed here."""

    def __init__(self, spark):
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import VectorAssembler
        df = spark.range(3)
        self.fitted = Pipeline(stages=[VectorAssembler(inputCols=["id"], outputCol="f")]).fit(df)


def test_promote(spark, tmp_path):
    store, model = str(tmp_path / "store"), _Model(spark).fitted
    assert read_record(spark, store, "t") is None
    with pytest.raises(LookupError):
        stored_model(spark, store, "t")
    assert promote(spark, store, "t", "KNN", 0.5, model) == "save_new"
    assert promote(spark, store, "t", "KNN", 0.5, model) == "retain"
    assert promote(spark, store, "t", "XGBoost", 0.6, model) == "replace"
    assert read_record(spark, store, "t").accuracy_text == "0.6"
    assert stored_model(spark, store, "t").stages
    (tmp_path / "store" / "t" / "records" / "number=000000003").mkdir()  # a job lost half-way
    assert read_record(spark, store, "t").accuracy_text == "0.6"
    assert promote(spark, store, "t", "KNN", 0.2, model) == "retain"
    broken = tmp_path / "store" / "t" / "records" / "number=000000002"
    for part in broken.glob("*.json"):
        part.write_text("{not json")
        (broken / f".{part.name}.crc").unlink(missing_ok=True)
    assert promote(spark, store, "t", "KNN", 0.1, model) == "replace"
    assert read_record(spark, store, "t").accuracy_text == "0.1"


def test_of_two_writers_at_once_the_better_stands(spark, tmp_path, monkeypatch):
    """Both read the store before either writes; the second to write must decide again."""
    from cohortline.sources import models
    model = _Model(spark).fitted
    for n, scores in enumerate([(0.7, 0.9), (0.9, 0.7), (0.8, 0.8)]):
        store = str(tmp_path / f"store{n}")
        assert promote(spark, store, "t", "KNN", 0.5, model) == "save_new"
        both, seen = threading.Barrier(2, timeout=60), threading.local()

        def together(session, path, text, real=models._create):
            if not getattr(seen, "met", False):
                seen.met = True
                both.wait()
            return real(session, path, text)
        monkeypatch.setattr(models, "_create", together)
        with ThreadPoolExecutor(2) as pool:
            jobs = [pool.submit(promote, spark, store, "t", f"m{s}", s, model) for s in scores]
            actions = [j.result() for j in jobs]
        monkeypatch.undo()
        assert read_record(spark, store, "t").accuracy_text == repr(max(scores))
        assert "replace" in actions and (scores[0] != scores[1] or "retain" in actions)
        numbers = models._numbers(spark, f"{store}/t/records")
        assert numbers == list(range(1, len(numbers) + 1))


COUNTS = {"max_trial_counts": 3, "max_failed_trial_counts": 0, "parallel_trial_counts": 2}
PARAMS = [
    {"method": "lr", "iterators_min": 10, "iterators_max": 50, "iterators_step": 10, **COUNTS},
    {"method": "random_forest", "n_estimators_min": 1, "n_estimators_max": 5, "n_estimators_step": 2,
     "random_state": 7, **COUNTS},
    {"method": "knn", "n_neighbors_min": 1, "n_neighbors_max": 5, "n_neighbors_step": 2, **COUNTS},
    {"method": "xgboost", "learning_rate_min": 0.1, "learning_rate_max": 0.3,
     "learning_rate_step": 0.1, "n_estimators_min": 2, "n_estimators_max": 4,
     "n_estimators_step": 2, "docker_image_name": "ignored", **{**COUNTS, "max_trial_counts": 1}},
    {"method": "svm", "anything": 1},
]


def test_parameter_file_and_tuned_run(spark, tmp_path):
    params = tmp_path / "params.json"
    params.write_text(json.dumps(PARAMS, indent=2))
    space = search.read_search_space(spark, str(params))
    assert sorted(r.method for r in space.collect()) == ["knn", "lr", "random_forest", "xgboost"]
    rng = random.Random(2)
    rows = []
    for i in range(400):
        a, b = rng.uniform(-1, 1), rng.uniform(-1, 1)
        rows.append((i, a, b, int(a + 0.2 * b + rng.gauss(0, 0.1) > 0)))
    df = with_split(spark.createDataFrame(rows, "id long, a double, b double, y int"), ["id"], TRAIN_TEST)
    write_splits(df, str(tmp_path / "splits"))
    run = runs.run_tuned(spark, str(tmp_path / "splits"), str(params), "y", "id", "t1",
                         str(tmp_path / "store"), "heart")
    assert run.action == "save_new" and run.accuracy > 0.85
    assert run.best_trials.count() == 4
    per_method = {r["method"]: r["count"] for r in run.trials.groupBy("method").count().collect()}
    assert per_method["xgboost"] == 1 and all(1 <= n <= 3 for n in per_method.values())
    top = {r.method: r.top for r in run.trials.groupBy("method").agg(F.max("accuracy").alias("top")).collect()}
    assert {r.method: r.accuracy for r in run.best_trials.collect()} == top
    assert stored_model(spark, str(tmp_path / "store"), "heart") is not None


def test_quotes_and_extra_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n"he said ""hi"", ok",1\nplain\n')
    rows = [tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert rows == [('he said "hi", ok', "1"), ("plain", None)]
    (tmp_path / "b.csv").write_text("x,y\n1,2,3\n")
    with pytest.raises(Exception, match="more cells"):
        read_csv(spark, str(tmp_path / "b.csv")).collect()
    (tmp_path / "c.csv").write_text('x,y\n"two\nlines",1\n')
    assert read_csv(spark, str(tmp_path / "c.csv"), multi_line=True).first().x == "two\nlines"


def test_a_row_in_two_files_has_one_key(spark):
    from cohortline.plans.runs import keyed
    rows = spark.createDataFrame([("1", "m", "a"), ("1", "m", "b")], "age string, sex string, source string")
    assert keyed(rows).select("row_key").distinct().count() == 1


def test_infinite_text_is_no_number(spark):
    from cohortline.functions.markers import to_number
    df = spark.createDataFrame([("Infinity",), ("NAN",), ("1.5",)], "x string")
    assert [r[0] for r in df.select(to_number("x")).collect()] == [None, None, 1.5]
