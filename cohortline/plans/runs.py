"""Ready-made runs from CSV files to a chosen model.

Each run reads, cleans by specification, splits by row key, fits, and ranks.
A table without a key gets one from its row content, so copies stay together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortline.functions.keys import row_key
from cohortline.operators.search import read_search_space
from cohortline.operators.split import TRAIN_TEST, TRAIN_VAL_TEST, with_split
from cohortline.plans.cleaning import clean, clean_stroke
from cohortline.plans.comparison import LR, RF, XGB, Comparison, Settings, compare_models
from cohortline.plans.specs import DIABETES, DIABETES_ALIASES, HEART, HYPERTENSION
from cohortline.plans.tuned import TunedRun, tuned_run
from cohortline.sources.csv_files import read_csv, read_csv_folder, read_csv_sources

KEY = "row_key"

# Boosting parameters of the boosted-only run.
SLOW_BOOSTING = Settings(boost_rounds=1000, boost_step=0.01, boost_depth=6, class_weight="none")


def keyed(df: DataFrame, key: str = KEY, columns: Sequence[str] | None = None) -> DataFrame:
    """Add a key made from ``columns``: by default all but the name of the source.

    A row that two files share has one key, so both copies land in one split.
    """
    return df.withColumn(key, row_key(columns or [c for c in df.columns if c != "source"]))


def load_diabetes(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Several diabetes files (name to path) with differing headers."""
    return clean(
        keyed(read_csv_sources(spark, paths, DIABETES_ALIASES), columns=DIABETES.keep), DIABETES, [KEY])


def load_diabetes_folder(spark: SparkSession, pattern: str) -> DataFrame:
    """All diabetes files behind a glob."""
    return clean(
        keyed(read_csv_folder(spark, pattern, DIABETES_ALIASES), columns=DIABETES.keep), DIABETES, [KEY])


def load_heart(spark: SparkSession, path: str) -> DataFrame:
    return clean(keyed(read_csv(spark, path)), HEART, [KEY])


def load_hypertension(spark: SparkSession, path: str) -> DataFrame:
    return clean(keyed(read_csv(spark, path)), HYPERTENSION, [KEY])


def load_stroke(spark: SparkSession, raw_path: str, coded_path: str,
                denied: DataFrame | None = None) -> DataFrame:
    """The raw and the coded stroke file; ``denied`` lists row keys of known bad rows."""
    raw = keyed(read_csv(spark, raw_path))
    coded = keyed(read_csv(spark, coded_path))
    return clean_stroke(raw, coded, [KEY], denied).drop("source")


def _run(df: DataFrame, label: str, run_id: str, folder: str | None, settings: Settings) -> Comparison:
    return compare_models(with_split(df, [KEY], TRAIN_VAL_TEST), label, KEY, run_id, folder, settings)


def run_diabetes(spark: SparkSession, paths: Mapping[str, str], run_id: str,
                 folder: str | None = None, settings: Settings = Settings()) -> Comparison:
    return _run(load_diabetes(spark, paths), DIABETES.label, run_id, folder, settings)


def run_heart(spark: SparkSession, path: str, run_id: str,
              folder: str | None = None, settings: Settings = Settings()) -> Comparison:
    return _run(load_heart(spark, path), HEART.label, run_id, folder, settings)


def run_hypertension(spark: SparkSession, path: str, run_id: str,
                     folder: str | None = None, settings: Settings = Settings()) -> Comparison:
    return _run(load_hypertension(spark, path), HYPERTENSION.label, run_id, folder, settings)


def run_stroke(spark: SparkSession, raw_path: str, coded_path: str, run_id: str,
               denied: DataFrame | None = None, folder: str | None = None,
               settings: Settings = Settings()) -> Comparison:
    return _run(load_stroke(spark, raw_path, coded_path, denied), "stroke", run_id, folder, settings)


def _single(df: DataFrame, model: str, run_id: str, folder: str | None, settings: Settings) -> Comparison:
    return compare_models(
        with_split(df, [KEY], TRAIN_TEST), DIABETES.label, KEY, run_id, folder, settings,
        models=[model], score_on=["test"])


def run_diabetes_logistic(spark: SparkSession, paths: Mapping[str, str], run_id: str,
                          folder: str | None = None, settings: Settings = Settings()) -> Comparison:
    """Logistic regression only, 80/20."""
    return _single(load_diabetes(spark, paths), LR, run_id, folder, settings)


def run_diabetes_boosted(spark: SparkSession, paths: Mapping[str, str], run_id: str,
                         folder: str | None = None, settings: Settings = SLOW_BOOSTING) -> Comparison:
    """Boosted trees only, 80/20, small steps, no early stop."""
    return _single(load_diabetes(spark, paths), XGB, run_id, folder, settings)


def run_diabetes_forest(spark: SparkSession, pattern: str, run_id: str, folder: str | None = None,
                        settings: Settings = Settings(forest_trees=20, forest_depth=5)) -> Comparison:
    """Random forest only, from a folder of files, 80/20."""
    return _single(load_diabetes_folder(spark, pattern), RF, run_id, folder, settings)


def run_tuned(spark: SparkSession, splits_path: str, params_path: str, label: str, key: str,
              run_id: str, store: str | None = None, task: str | None = None,
              not_features: Sequence[str] = ()) -> TunedRun:
    """Search, fit, choose and promote from a stored split table and a parameter file."""
    df = spark.read.parquet(splits_path).drop(*not_features)
    return tuned_run(df, read_search_space(spark, params_path), label, key, run_id, store, task)
