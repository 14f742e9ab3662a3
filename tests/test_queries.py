"""Every query with SQL against DuckDB; the fits by what they must return."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_file

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, SQL = entry_file.queries(), entry_file.oracle_sql()
FITS = sorted(set(QUERIES) - set(SQL))


# Deep trees find the planted rule only among more rows than the smallest tables have.
MORE_ROWS = dict.fromkeys(["rf_predict", "gbt_slow_predict"], os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01"))


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    folder = MORE_ROWS.get(name, FOLDER)
    df = QUERIES[name](spark, folder)
    result = duck(folder).execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    theirs = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in result.fetchall())
    assert ours == theirs
    assert ours


@pytest.mark.parametrize("name", [n for n in FITS if n.endswith("_predict") or n == "lr_probability"])
def test_predictions_are_total_and_beat_the_majority(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    labels = [r.dear for r in rows]
    majority = max(labels.count(0), labels.count(1)) / len(labels)
    hits = sum(r.dear == r.prediction for r in rows) / len(rows)
    assert rows and hits >= majority
    assert {r.prediction for r in rows} <= {0.0, 1.0}


def test_leaderboard_has_every_model(spark):
    rows = QUERIES["hypertension_leaderboard"](spark, FOLDER).collect()
    assert {(r.model, r.split) for r in rows} == {
        (m, s) for m in ("LogisticRegression", "XGBoost", "RandomForest", "KNN") for s in ("val", "test")}
    assert all(0 <= r.accuracy <= 1 for r in rows)


def test_entry(spark):
    rows = entry_file.entry(spark).collect()
    assert {r.split for r in rows} == {"train", "val", "test"}


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
