"""The approximate index: recall against exact neighbours, exact distances, odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.operators import nearest_quantised as q
from cohortline.operators.nearest import fit_nearest
from workload import neighbours


def recall(model, train, points, features, key="key"):
    exact = fit_nearest(train, features, key, "label", k=model.k).neighbours(points)
    true, found = ({(tuple(r.point), r.key) for r in df.collect()} for df in (exact, model.neighbours(points)))
    assert len(found) == len(true)
    return len(true & found) / len(true)


def test_recall_on_the_given_embeddings(spark):
    """Unit vectors without any structure, the hardest kind: at least nine tenths of the true neighbours."""
    train, test = neighbours._embedded(spark, "/root/testdata/sf0.1")
    model = q.fit_quantised(train, "embedding", "key", "label", k=3)
    points = test.select(F.col("embedding").cast("array<double>").alias("point"))
    assert recall(model, train, points, "embedding") >= 0.9


@pytest.mark.parametrize("cell_rows", [100, 4096])
def test_recall_with_many_cells_and_small_units(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(q, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(q, "BLOCK", 64)
    monkeypatch.setattr(q, "CHUNK", 16)
    train, test = neighbours._orders(spark, "/root/testdata/sf0.01")
    model = q.fit_quantised(train, ["a", "b", "c"], "key", "label", k=3)
    points = test.select(F.array("a", "b", "c").alias("point"))
    assert recall(model, train, points, ["a", "b", "c"]) >= 0.9


def test_copies_ties_and_few_rows(spark):
    rows = [(i, [1.0, 2.0], i % 2) for i in range(500)] + [(900, [5.0, 5.0], 1)]
    train = spark.createDataFrame(rows, "key long, e array<double>, label long")
    model = q.fit_quantised(train, "e", "key", "label", k=3)
    found = model.neighbours(spark.createDataFrame([([1.0, 2.0],), ([5.0, 5.0],)], "point array<double>")).collect()
    assert sorted((r.point[0], r.rank, r.key) for r in found) == [
        (1.0, 1, 0), (1.0, 2, 1), (1.0, 3, 2), (5.0, 1, 900), (5.0, 2, 0), (5.0, 3, 1)]
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [9.0, 9.0])], "id long, e array<double>")
    assert {(r.id, r.prediction) for r in model.predict(asked).collect()} == {(1, 0), (2, 0), (3, 1)}
    assert model.predict(asked).count() == 3 and model.predict(asked.limit(0)).collect() == []
    with pytest.raises(ValueError):
        q.fit_quantised(train.limit(0), "e", "key", "label")


def test_codes_bring_points_back_nearly():
    x = np.random.default_rng(1).normal(size=(3000, 32))
    index = q._Index.of(x, 8, 16, 3)
    cell, codes = index.encode(x)
    back = np.concatenate([index.decode(c, codes[[i]]) for i, c in enumerate(cell)])
    assert ((x - back) ** 2).sum() < 0.2 * (x ** 2).sum() and codes.shape == (3000, 16)
