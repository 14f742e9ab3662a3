import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortline.operators.order import seeded_shuffle
from cohortline.operators.split import TRAIN_TEST, with_split


def test_split_is_complete_and_independent_of_partitions(spark):
    df = spark.range(20_000)
    one = {r.id: r.split for r in with_split(df.repartition(1), ["id"]).collect()}
    many = {r.id: r.split for r in with_split(df.repartition(16), ["id"]).collect()}
    assert one == many and len(one) == 20_000
    shares = Counter(one.values())
    assert abs(shares["train"] / 20_000 - 0.8) < 0.01
    assert abs(shares["val"] / 20_000 - 0.1) < 0.01
    assert set(shares) == {"train", "val", "test"}


def test_split_shares_and_salt(spark):
    df = spark.range(5_000)
    a = {r.id: r.split for r in with_split(df, ["id"], TRAIN_TEST).collect()}
    b = {r.id: r.split for r in with_split(df, ["id"], TRAIN_TEST, salt=7).collect()}
    assert set(a.values()) == {"train", "test"} and a != b
    with pytest.raises(ValueError):
        with_split(df, ["id"], {"train": 0})


def test_split_does_not_shuffle(spark):
    plan = with_split(spark.range(10), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("rows", [20, 1_000_000])
def test_shuffle_numbers_every_row_once(spark, rows):
    df = spark.range(1_000).withColumn("v", F.col("id") % 7)
    out = seeded_shuffle(df, ["id"], rows_per_range=rows)
    got = sorted((r.position, r.id) for r in out.collect())
    assert [p for p, _ in got] == list(range(1_000))
    assert sorted(i for _, i in got) == list(range(1_000))
    assert [i for _, i in got] != list(range(1_000))
    again = sorted((r.position, r.id) for r in seeded_shuffle(
        df.repartition(3), ["id"], rows_per_range=rows).collect())
    assert again == got


def test_shuffle_of_copies(spark, monkeypatch):
    """A row with very many copies is counted, written out in pieces, and scattered."""
    import cohortline.operators.order as order
    monkeypatch.setattr(order, "_COPIES_PER_PIECE", 100)
    df = spark.range(3_000).select(F.when(F.col("id") < 1_000, 0).otherwise(F.col("id")).alias("x"))
    got = [(r.position, r.x) for r in seeded_shuffle(df).collect()]
    assert sorted(p for p, _ in got) == list(range(3_000))
    assert Counter(x for _, x in got)[0] == 1_000
    ranks = sorted(p for p, x in got if x == 0)
    thirds = [sum(low <= p < low + 1_000 for p in ranks) for low in (0, 1_000, 2_000)]
    assert min(thirds) > 250


def test_shuffle_deals_rows_out_once(spark):
    """Besides counting copies one exchange, by ranges as many as the rows need."""
    out = seeded_shuffle(spark.range(5_000), rows_per_range=100)
    assert out.rdd.getNumPartitions() == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert seeded_shuffle(spark.range(0)).collect() == []


def test_shuffle_deals_rows_out_in_one_pass(spark, monkeypatch):
    """Equal ranges of the hash need no sample of all copies, fill alike and keep the order of the hashes."""
    df = spark.range(4000).selectExpr("id % 40 AS a")
    monkeypatch.setattr(type(df), "repartitionByRange", None)
    found = seeded_shuffle(df, rows_per_range=200)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 300
    rows = found.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(4000))
    code = lambda text: hashlib.md5(text.encode()).hexdigest()
    hashes = sorted((h if c == 0 else code(f"{h}|{c}"), a) for a in range(40) for h in [code(f"{a}|42")] for c in range(100))
    assert [r.a for r in rows] == [a for _, a in hashes]
