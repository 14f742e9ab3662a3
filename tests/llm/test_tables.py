"""Top-k, URL rules, mixing and the pipeline against plain forms on small tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
import corpus_pipeline
from cohortline.llm import mixing, top_k, url_rules


def nearest(rows, k, every):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("width", [1, 6, 64])
def test_top_k_equals_all_scores(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, [float(x) for x in rng.normal(size=width).round(2)]) for i in range(400)]
    rows += [(400 + i, rows[50][1]) for i in range(30)]  # ties
    rows += [(500, None), (501, [float("nan")] * width), (502, [None] * width), (None, rows[0][1]), (550, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = top_k.top_k(df.withColumns({"rank": F.lit(1), "score": F.lit(2)}), 5, 50).collect()
    assert sorted(tuple(r) for r in found) == nearest(rows, 5, 50)


def test_top_k_of_huge_numbers_and_few_rows(spark):
    rows = [(0, [3e30, -1.0]), (1, [2e30, 5.0]), (2, [0.0, 0.0])]
    found = {(r.vec_id): r.score for r in top_k.top_k(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: 2 ** 63 - 1, 2: 0}
    assert top_k.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_top_k_in_several_batches(spark, monkeypatch):
    monkeypatch.setattr(top_k, "QUERY_BYTES", 300)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(60)]
    found = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 10).collect()
    assert sorted(tuple(r) for r in found) == nearest(rows, 3, 10)


def test_segment_bounds_hold():
    rng = np.random.default_rng(4)
    q, x = rng.normal(size=(20, 37)), rng.normal(size=(30, 37))
    exact = q @ x.T
    for width in top_k.SEGMENTS:
        assert (top_k._statistics(q, width) @ top_k._statistics(x, width).T >= exact - 1e-9).all()


def verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_url_rules(spark):
    urls = ["http://a.Example.ORG/en/12?x", "https://example.org/es/", "example.org/es/", None, "", "x://", "x://org",
            "x://org/", "x://notexample.org/es/1", "x://com/de/fr", "x://a.b.com/fr/#y", "x://..org//", "x://org?/en/1",
            "x://É.com/de/é", "x://" + "a." * 3000 + "com/de/" + "p" * 5000, "x://u@h.org:80/"]
    rules = [*url_rules.RULES, ("block", "org", "/en"), ("allow", "b.com", "/"), ("block", "b.com", "/")]
    rows = [(n, u) for n, u in enumerate(urls)] + [(3, None), (0, urls[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("x"), "rule": F.lit("y")})
    found = url_rules.judged(pages, url_rules.rule_frame(spark, rules)).collect()
    assert len(found) == len(rows)
    assert {tuple(r) for r in found} == {(i, *verdict(u, rules)) for i, u in rows}
    assert {r.verdict for r in url_rules.judged(pages, url_rules.rule_frame(spark, rules).limit(0), "block").collect()} == {"block"}
    assert url_rules.judged(pages.limit(0), url_rules.rule_frame(spark)).collect() == []


def test_targets():
    assert mixing.targets({"a": 10, "b": 10, None: 10}) == pytest.approx({"a": 18.75, "b": 7.5, None: 3.75})
    found = mixing.targets({"a": 1, "b": 10, "c": 100})
    assert found["a"] == 3 and found["b"] == 30 and found["c"] == pytest.approx(78)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0, "b": 4}) == {"a": 0.0, "b": 4.0}


def docs(spark, sources):
    rng = random.Random(8)
    rows = [(n, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), s)
            for n, s in enumerate(s for s, many in sources.items() for _ in range(many))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixture_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 64)
    frame = docs(spark, {"a": 40, "b": 900, "c": 30, "é": 300, None: 50})
    first = mixing.mixture_sizes(frame, block_words=200, shard_words=1500).toPandas()
    again = mixing.mixture_sizes(frame.repartition(9), block_words=200, shard_words=1500).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, first[key].values)) == sorted(map(tuple, again[key].values))
    assert (first.taken <= 3 * first["size"]).all() and ((first.taken % first["size"].clip(lower=1)) == 0).all()
    named = first.merge(frame.toPandas()[["doc_id", "source"]], on="doc_id")
    for name, rows in named.groupby("source", dropna=False):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) <= 30  # half a document
        assert rows["size"].sum() == rows.source_size.iloc[0]


def test_draws_are_dealt_once_and_shards_are_even(spark):
    frame = docs(spark, {"a": 300, "b": 300, "c": 300})
    sizes, draws = mixing.mixed(frame, block_words=100, shard_words=3000)
    rows = draws.toPandas()
    assert not rows.duplicated(["doc_id", "copy"]).any()
    assert len(rows) == sizes.agg(F.sum("copies")).first()[0] - sizes.filter("copies > 0 and size is null").count()
    words = rows.groupby("shard")["size"].sum()
    assert words.max() <= 2 * words.mean()


def test_mixing_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (3, "one two", None), (None, "x y z", "b"), (5, "w " * 5000, "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("place", F.lit(1))
    found = mixing.mixture_sizes(frame)
    assert found.count() == len(rows)
    assert mixing.mixed_rows(frame).columns == frame.columns
    assert mixing.mixture_sizes(frame.limit(0)).collect() == []


def test_pipeline_stages(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(n)))
        frame = spark.read.parquet(str(tmp_path / str(n)))
        assert frame.count() > 0
    assert "n_tokens" in frame.columns
    assert corpus_pipeline.run(spark, folder).count() == frame.count()


def test_every_operator_is_registered():
    names = set(entry_file.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names
