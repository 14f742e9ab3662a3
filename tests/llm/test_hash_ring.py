"""The ring: even counts, gapless slots, agreement with a plain walk, limited movement, odd rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortline.llm import hash_ring
from cohortline.llm.queries import op11_hash_ring


def plain_walk(blocks, sizes, ring, capacity):
    """Row by row around the ring: (block, row) -> (shard, slot)."""
    load, out = [0] * ring.count, {}
    for block, size in zip(blocks, sizes):
        for row in range(size):
            at = block % len(ring.points)
            while load[ring.shards[at]] >= capacity[ring.shards[at]]:
                at = (at + 1) % len(ring.points)
            shard = int(ring.shards[at])
            out[block, row] = (shard, load[shard])
            load[shard] += 1
    return out


@pytest.mark.parametrize("shards, rows, slack", [(5, 400, 0.0), (5, 403, 0.1), (7, 3, 0.0), (1, 10, 0.0)])
def test_walk_equals_plain_walk(shards, rows, slack):
    ring = hash_ring.Ring.of(shards, nodes=8)
    blocks, sizes = np.unique(np.random.default_rng(rows).integers(0, 4 * len(ring.points), rows), return_counts=True)
    capacity = hash_ring.capacities(rows, shards, slack)
    took = hash_ring.walk(blocks, sizes, ring, capacity)
    ours = {(r.block, i): (r.shard, r.slot + i - r.first) for r in took.itertuples() for i in range(r.first, r.upto)}
    assert ours == plain_walk(blocks.tolist(), sizes.tolist(), ring, capacity)
    assert len(took) <= len(blocks) + shards


def even_and_gapless(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = op11_hash_ring(spark, folder).collect()
    even_and_gapless(rows, 24)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_partitioning_changes_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(3000)], "doc_id long, text string")
    once = {tuple(r) for r in hash_ring.sharded(docs.coalesce(1), 6).collect()}
    assert once == {tuple(r) for r in hash_ring.sharded(docs.repartition(7), 6).collect()}


def test_one_more_shard_moves_few_rows(spark):
    docs = spark.createDataFrame([(i, "") for i in range(6000)], "doc_id long, text string")
    of = lambda n, slack: {r.doc_id: r.shard for r in hash_ring.placed(docs, n, slack=slack).collect()}
    for slack, most in ((0.0, 0.45), (0.25, 0.25)):
        before, after = of(10, slack), of(11, slack)
        assert sum(before[i] != after[i] for i in before) / len(before) < most
    counts = Counter(of(10, 0.25).values())
    assert max(counts.values()) <= 750


def test_odd_rows(spark):
    many = [(7, "copy")] * 50_000
    odd = [(None, "a"), (None, None), (1, None), (1, None), (2, ""), (2, "x" * 300_000), (-3, "é\0")]
    docs = spark.createDataFrame(many + odd, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS size", "2 AS block", "3 AS copy", "4 AS shard")
    rows = hash_ring.sharded(docs, 24).collect()
    even_and_gapless(rows, 24)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in many + odd)
    assert hash_ring.sharded(docs.limit(0), 24).collect() == []
    even_and_gapless(hash_ring.sharded(docs.limit(5), 24).collect(), 24)
