"""Mix sources to target weights by an exact multivariate-hypergeometric splitting tree.

Documents of a source lie in blocks by a seeded hash, which is a random order
already. A target of more than the source means whole passes over its blocks and
a rest; the rest ends inside one block, found by summing hash ranges ever more
finely, whose documents are then picked to come nearest. That gives every source
an exact quota of block draws. A binary tree over the output shards splits the
quotas: each node deals its draws to its two halves by a seeded
multivariate-hypergeometric draw, so every shard holds a random share of every
source, the shares add up exactly, and each shard's draws are ranges of the
sources' permuted blocks that no other shard has. Shards order their rows by a
seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.settings import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Most times that a source may be taken.
TIMES = 3
BLOCK_WORDS, SHARD_WORDS = 1 << 14, 1 << 20
#: Most documents of the block in which a source's rest ends; above it the block is cut further.
LEAF = 2048
#: Most sources: their sums are the only thing that reaches the driver.
SOURCES = 100_000
BITS = 60


def sized(docs: DataFrame, seed: int = 0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, place): words of each text and its seeded place in 0 .. 2^60."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("long"), F.lit("place")), 64 - BITS).alias("place"))


def _order(name: str | None) -> tuple:
    return (name is None, name or "")


def targets(sizes: dict[str | None, int], weights=WEIGHTS, times: int = TIMES) -> dict[str | None, float]:
    """Words to take of each source: all words shared by weight, none above ``times`` its size.

    Sources stand in code point order, NULL last; weights repeat along it. What a
    source can't take is shared again by weight among the others.
    """
    names = sorted(sizes, key=_order)
    weight = {n: float(weights[i % len(weights)]) for i, n in enumerate(names)}
    out: dict = {}
    free = names
    left = float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[n] for n in free)
        over = [n for n in free if unit * weight[n] > times * sizes[n]]
        if not over:
            return out | {n: unit * weight[n] for n in free}
        for n in over:
            out[n] = float(times * sizes[n])
        left = max(float(sum(sizes.values())) - sum(out.values()), 0.0)
        free = [n for n in free if n not in out]
    return out


def _plan(sums: list, weights, times, block_words) -> pd.DataFrame:
    """One row per source: its target, whole passes, the rest in words, its number of blocks."""
    size = {r.source: int(r.size) for r in sums}
    want = targets(size, weights, times)
    names = sorted(size, key=_order)
    rows = []
    for i, name in enumerate(names):
        whole = int(want[name] // size[name]) if size[name] else 0
        bits = max(0, int(np.ceil(np.log2(max(size[name] / block_words, 1)))))
        rows.append((i, name, size[name], want[name], whole, want[name] - whole * size[name], min(bits, BITS)))
    return pd.DataFrame(rows, columns=["at", "source", "source_size", "target", "whole", "rest", "bits"])


def _frame(spark, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _rests(spark, docs: DataFrame, plan: pd.DataFrame) -> dict[int, tuple[int, int, float]]:
    """Where each source's rest ends: (at) -> (prefix, bits, words still to take inside)."""
    counts = {r.source: r.n for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    ends = {int(r.at): (0, 0, float(r.rest)) for r in plan.itertuples() if r.rest > 0}
    name = {int(r.at): r.source for r in plan.itertuples()}
    todo = [at for at in ends if counts[name[at]] > LEAF]
    while todo:
        frame = _frame(spark, [(at, name[at], *ends[at]) for at in todo],
                       "at int, name string, prefix long, bits int, rest double")
        inside = docs.join(F.broadcast(frame), F.col("source").eqNullSafe(F.col("name"))).filter(
            F.expr(f"shiftright(place, {BITS} - bits) = prefix"))
        cells = (inside.withColumn("cell", F.expr(f"shiftright(place, {BITS - 10} - bits) & 1023"))
                 .groupBy("at", "cell", "rest").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
        upto = F.sum("size").over(Window.partitionBy("at").orderBy("cell"))
        least = F.row_number().over(Window.partitionBy("at").orderBy("cell"))
        found = (cells.withColumn("upto", upto).filter("upto >= rest or upto is null")
                 .withColumn("r", least).filter("r = 1").collect())
        again = []
        for r in found:
            prefix, bits, rest = ends[r.at]
            ends[r.at] = (prefix * 1024 + r.cell, bits + 10, rest - (r.upto - r.size))
            if r.n > LEAF and bits + 20 <= BITS:
                again.append(r.at)
        todo = again
    return ends


def _nearest(docs: pd.DataFrame) -> pd.DataFrame:
    """Documents of one last block whose sizes come nearest to the words still wanted: large ones first."""
    docs = docs.sort_values(["size", "place"], ascending=[False, True], kind="stable")
    left, taken = float(docs["rest"].iloc[0]), np.zeros(len(docs), bool)
    sizes = docs["size"].to_numpy()
    for i, size in enumerate(sizes):
        if 0 < size <= left:
            taken[i] = True
            left -= size
    spare = np.flatnonzero(~taken & (sizes > 0))
    if len(spare) and abs(left - sizes[spare[-1]]) < left:
        taken[spare[-1]] = True
    return docs.loc[taken, ["at", "place"]]


def _shares(seed: int, shards: int, quotas: list[int]):
    """For each shard: its path down the splitting tree gives first draw and number of draws of each source."""
    def walk(shard: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = 0, shards
        left, first = np.array(quotas, np.int64), np.zeros(len(quotas), np.int64)
        while high - low > 1:
            middle = (low + high) // 2
            draws = int(left.sum() * (middle - low) // (high - low))
            rng = np.random.default_rng([seed, low, high])
            half = rng.multivariate_hypergeometric(left, draws, method="marginals")
            if shard < middle:
                high, left = middle, half
            else:
                low, left, first = middle, left - half, first + half
        return first, left

    def run(batches):
        for rows in batches:
            for shard in rows["id"]:
                first, count = walk(int(shard))
                held = np.flatnonzero(count)
                yield pd.DataFrame({"shard": np.int64(shard), "at": held.astype(np.int32),
                                    "first": first[held], "draws": count[held]})
    return run


def mixed(docs: DataFrame, weights=WEIGHTS, times: int = TIMES, block_words: int = BLOCK_WORDS,
          shard_words: int = SHARD_WORDS, seed: int = 0, key: str = "doc_id", text: str = "text",
          source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(sizes, draws) of the mix.

    ``sizes`` has one row per row of ``docs``: doc_id, source, size, at (number of
    the source), place, source_size, target, copies. ``draws`` has one row per
    copy that the mix takes: doc_id, source, size, copy (from 0), shard, at,
    place, turn (the order within the shard).

    Sources stand in code point order with NULL last, and weights repeat along
    it. Texts that are NULL or empty have size 0 and are copied with whole
    passes only. Rows that repeat a doc_id are drawn together. An empty table
    gives empty results. The same rows and seed give the same mix for any
    partitioning.
    """
    spark = docs.sparkSession
    rows = cut_lineage(sized(docs, seed, key, text, source))
    sums = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(SOURCES + 1).collect()
    if len(sums) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    plan = _plan(sums, weights, times, block_words)
    ends = _rests(spark, rows, plan)
    state = []
    for r in plan.itertuples():
        prefix, bits, rest = ends.get(int(r.at), (0, 0, 0.0))
        state.append((int(r.at), r.source, int(r.source_size), float(r.target), int(r.whole), int(r.bits),
                      int(prefix), int(bits), float(rest), int(r.at) in ends))
    frame = _frame(spark, state, "at int, name string, source_size long, target double, whole int, block_bits int, "
                                 "prefix long, end_bits int, rest double, partial boolean")
    placed = (rows.join(F.broadcast(frame), F.col("source").eqNullSafe(F.col("name"))).drop("name")
              .withColumn("range", F.expr(f"shiftright(place, {BITS} - end_bits)")))
    last = (placed.filter("partial and range = prefix").groupBy("at", "place", "rest")
            .agg(F.sum("size").alias("size")))
    picked = cut_lineage(last.groupBy("at").applyInPandas(_nearest, "at int, place long")
                         .withColumn("extra", F.lit(1)))
    copies = F.col("whole") + F.when(F.col("partial"), F.when(F.col("range") < F.col("prefix"), 1)
                                     .otherwise(F.coalesce("extra", F.lit(0)))).otherwise(0)
    counted = (placed.join(picked, ["at", "place"], "left").withColumn("copies", copies.cast("int"))
               .withColumn("block", F.expr(f"shiftright(place, {BITS} - block_bits)")))
    sizes = counted.select("doc_id", "source", "size", "at", "place", "source_size", "target", "copies")

    quotas = []
    for at, _, _, _, whole, block_bits, prefix, bits, _, partial in state:
        upto = 0
        if partial:  # blocks from the first to the one where the rest ends
            upto = (prefix >> (bits - block_bits)) + 1 if bits >= block_bits else (prefix + 1) << (block_bits - bits)
        quotas.append((whole << block_bits) + upto)
    words = float(plan["target"].sum()) if len(plan) else 0.0
    shards = max(1, int(np.ceil(words / shard_words)))
    dealt = (spark.range(shards).mapInPandas(_shares(seed, shards, quotas), "shard long, at int, first long, draws long")
             .select("shard", "at", F.explode(F.expr("sequence(first, first + draws - 1)")).alias("draw")))
    # pass c takes the blocks in the order (odd * b + shift) modulo their number; the last pass in hash order
    taken = counted.filter("copies > 0").withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)")))
    number = F.expr("shiftleft(1L, block_bits)")
    factor = F.pmod(F.xxhash64(F.lit(seed), "at", "copy", F.lit("odd")), F.lit(1 << 20)) * 2 + 1
    shift = F.pmod(F.xxhash64(F.lit(seed), "at", "copy", F.lit("shift")), F.lit(1 << 20))
    turned = F.when(F.col("copy") < F.col("whole"), F.pmod(F.col("block") * factor + shift, number)).otherwise(F.col("block"))
    draws = (taken.withColumn("draw", F.col("copy").cast("long") * number + turned)
             .join(dealt, ["at", "draw"])
             .select("doc_id", "source", "size", "copy", "shard", "at", "place",
                     F.xxhash64(F.lit(seed), "shard", "place", "copy").alias("turn")))
    return sizes, draws


def mixture_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row: the words the drawn copies come to."""
    sizes, draws = mixed(docs, **options)
    keys = ["at", "place"]
    per = draws.groupBy(keys).agg(F.count("*").alias("drawn"))
    rows = sizes.groupBy(keys).agg(F.count("*").alias("rows"))
    times = per.join(rows, keys).select(*keys, (F.col("drawn") / F.col("rows")).cast("long").alias("times"))
    return sizes.join(times, keys, "left").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, dealt by shard and shuffled within it."""
    _, draws = mixed(docs, **options)
    where = (draws.groupBy("doc_id", "source", "size")
             .agg(F.array_sort(F.collect_set(F.struct("shard", "turn"))).alias("_mix_at")))
    marked = docs.withColumns({
        "_mix_id": F.col("doc_id").cast("long"), "_mix_source": F.col("source").cast("string"),
        "_mix_size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")})
    rows = marked.join(where, [marked["_mix_id"].eqNullSafe(where["doc_id"]), marked["_mix_size"] == where["size"],
                               marked["_mix_source"].eqNullSafe(where["source"])])
    return (rows.select(*(marked[c] for c in docs.columns), F.explode("_mix_at").alias("_mix_turn"))
            .repartition("_mix_turn.shard").sortWithinPartitions("_mix_turn.shard", "_mix_turn.turn")
            .select(*docs.columns))
