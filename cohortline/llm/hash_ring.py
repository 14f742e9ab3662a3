"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at ``NODES`` points of a ring of 64-bit numbers, and a row
belongs to the first point clockwise from its hash. Rows arrive in an order that
a second hash sets. A full shard takes no more: what comes to it goes on
clockwise to the next shard with room. Capacities add up to the number of rows
(``slack`` 0), so row counts of shards are at most one apart.

Rows that come to one arc of the ring in one of ``TURNS`` turns are a block. The
walk around the ring needs only the number of rows in every block, a table whose
size the ring sets and the data does not. It yields for every block the shards
that take its rows, and from which slot on; rows are then numbered inside their
blocks. No text is shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.settings import cut_lineage

NODES, TURNS = 64, 64
#: Copies of one row that one task writes out.
PIECE = 1 << 14


@dataclass(frozen=True)
class Ring:
    """Points in ascending order and the shard of each."""
    points: np.ndarray
    shards: np.ndarray
    count: int

    @classmethod
    def of(cls, shards: int, nodes: int = NODES, seed: int = 0) -> "Ring":
        """A shard's points depend on its number alone: one more shard moves no point."""
        if shards < 1 or nodes < 1:
            raise ValueError("a ring needs a shard and a node")
        found = [(int.from_bytes(hashlib.blake2b(f"{seed}:{s}:{n}".encode(), digest_size=8).digest(), "big"), s)
                 for s in range(shards) for n in range(nodes)]
        points, owners = zip(*sorted(found))
        return cls(np.array(points, np.uint64), np.array(owners, np.int64), shards)

    def owners(self, is_open: np.ndarray) -> np.ndarray:
        """For every arc (the one that ends in each point) the first open shard clockwise."""
        n = len(self.points)
        at = np.where(is_open[np.concatenate([self.shards, self.shards])], np.arange(2 * n), 2 * n)
        return self.shards[np.minimum.accumulate(at[::-1])[::-1][:n] % n]


def capacities(rows: int, shards: int, slack: float = 0.0) -> np.ndarray:
    """Most rows of each shard: even shares, the first ones one more; all ``slack`` larger, if given."""
    even = np.full(shards, rows // shards, np.int64) + (np.arange(shards) < rows % shards)
    return even if slack <= 0 else np.ceil(even * (1 + slack)).astype(np.int64)


def walk(blocks: np.ndarray, sizes: np.ndarray, ring: Ring, capacity: np.ndarray) -> pd.DataFrame:
    """Who takes the rows of each block: (block, first, upto, shard, slot).

    ``blocks`` are turn * arcs + arc, ascending. Rows first .. upto - 1 of a block go
    to the shard, from that slot on. There is one row per block and one more for
    every shard that fills inside a block.
    """
    room = capacity.copy()
    owner = ring.owners(room > 0) if (room > 0).any() else None
    arcs, out = len(ring.points), []
    for block, size in zip(blocks.tolist(), sizes.tolist()):
        first = 0
        while first < size:
            shard = int(owner[block % arcs])
            take = min(size - first, int(room[shard]))
            out.append((block, first, first + take, shard, int(capacity[shard] - room[shard])))
            room[shard] -= take
            first += take
            if not room[shard] and (room > 0).any():
                owner = ring.owners(room > 0)
    return pd.DataFrame(out, columns=["block", "first", "upto", "shard", "slot"]).astype(
        {"block": "int64", "first": "int64", "upto": "int64", "shard": "int32", "slot": "int64"})


def _each_row(counted: DataFrame) -> DataFrame:
    """One row per copy again, numbered; many copies of one row are written out by many tasks."""
    few = counted.filter(F.col("copies") <= PIECE).withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    many = (counted.filter(F.col("copies") > PIECE)
            .withColumn("begin", F.explode(F.expr(f"sequence(0L, copies - 1, {PIECE}L)")))
            .repartition("doc_id", "text_crc32", "begin")
            .withColumn("copy", F.explode(F.expr(f"sequence(begin, least(begin + {PIECE - 1}, copies - 1))"))))
    return few.drop("copies").unionByName(many.drop("copies", "begin"))


def placed(docs: DataFrame, shards: int, nodes: int = NODES, turns: int = TURNS, slack: float = 0.0, seed: int = 0,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, home, shard, slot.

    ``size`` is the UTF-8 length of the text plus 8, ``home`` the shard that the ring
    alone would choose, ``slot`` the row's place in its shard, without gaps from 0. A
    NULL text counts as empty, a NULL doc_id is a key like any other. Rows alike in
    all three columns are told apart by a copy number, which is part of their hash, so
    that many copies spread over the ring. Equal tables give equal results however
    they are partitioned; an empty one gives no rows; other columns are not read.
    """
    ring = Ring.of(shards, nodes, seed)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    counted = cut_lineage(
        docs.select(F.col(key).cast("long").alias("doc_id"), (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
                    F.crc32(body.cast("binary")).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")))
    shared = docs.sparkSession.sparkContext.broadcast(ring.points)

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        points = shared.value
        at = np.searchsorted(points, place.to_numpy().astype(np.int64).view(np.uint64))
        return pd.Series((at % len(points)).astype(np.int32))

    arcs = len(ring.points)
    named = (F.coalesce(F.col("doc_id"), F.lit(0).cast("long")), F.col("doc_id").isNull(), F.col("copy"))
    rows = _each_row(counted).withColumns({
        "turn": F.xxhash64(F.lit(seed), F.lit("turn"), *named),
        "arc": arc_of(F.xxhash64(F.lit(seed), F.lit("place"), *named))})
    rows = rows.withColumn("block", F.pmod("turn", F.lit(turns)) * arcs + F.col("arc"))
    sizes = rows.groupBy("block").agg(F.count("*").alias("n")).toPandas().sort_values("block")
    took = walk(sizes["block"].to_numpy(np.int64), sizes["n"].to_numpy(np.int64), ring,
                capacities(int(sizes["n"].sum()), shards, slack))
    took["home"] = ring.shards[took["block"].to_numpy() % arcs].astype(np.int32)
    pieces = docs.sparkSession.createDataFrame(
        pa.Table.from_pandas(took, preserve_index=False)) if len(took) else docs.sparkSession.createDataFrame(
        [], "block long, first long, upto long, shard int, slot long, home int")
    order = Window.partitionBy("block").orderBy("turn", "doc_id", "text_crc32", "size", "copy")
    ranked = rows.withColumn("at", (F.row_number().over(order) - 1).cast("long"))
    # As many rows as blocks, and one more per shard: the ring's size, whatever the data.
    hit = (F.col("p.block") == F.col("r.block")) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("upto"))
    return ranked.alias("r").join(F.broadcast(pieces.alias("p")), hit).select(
        "doc_id", "size", "text_crc32", "home", "shard", (F.col("slot") + F.col("at") - F.col("first")).alias("slot"))


def sharded(docs: DataFrame, shards: int = 24, **settings) -> DataFrame:
    """``placed`` under the law of even row counts, with the law's name and no grown shard."""
    return placed(docs, shards, **settings).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home")
