"""Approximate nearest neighbours: a product-quantised index, several cells probed, exact re-ranking.

Train points fall into cells around coarse centres, and what is left of a point
after its centre is stored as one byte per part: the nearest of 256 part centres.
Centres come from a bounded sample, but every point is indexed. A test point looks
into the cells whose centres are nearest; their codes give approximate distances to
all points there, and the best of them are measured exactly. Points travel as
numbers and codes, so that a vector moves once, for the few that are re-ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortline.operators.nearest import _first_copies, _point
from cohortline.settings import cut_lineage

#: Points the centres are fitted on, chosen by hash.
SAMPLE = 20_000
#: Points per cell aimed at; coarse centres at most, so that the index is at most some MB.
CELL_ROWS, MOST_CELLS = 4096, 1024
CENTRES = 256
#: Points and test points that meet in one unit of work; each point found carries its test point.
BLOCK, CHUNK = 1 << 15, 1 << 9
#: Distances that a unit holds at a time.
PAIRS = 1 << 20


def _nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1)[None, :] - 2 * x @ centres.T, axis=1)


def centres_of(x: np.ndarray, count: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Means of ``count`` groups (as many as there are points, if fewer), by Lloyd's rounds from a seeded start."""
    rng = np.random.Generator(np.random.PCG64(seed))
    x = np.unique(x, axis=0)
    centres = x[rng.permutation(len(x))[:count]]
    for _ in range(rounds):
        group = _nearest_centre(x, centres)
        size = np.bincount(group, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, group, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class _Index:
    cells: np.ndarray
    parts: tuple[np.ndarray, ...]
    cuts: tuple[int, ...]

    @classmethod
    def of(cls, sample: np.ndarray, cells: int, parts: int, seed: int) -> "_Index":
        coarse = centres_of(sample, cells, seed)
        rest = sample - coarse[_nearest_centre(sample, coarse)]
        edges = np.linspace(0, sample.shape[1], min(parts, sample.shape[1]) + 1).astype(int)
        return cls(coarse, tuple(centres_of(rest[:, a:b], CENTRES, seed + 1 + i)
                                 for i, (a, b) in enumerate(zip(edges, edges[1:]))), tuple(edges.tolist()))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _nearest_centre(x, self.cells)
        rest = x - self.cells[cell]
        codes = [_nearest_centre(rest[:, a:b], c) for a, b, c in zip(self.cuts, self.cuts[1:], self.parts)]
        return cell, np.stack(codes, axis=1).astype(np.uint8)

    def decode(self, cell: int, codes: np.ndarray) -> np.ndarray:
        return self.cells[cell] + np.concatenate([c[codes[:, i]] for i, c in enumerate(self.parts)], axis=1)

    def probed(self, x: np.ndarray, probes: int) -> np.ndarray:
        distance = (self.cells ** 2).sum(1)[None, :] - 2 * x @ self.cells.T
        return np.argsort(distance, axis=1, kind="stable")[:, :probes]


@dataclass(frozen=True)
class QuantisedModel:
    """Train points by number, their codes by cell, and the centres."""
    rows: DataFrame
    codes: DataFrame
    index: _Index
    k: int
    features: Sequence[str] | str
    probes: int
    reranked: int

    def neighbours(self, points: DataFrame) -> DataFrame:
        """(point, key, label, distance, rank): about the k nearest train rows of every distinct ``point``.

        Distances are exact, and ties go to the smaller key; a nearer row may be
        missing where its cell was not probed or its code lies too far off.
        """
        shared = points.sparkSession.sparkContext.broadcast(self.index)
        probes, best = self.probes, self.reranked
        asked_schema = pa.schema([("point", pa.list_(pa.float64())), ("cell", pa.int32())])

        def probe(batches):
            for batch in batches:
                if batch.num_rows:
                    column = batch.column(0)
                    cells = shared.value.probed(column.flatten().to_numpy().reshape(len(column), -1), probes)
                    for place in cells.T:
                        yield pa.RecordBatch.from_arrays([column, pa.array(place.astype(np.int32))], schema=asked_schema)

        asked = cut_lineage(points.select("point").distinct().mapInArrow(probe, "point array<double>, cell int"))
        # Two small tables: a row per cell.
        held = self.codes.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        wanted = asked.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
        sizes = F.broadcast(cut_lineage(held.join(wanted, "cell")))
        left = (asked.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("point"), F.col("chunks")).cast("int"))
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "chunks"))
        right = (self.codes.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int"))
                 .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("blocks", "chunks"))
        schema = pa.schema([("point", pa.list_(pa.float64())), ("number", pa.int64()), ("about", pa.float64())])

        def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
            if not asked.num_rows or not held.num_rows:
                return schema.empty_table()
            column = asked.column("point").combine_chunks()
            x = column.flatten().to_numpy().reshape(len(column), -1)
            codes = np.frombuffer(b"".join(held.column("code").to_pylist()), np.uint8).reshape(held.num_rows, -1)
            near = shared.value.decode(held.column("cell")[0].as_py(), codes)
            numbers = held.column("number").to_numpy()
            found = []
            step = max(1, PAIRS // len(near))
            for low in range(0, len(x), step):
                part = x[low:low + step]
                about = (part ** 2).sum(1)[:, None] + (near ** 2).sum(1)[None, :] - 2 * part @ near.T
                n = min(best, len(near))
                at = np.argpartition(about, n - 1, axis=1)[:, :n]
                found.append((np.repeat(np.arange(low, low + len(part)), n), numbers[at].ravel(),
                              np.take_along_axis(about, at, 1).ravel()))
            row, number, about = (np.concatenate(f) for f in zip(*found))
            return pa.table([column.take(pa.array(row)), pa.array(number), pa.array(about)], schema=schema)

        met = (left.groupBy("cell", "block", "chunk").cogroup(right.groupBy("cell", "block", "chunk"))
               .applyInArrow(meet, "point array<double>, number long, about double"))
        order = Window.partitionBy("point").orderBy("about", "number")
        few = met.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= best)
        other = self.rows.withColumnRenamed("point", "near")
        squares = F.zip_with("point", "near", lambda a, b: (a - b) * (a - b))
        exact = few.join(other, "number").withColumn(
            "distance", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)))
        nearest = Window.partitionBy("point").orderBy("distance", "key", "label")
        return (exact.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= self.k)
                .select("point", "key", "label", "distance", "rank"))

    def predict(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        """Add the majority label of the rows found; tied votes go to the smaller label."""
        asked = df.withColumn("point", _point(self.features))
        votes = self.neighbours(asked).groupBy("point").agg(F.mode("label", True).alias(prediction_col))
        return asked.join(votes, "point").drop("point")


def fit_quantised(train: DataFrame, features: Sequence[str] | str, key: str, label: str, k: int = 3, parts: int = 16,
                  probe_share: float = 1 / 8, reranked: int = 100, seed: int = 7) -> QuantisedModel:
    """Index every train row. ``features`` are columns, or one array column; of copies of a point k are kept.

    ``probe_share`` of the cells is probed (at least 4, or all), and ``reranked``
    points are measured exactly per test point. A missing feature is an error, as is an empty table.
    """
    rows = cut_lineage(_first_copies(train.select(
        _point(features).alias("point"), F.col(key).alias("key"), F.col(label).alias("label")), k))
    rows = rows.withColumn("number", F.monotonically_increasing_id())
    total = rows.count()
    if not total:
        raise ValueError("no train rows")
    place = F.pmod(F.xxhash64("point", F.lit(seed)), F.lit(1 << 31))
    sample = rows.filter(place < int(min(1.0, 1.2 * SAMPLE / total) * (1 << 31))).orderBy(place, "number").limit(SAMPLE)
    points = np.array([r.point for r in sample.select("point").collect()] or [rows.first().point], float)
    cells = min(MOST_CELLS, math.ceil(total / CELL_ROWS))
    index = _Index.of(points, cells, parts, seed)
    shared = rows.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("cell", pa.int32()), ("number", pa.int64()), ("code", pa.binary())])

    def encode(batches):
        for batch in batches:
            if batch.num_rows:
                column = batch.column(0)
                cell, codes = shared.value.encode(column.flatten().to_numpy().reshape(len(column), -1))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column(1),
                                                  pa.array([c.tobytes() for c in codes], pa.binary())], schema=schema)

    codes = cut_lineage(rows.select("point", "number").mapInArrow(encode, "cell int, number long, code binary"))
    probes = min(len(index.cells), max(4, math.ceil(probe_share * len(index.cells))))
    return QuantisedModel(rows, codes, index, k, features, probes, max(reranked, k))
