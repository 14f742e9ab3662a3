"""Exact top-k by inner product with multi-resolution segment statistics.

For a segment of w components with means m and deviations s, the inner product of
two vectors is at most w (m m' + s s') there; the squared distance is at least
w ((m - m')^2 + (s - s')^2), which is the same bound. Summed over few long
segments, then over more short ones, it rules out candidates that can't reach a
query's k-th best score so far; the rest get exact integer scores. Queries go to
the tasks in batches of bounded size, candidates stay where they are read.

Bounds and scores are made for tiles of queries and candidates as matrix products.
Where few pairs of a tile survive, they are scored one by one, else the whole tile
is. A level that ruled out few pairs lately rests for some tiles.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.inputs import batch
from cohortline.settings import cut_lineage

#: Most bytes of query components that are sent to the tasks at once.
QUERY_BYTES = 8 << 20
#: Candidates and queries of a tile, pairs that are scored together.
BLOCK, TILE, PAIRS = 1024, 1024, 1 << 18
#: Share of a tile up to which survivors are scored one by one: that costs as much as 100 pairs of a product.
FEW = 0.01
#: Share of the pairs that a level must rule out, and the tiles for which it rests if it does not.
WORTH, REST = 0.3, 15
#: Components per segment, coarse to fine.
SEGMENTS = (16, 4)


def whole_numbers(vectors: np.ndarray, scale: float = 256.0) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale)


def _statistics(x: np.ndarray, width: int) -> np.ndarray:
    """sqrt(w) times means and deviations of every segment: their inner product is the bound."""
    n, d = x.shape
    cuts = np.arange(0, d, width)
    size = np.diff(np.append(cuts, d))
    mean = np.add.reduceat(x, cuts, axis=1) / size
    spread = x - np.repeat(mean, size, axis=1)
    deviation = np.sqrt(np.add.reduceat(spread * spread, cuts, axis=1) / size)
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([size, size]))


class _Best:
    """The k best (score, smallest id) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.queries = k, queries
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.floor = np.full(queries, -np.inf)

    def add(self, query, score, ids):
        query, score, ids = (np.concatenate(p) for p in zip((self.query, self.score, self.id), (query, score, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        begin = np.searchsorted(query, np.arange(self.queries))
        rank = np.arange(len(query)) - begin[query]
        self.floor[query[rank == self.k - 1]] = score[rank == self.k - 1]
        kept = rank < self.k
        self.query, self.score, self.id = query[kept], score[kept], ids[kept]


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; beyond 53 bits by Python's integers, cut to 64 bits."""
    if len(q) == 0:
        return np.zeros(0, np.int64)
    if q.shape[1] == 0:
        return np.zeros(len(q), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0 ** 53:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    sums = (sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(q, x))
    return np.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for s in sums], np.int64)


class _Levels:
    """Which levels of a search are worth their products; changes the work, never the result."""

    def __init__(self):
        self.rest = [0] * len(SEGMENTS)

    def asked(self, level: int) -> bool:
        self.rest[level] -= 1
        return self.rest[level] < 0

    def saw(self, level: int, before: int, after: int) -> None:
        self.rest[level] = 0 if after <= (1 - WORTH) * before else REST


def _bounded(q_level, x_level) -> np.ndarray:
    """Upper bounds of the scores of a tile, a little above for rounding."""
    norms = np.linalg.norm(q_level, axis=1)[:, None] * np.linalg.norm(x_level, axis=1)[None, :]
    return q_level @ x_level.T + 1e-9 * norms + 1


def _search(best: _Best, q: np.ndarray, q_ids: np.ndarray, q_levels, x: np.ndarray, ids: np.ndarray, number,
            levels: _Levels) -> None:
    """Offer candidates x to all queries q of the same length; ``number`` are the queries' places in ``best``."""
    small = q.size and x.size and np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0 ** 53
    for low in range(0, len(x), BLOCK):
        part, part_ids = x[low:low + BLOCK], ids[low:low + BLOCK]
        x_levels = [_statistics(part, w) for w in SEGMENTS] if part.shape[1] else []
        for first in range(0, len(q), TILE):
            rows = slice(first, first + TILE)
            floor = best.floor[number[rows]][:, None]
            able = q_ids[rows][:, None] != part_ids[None, :]
            count = int(able.sum())
            for level, (q_level, x_level) in enumerate(zip(q_levels, x_levels)):
                if count <= FEW * able.size or not levels.asked(level):
                    continue
                able &= _bounded(q_level[rows], x_level) >= floor
                before, count = count, int(able.sum())
                levels.saw(level, before, count)
            if not count:
                continue
            if small and count > FEW * able.size:
                scores = q[rows] @ part.T  # whole numbers below 2^53: exact in any order
                scores[~able] = -np.inf
                able = scores >= np.maximum(floor, -2.0 ** 60)
                if able.sum() > 4 * best.k * len(scores) and scores.shape[1] > best.k:
                    able &= scores >= np.partition(scores, -best.k, axis=1)[:, [-best.k]]
                i, j = np.nonzero(able)
                best.add(number[rows][i], scores[i, j].astype(np.int64), part_ids[j])
                continue
            i, j = np.nonzero(able)
            for at in range(0, len(i), PAIRS):
                a, b = i[at:at + PAIRS], j[at:at + PAIRS]
                score = _exact(q[rows][a], part[b])
                kept = score >= best.floor[number[rows][a]]
                best.add(number[rows][a[kept]], score[kept], part_ids[b[kept]])


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~odd)


def _matrix(column: pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)
    return values[offsets[rows][:, None] + np.arange(length)[None, :]]


def _by_length(column: pa.Array):
    lengths = np.diff(np.asarray(column.offsets))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, whole_numbers(_matrix(column, rows, int(length)))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query.

    Components x count as floor(256 * x). Queries are the rows whose vec_id is
    divisible by ``every``; candidates are all rows with another vec_id and as
    many components. The score is the integer inner product (cut to 64 bits);
    ties go to the smaller vec_id. Rows with a NULL vec_id, a NULL vector or a
    NULL or non-finite component take no part. Rows that repeat a candidate's
    vec_id are candidates each; equal rows of a query's vec_id count as one query
    and different ones as several. Too few candidates give fewer rows.
    """
    rows = _usable(vectors, key, vector)
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    count, most = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    parts = max(1, math.ceil(count * max(most or 0, 1) * 16 / QUERY_BYTES))
    found = []
    for part in range(parts if count else 0):
        some = asked.filter(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(parts)) == part)
        queries = sorted((r.vec_id, tuple(r.vector)) for r in some.collect())
        if not queries:
            continue
        result = _batch(rows, queries, k)
        # Each batch is written once; the best of its queries are all it leaves.
        found.append(cut_lineage(_ranked(result, k)) if parts > 1 else _ranked(result, k))
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return functools.reduce(DataFrame.unionByName, found)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _batch(rows: DataFrame, queries: list, k: int) -> DataFrame:
    lengths: dict[int, list[int]] = {}
    for at, (_, vector) in enumerate(queries):
        lengths.setdefault(len(vector), []).append(at)
    packed = {n: (np.array(at), np.array([queries[a][0] for a in at], np.int64),
                  np.array([queries[a][1] for a in at], np.float64).reshape(len(at), n)) for n, at in lengths.items()}
    shared = rows.sparkSession.sparkContext.broadcast((len(queries), np.array([q[0] for q in queries], np.int64), packed))
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        number, names, groups = shared.value
        best, levels = _Best(number, k), _Levels()
        ready = {}
        for n, (at, q_ids, raw) in groups.items():
            q = whole_numbers(raw)
            ready[n] = (q, q_ids, [_statistics(q, w) for w in SEGMENTS] if n else [], at)
        for part in batches:
            ids = part.column(0).to_numpy()
            for length, at, x in _by_length(part.column(1)):
                if length in ready:
                    q, q_ids, q_levels, places = ready[length]
                    _search(best, q, q_ids, q_levels, x, ids[at], places, levels)
        yield batch(schema.names, [best.query, names[best.query], best.id, best.score], schema)
    return rows.mapInArrow(run, "query long, query_id long, vec_id long, score long")
