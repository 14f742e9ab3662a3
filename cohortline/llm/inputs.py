"""What the operators share: reading tables, taking columns, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a task works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) alone, NULL texts as empty ones; other columns can't clash."""
    return docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one array, and its n + 1 offsets."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of at most ``most`` bytes: (first, last, bytes, offsets)."""
    if not len(column):
        return
    data, offsets = bytes_of(column)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def batch(names: list[str], columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type) for n, c in zip(names, columns)],
        schema=schema)


def hashed_sample(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Up to ``most`` distinct rows of (keys), those with the smallest hashes, whatever the partitioning.

    A bound on the hash, set from an estimate of the distinct rows (within a few
    hundredths), leaves about twice that many before they are ordered; so no task gets
    more than a few times ``most``, and rows that repeat change nothing.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 31))
    about = df.agg(F.approx_count_distinct(place, 0.02)).first()[0]
    bound = int(min(1.0, (2.0 * most + 50) / max(about, 1)) * (1 << 31))
    return df.filter(place < bound).distinct().orderBy(place, *keys).limit(most)
