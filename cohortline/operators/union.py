"""Stacking sources by column name."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack by name; a column a frame lacks is NULL there. No shuffle."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sources(frames: Mapping[str, DataFrame], source_col: str = "source") -> DataFrame:
    """Stack named sources and keep where each row came from."""
    return union_by_name([df.withColumn(source_col, F.lit(name)) for name, df in frames.items()])
