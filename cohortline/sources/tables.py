"""Stored tables and the split hand-over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet by default, headered CSV on request; no row index is ever written."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Features, label and split in one table; each split is a partition folder.

    Replaces separate feature and label files matched by row position.
    """
    write_table(df, path, partition_by=[split_col])


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split; the filter prunes the other folders."""
    return spark.read.parquet(path).filter(F.col(split_col) == split)


def copy_splits(spark: SparkSession, source: str, target: str, split_col: str = "split") -> None:
    """Copy the split table between stores."""
    write_splits(spark.read.parquet(source), target, split_col)
