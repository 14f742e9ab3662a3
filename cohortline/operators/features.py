"""Feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F


def assembler(columns: Sequence[str], output: str = "features",
              on_missing: str = "error") -> VectorAssembler:
    """Vector of the columns; a NULL is an error unless ``on_missing="skip"``."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=on_missing)


def split_features(df: DataFrame, label: str, features: Sequence[str],
                   keep: Sequence[str] = (), on_missing: str = "error") -> DataFrame:
    """Bookkeeping columns, feature vector and label side by side in one row."""
    assembled = assembler(features, on_missing=on_missing).transform(df)
    return assembled.select(*keep, "features", F.col(label).cast("double").alias("label"))


def point(columns: Sequence[str]) -> Column:
    """The features of a row as an array of doubles; a missing one is an error."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return F.when(~missing, values).otherwise(
        F.raise_error(F.lit("a feature is missing")).cast("array<double>"))
