"""Reproducible splits from a hash of the row key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortline.functions.keys import hash_fraction_bucket

# Shares in tenths of the rows.
TRAIN_VAL_TEST = {"train": 8, "val": 1, "test": 1}
TRAIN_TEST = {"train": 8, "test": 2}


def with_split(df: DataFrame, keys: Sequence[str], shares: Mapping[str, int] = TRAIN_VAL_TEST,
               salt: int | str = 42, split_col: str = "split") -> DataFrame:
    """Add the split name. Narrow: no shuffle, no sort.

    The result depends on key and salt only, so it is the same for any number
    of partitions and after a lost executor.
    """
    if any(n < 0 for n in shares.values()) or sum(shares.values()) < 1:
        raise ValueError(f"bad shares {dict(shares)}")
    bucket = hash_fraction_bucket(keys, sum(shares.values()), salt)
    # One name per bucket, so the hash is computed once per row.
    names = F.array(*[F.lit(name) for name, share in shares.items() for _ in range(share)])
    return df.withColumn(split_col, names[bucket])
