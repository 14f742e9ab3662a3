"""Row keys and reproducible hashes.

md5 of text gives the same value on every engine and for every partitioning,
unlike ``rand`` or ``randomSplit``, whose result follows the file layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_SEP = "|"


def hash_hex(keys: Sequence[str], salt: int | str = 42) -> Column:
    """32 hex digits from the key columns and a salt; NULL keys read as ''."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(_SEP, *parts, F.lit(str(salt))))


def hash_fraction_bucket(keys: Sequence[str], buckets: int, salt: int | str = 42) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the hash."""
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    head = F.conv(F.substring(hash_hex(keys, salt), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")


def row_key(columns: Sequence[str]) -> Column:
    """A key from the content of a row, for tables without one.

    Copies of a row share the key, hence the split: a copy never sits in both
    train and test.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("␀")) for c in columns]
    return F.md5(F.concat_ws("␟", *parts))
