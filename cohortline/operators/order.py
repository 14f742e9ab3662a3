"""Seeded shuffle of all rows with a fresh row position."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortline.functions.keys import hash_hex
from cohortline.settings import cut_lineage

# Copies of one row that a task writes out by itself, and rows of one range.
_COPIES_PER_PIECE = 100_000
ROWS_PER_RANGE = 1_000_000


def seeded_shuffle(df: DataFrame, keys: Sequence[str] | None = None, salt: int | str = 42,
                   rows_per_range: int = ROWS_PER_RANGE, position_col: str = "position") -> DataFrame:
    """Number the rows 0..n-1 in the order of a salted hash of ``keys``.

    A plain ``row_number`` over the whole table would sort it in one task. Here the
    rows are dealt out once by ranges of the hash, whose edges Spark samples, sorted
    inside, and written down; a range's rows then start where the sizes of the ranges
    before it add up to. There are as many ranges as the rows need, and their sizes
    are all that reaches the driver. ``keys`` default to all columns.

    Equal rows are counted first and written out again, in pieces where they are
    many. Every copy but the first adds its number to the hash, so copies scatter and
    a row that makes up a third of the table fills no range.
    """
    columns = df.columns
    keys = list(keys or columns)
    counted = cut_lineage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")))
    rows, most = counted.agg(F.sum("_copies"), F.max("_copies")).first()
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((rows or 0) / rows_per_range))
    hashed = counted.withColumn("_hash", hash_hex(keys, salt))
    copies = hashed.filter(F.col("_copies") <= _COPIES_PER_PIECE).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
    if (most or 0) > _COPIES_PER_PIECE:
        start = F.col("_piece") * F.lit(_COPIES_PER_PIECE)
        last_piece = F.floor((F.col("_copies") - 1) / F.lit(_COPIES_PER_PIECE))
        copies = copies.unionByName(
            hashed.filter(F.col("_copies") > _COPIES_PER_PIECE)
            .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)))
            .repartition("_hash", "_piece")
            .withColumn("_copy", F.explode(F.sequence(
                start, F.least(F.col("_copies"), start + F.lit(_COPIES_PER_PIECE)) - F.lit(1)))).drop("_piece"))
    copies = copies.withColumn("_hash", F.when(F.col("_copy") == 0, F.col("_hash"))
                               .otherwise(F.md5(F.concat_ws("|", "_hash", "_copy"))))
    # A checkpoint keeps its partitions and their order, so both readings below see the same ranges.
    place = F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("double") * F.lit(ranges / 2.0 ** 32)).cast("int")
    dealt = cut_lineage(copies.repartitionById(ranges, place).sortWithinPartitions("_hash", *columns, "_copy")
                        .select(*columns)).withColumn("_row", F.monotonically_increasing_id())
    sizes = {r[0]: r[1] for r in dealt.groupBy(F.shiftright("_row", 33)).count().collect()}
    offsets, before = [], 0
    for part in range(max(sizes, default=-1) + 1):
        offsets.append(before)
        before += sizes.get(part, 0)
    start = F.array(*[F.lit(o).cast("bigint") for o in offsets or [0]])
    place = start[F.shiftright("_row", 33).cast("int")] + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.select(*columns, place.alias(position_col))
