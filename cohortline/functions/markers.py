"""Missing-value markers and casts that never fail on a bad cell."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The cell texts that mean "missing" when a CSV file is read.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Fixed value: the text that stands for an unknown answer in the diabetes files.
LABEL_PLACEHOLDER = "No Info"


def fold_markers(col: Column | str, markers: Iterable[str] = NULL_MARKERS) -> Column:
    """NULL where the text is one of ``markers``, else the text itself."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(~col.isin(*markers), col)


def to_number(col: Column | str) -> Column:
    """Double, or NULL where the text is no finite number (ANSI casts would fail the job)."""
    col = F.col(col) if isinstance(col, str) else col
    number = col.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def to_int(col: Column | str) -> Column:
    """Int through double, so that ``'1.0'`` reads as 1."""
    return to_number(col).try_cast("int")


def differs_from(col: Column | str, value) -> Column:
    """True unless equal; a NULL differs from every value, so its row is kept."""
    col = F.col(col) if isinstance(col, str) else col
    return ~col.eqNullSafe(F.lit(value))
