"""Renames and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def resolve_header(header: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> list[str]:
    """New names for a header: per standard name the first alias present wins.

    Matching is case-sensitive and each step sees the renames before it. Names
    that Spark could not tell apart afterwards (same letters, other case) get a
    numbered suffix; the standard names are kept for the chosen columns.
    """
    names = list(header)
    chosen: set[int] = set()
    for standard, candidates in aliases.items():
        for candidate in candidates:
            if candidate in names:
                at = names.index(candidate)
                names[at] = standard
                chosen.add(at)
                break
    taken = {names[i].lower() for i in chosen}
    for i, name in enumerate(names):
        if i in chosen:
            continue
        unique, n = name, 2
        while unique.lower() in taken:
            unique, n = f"{name}__{n}", n + 1
        names[i] = unique
        taken.add(unique.lower())
    return names


def rename_by_alias(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Bring a frame to standard names; columns without an alias pass through."""
    return df.toDF(*resolve_header(df.columns, aliases))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in the listed order."""
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All but the listed columns; a listed column that is missing is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*columns)


def move_to_front(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """The named columns first, the others after them in their old order."""
    return df.select(*front, *[c for c in df.columns if c not in front])


def feature_columns(df: DataFrame, label: str, not_features: Sequence[str] = ()) -> list[str]:
    """Every column but the label and the named bookkeeping columns."""
    return [c for c in df.columns if c != label and c not in not_features]
