"""Headered CSV files whose headers differ."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortline.functions.markers import NULL_MARKERS, fold_markers
from cohortline.operators.columns import resolve_header
from cohortline.operators.union import union_sources


_EXTRA = "_cell_beyond_the_header"
# A quote inside quotes is written twice.
_QUOTES = {"quote": '"', "escape": '"'}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The header cells as written, before Spark's case-insensitive renaming."""
    first = spark.read.options(**_QUOTES, header=False).csv(path).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    return [cell if cell is not None else f"_c{i}" for i, cell in enumerate(first)]


def _read_as_text(spark: SparkSession, paths: str | list[str], names: Sequence[str],
                  markers: Sequence[str], multi_line: bool = False) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # One more column than the header has: a row that fills it has too many cells.
    wide = T.StructType([*schema, T.StructField(_EXTRA, T.StringType())])
    raw = spark.read.schema(wide).options(**_QUOTES, header=True, multiLine=multi_line, enforceSchema=True).csv(paths)
    too_many = F.raise_error(F.lit("a CSV row has more cells than its header")).cast("boolean")
    return raw.filter(F.when(F.col(_EXTRA).isNull(), F.lit(True)).otherwise(too_many)).select(
        *[fold_markers(f"`{n}`", markers).alias(n) for n in names])


def read_csv(spark: SparkSession, path: str,
             aliases: Mapping[str, Sequence[str]] | None = None,
             markers: Sequence[str] = NULL_MARKERS, multi_line: bool = False) -> DataFrame:
    """One source (a file, or a folder of files with one header) as text columns.

    Quotes inside quoted cells are doubled; a row with more cells than the header
    fails the job, one with fewer ends in NULLs. ``multi_line`` also reads line
    breaks inside quotes, at the price of one task per file.

    The schema is declared from the header line, so no inference pass reads the
    data; cells that mean "missing" become NULL.
    """
    names = resolve_header(read_header(spark, path), aliases or {})
    return _read_as_text(spark, path, names, markers, multi_line)


def read_csv_sources(spark: SparkSession, paths: Mapping[str, str],
                     aliases: Mapping[str, Sequence[str]],
                     markers: Sequence[str] = NULL_MARKERS) -> DataFrame:
    """Several named sources, each brought to the standard names, stacked by name."""
    return union_sources({name: read_csv(spark, path, aliases, markers)
                          for name, path in paths.items()})


def folder_headers(spark: SparkSession, pattern: str) -> dict[tuple[str, ...], list[str]]:
    """The files behind a glob by their header cells, from one job, however many files there are.

    The first line of a file is the first row of the piece that starts at its first
    byte, and that piece lies in one task, so the first row a task meets is it.
    Empty files have no header and are an error.
    """
    lines = spark.read.text(pattern).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.filter("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("line"))
    found = {r.file_path: r.line for r in first.collect()}
    one = lambda uri: re.sub(r"^(\w+):/+", r"\1:/", uri)  # noqa: E731  file:/x and file:///x are one file
    headed = {one(f) for f in found}
    without = sorted(f for f in lines.inputFiles() if one(f) not in headed)
    if without or not found:
        raise ValueError(f"no header in {without[0]}" if without else f"no file matches {pattern}")
    cells = {line: tuple(c if c is not None else f"_c{i}" for i, c in enumerate(row)) for line, row in _parsed(spark, found)}
    out: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(found):
        out.setdefault(cells[found[file]], []).append(file)
    return out


def _parsed(spark: SparkSession, found: Mapping[str, str]):
    """The cells of every different header line, parsed as Spark parses files."""
    for line in sorted(set(found.values())):
        yield line, spark.read.options(**_QUOTES, header=False).csv(spark.sparkContext.parallelize([line], 1)).first()


def read_csv_folder(spark: SparkSession, pattern: str,
                    aliases: Mapping[str, Sequence[str]],
                    markers: Sequence[str] = NULL_MARKERS) -> DataFrame:
    """Every CSV file behind a glob, whatever the order of its columns.

    A single read would match columns by position and mix files with different
    headers. One job reads all headers, then files that share a header are read
    together: jobs and plan grow with the number of distinct headers, not with the
    number of files.
    """
    frames = {
        f"header_{i}": _read_as_text(spark, group, resolve_header(list(header), aliases), markers)
        for i, (header, group) in enumerate(folder_headers(spark, pattern).items())
    }
    return union_sources(frames).drop("source")
