"""Allow and block rules for URLs by host suffix and path prefix.

Each URL is expanded into host suffixes joined with path prefixes, but only with
numbers of labels and path lengths that some rule has. Expressions meet the rules
by an equi-join on the first 32 bits of their digests; full digests confirm, and
the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most different label counts, and most different path lengths, that a set of rules may have.
SHAPES = 4096
#: Bytes of a digest by which expressions meet rules.
PREFIX = 4

#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) as columns; both empty for NULL or a URL without ``://``."""
    begin = F.locate("://", url)
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return (F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit("")))


def rule_frame(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def _prefix(expression: Column) -> Column:
    """The first ``PREFIX`` bytes of the digest."""
    return F.substring(_digest(expression), 1, PREFIX)


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's
    path. Of several, the longest host and path together wins, then the longer
    host, then block before allow. rule is host and path of that rule, NULL if
    none fits, and then the verdict is ``default``. Rules with a NULL or without
    a host fit nothing; a NULL url has an empty host and path; repeated rows are
    judged each. Other columns are not read.
    """
    known = (rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
                          F.col("verdict").alias("rule_verdict"))
             .filter("rule_host <> '' and rule_path is not null and rule_verdict is not null").distinct()
             .withColumn("rule", F.concat("rule_host", "rule_path"))
             .withColumn("prefix", _prefix(F.col("rule"))).withColumn("digest", _digest(F.col("rule"))))
    labels, lengths = (_shapes(known, c) for c in (F.size(F.split("rule_host", r"\.", -1)), F.length("rule_path")))
    host, path = split_url(F.col(url))
    rows = (pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
            .groupBy("page_id", "host", "path").agg(F.count("*").alias("rows")))
    parts = F.split("host", r"\.", -1)
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(parts)),
                           lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    spread = (rows.withColumn("expression", F.explode_outer(F.when(F.col("host") != "", expressions)))
              .withColumn("prefix", _prefix(F.col("expression"))))
    # the prefix alone is the key; what it brings together is confirmed by full digests afterwards
    met = spread.join(known, "prefix", "left")
    confirmed = F.col("rule").isNotNull() & (_digest(F.col("expression")) == F.col("digest"))
    best = F.max(F.when(confirmed, F.struct(
        F.length("rule").alias("length"), F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").alias("blocks"), F.col("rule"), F.col("rule_verdict"))))
    return (met.groupBy("page_id", "host", "path", "rows").agg(best.alias("best"))
            .withColumn("copy", F.explode(F.expr("sequence(1L, rows)")))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")))


def _shapes(rules: DataFrame, measure: Column) -> Column:
    found = [r[0] for r in rules.select(measure.alias("n")).distinct().limit(SHAPES + 1).collect()]
    if len(found) > SHAPES:
        raise ValueError(f"the rules have more than {SHAPES} label counts or path lengths")
    return F.array(*(F.lit(n) for n in sorted(found))) if found else F.array().cast("array<int>")
