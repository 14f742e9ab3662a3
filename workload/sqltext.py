"""SQL fragments used by several queries."""

from __future__ import annotations


def bucket(key: str, buckets: int, salt: int | str = 42) -> str:
    """The hash bucket of a key expression."""
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', {key}, '{salt}')), 1, 8)) AS BIGINT) "
            f"% {buckets})")


def split_80_10_10(key: str) -> str:
    b = bucket(key, 10)
    return f"CASE WHEN {b} < 8 THEN 'train' WHEN {b} < 9 THEN 'val' ELSE 'test' END"


def split_80_20(key: str) -> str:
    return f"CASE WHEN {bucket(key, 10)} < 8 THEN 'train' ELSE 'test' END"


def draws(space: str, keys: str) -> str:
    """Recursive tables that end in ``drawn``: the drawn numbers of every row of ``space`` (keys, seed, total, most).

    Six rounds of a keyed permutation of left x right numbers, and again while the number is not below the total.
    """
    word = ("CAST('0x' || substr(md5(concat_ws('|', CAST(seed AS VARCHAR), CAST(k % 6 AS VARCHAR), "
            "CAST({0} AS VARCHAR))), 1, 8) AS BIGINT)")
    return f"""
sides AS (SELECT *, CAST(ceil(sqrt(CAST(total AS DOUBLE))) AS BIGINT) AS n_left FROM {space} WHERE total > 0),
areas AS (SELECT *, (total + n_left - 1) // n_left AS n_right FROM sides),
walk AS (
  SELECT {keys}, seed, total, n_left, n_right, draw, 0 AS k, draw // n_right AS l, draw % n_right AS r
  FROM (SELECT *, unnest(range(least(most, total))) AS draw FROM areas)
  UNION ALL
  SELECT {keys}, seed, total, n_left, n_right, draw, k + 1,
         CASE WHEN k % 2 = 0 THEN (l + {word.format('r')}) % n_left ELSE l END,
         CASE WHEN k % 2 = 1 THEN (r + {word.format('l')}) % n_right ELSE r END
  FROM walk WHERE k % 6 > 0 OR k = 0 OR l * n_right + r >= total),
drawn AS (SELECT {keys}, draw + 1 AS draw, l * n_right + r AS number FROM walk
          WHERE k > 0 AND k % 6 = 0 AND l * n_right + r < total)"""
