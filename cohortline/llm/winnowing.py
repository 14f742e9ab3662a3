"""Document fingerprints by winnowing, in DataFrame functions alone.

A text's units are its lower-cased runs of up to 16 non-space characters. In longer
runs, and in those that hold letters of a script written without spaces, every code
point is a unit, so that a shared passage has the same units wherever it begins.
Rolling hashes of five units come from three shifted products modulo a prime,
minima of eight neighbouring hashes from three shifted comparisons. Hash and
position travel in one number whose order puts the smallest hash first and the
rightmost position first among equals. Any shared run of twelve units puts at
least one shared hash into both fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.inputs import texts_of

GRAM, WINDOW = 5, 8
PRIME = (1 << 31) - 1
BASE = 1_000_003
#: Scripts that are written without spaces between words.
UNSPACED = "".join(rf"\p{{Is{name}}}" for name in (
    "Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
UNIT = rf"(?<!\S)[\S&&[^{UNSPACED}]]{{1,16}}(?!\S)|\S"
_LOW = PRIME  # positions count down from here, in the low 31 bits


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _joined(left: Column, right: Column, count: Column, factor: int) -> Column:
    """(left * factor + right) modulo the prime for the first ``count`` places."""
    return F.zip_with(F.slice(left, 1, count), F.slice(right, 1, count), lambda a, b: (a * factor + b) % PRIME)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the selected (hash, position) numbers of ``text`` from left to right."""
    t = {k: f"_{out}_{k}" for k in ("units", "two", "four", "grams", "m1", "m2", "m4")}
    count = lambda less: F.greatest(F.size(t["units"]) - less, F.lit(0))
    df = df.withColumn(t["units"], F.transform(F.regexp_extract_all(F.lower(text), F.lit(UNIT), F.lit(0)),
                                               lambda u: F.pmod(F.xxhash64(u), F.lit(PRIME))))
    df = df.withColumn(t["two"], _joined(F.col(t["units"]), _shifted(F.col(t["units"]), 1), count(1), BASE))
    df = df.withColumn(t["four"], _joined(F.col(t["two"]), _shifted(F.col(t["two"]), 2), count(3),
                                          BASE * BASE % PRIME))
    whole = F.aggregate(t["units"], F.lit(0).cast("long"), lambda all_, u: (all_ * BASE + u) % PRIME)
    grams = F.when(F.size(t["units"]) >= GRAM,
                   _joined(F.col(t["four"]), _shifted(F.col(t["units"]), 4), count(4), BASE)) \
        .when(F.size(t["units"]) > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(t["m1"], F.transform(grams, lambda h, i: F.shiftleft(h, 31) + (_LOW - i)))
    for width, name, then in ((1, "m1", "m2"), (2, "m2", "m4"), (4, "m4", "grams")):
        df = df.withColumn(t[then], F.zip_with(F.col(t[name]), _shifted(F.col(t[name]), width),
                                               lambda a, b: F.least(a, b)))
    windows = F.slice(t["grams"], 1, F.greatest(F.size(t["grams"]) - (WINDOW - 1), F.lit(1)))
    return df.withColumn(out, F.array_distinct(windows)).drop(*t.values())


def written(selected: Column) -> Column:
    """``position:hash`` of every selected gram, comma-joined; positions count units, hashes are hexadecimal."""
    return F.array_join(F.transform(selected, lambda x: F.concat(
        (F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW))).cast("string"), F.lit(":"), F.lower(F.hex(F.shiftright(x, 31))))), ",")


def hashes(selected: Column) -> Column:
    return F.array_distinct(F.transform(selected, lambda x: F.shiftright(x, 31)))


def likeness(left: Column, right: Column) -> Column:
    """Shared share of two hash sets; two empty ones are alike."""
    common = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - common
    return F.when(either == 0, 1.0).otherwise(common / either)


def _run_firsts(rows: DataFrame) -> list[float]:
    """First keys of runs of neighbouring keys: several runs for each shuffle partition, no more."""
    parts = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sorted(set(rows.stat.approxQuantile("_key", [i / parts for i in range(parts)], 0.25 / parts)))


def _run_of(firsts: list[float]) -> Column:
    """Number of the last of ``firsts`` not above the key, found in two steps of the root of their number."""
    step = max(1, int(len(firsts) ** 0.5))
    groups = [firsts[i:i + step] for i in range(0, len(firsts), step)]

    def upto(numbers: Column) -> Column:
        return F.greatest(F.size(F.filter(numbers, lambda x: x <= F.col("_key"))), F.lit(1))

    def array(numbers: list[float]) -> Column:
        return F.array(*(F.lit(float(x)) for x in numbers))
    group = upto(array([g[0] for g in groups]))
    return (group - 1) * step + upto(F.element_at(F.array(*(array(g) for g in groups)), group)) - 1


def laid_out(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows (doc_id, text) with ``_extra``, and the window in which the next row is the next document.

    Ids are cut into runs of neighbours, each in one task together with a copy
    of the first row of the following run (``_extra``), the first run following
    the last. Only the runs' first ids reach the driver.
    """
    # a NULL id comes before all others; ids that are one double stay together
    rows = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("double"), F.lit(-(2.0 ** 63))))
    firsts = _run_firsts(rows)
    frame = docs.sparkSession.createDataFrame(
        [(k, (i - 1) % len(firsts)) for i, k in enumerate(firsts)], "_first double, _run int")
    heads = (rows.join(F.broadcast(frame), F.col("_key") == F.col("_first")).groupBy("_key", "_run")
             .agg(F.min(F.struct("doc_id", "text")).alias("head"))
             .select("head.doc_id", "head.text", "_key", "_run", F.lit(True).alias("_extra")))
    own = rows.withColumn("_run", (_run_of(firsts) if firsts else F.lit(0)).cast("int"))
    laid = own.withColumn("_extra", F.lit(False)).unionByName(heads).repartition("_run")
    return laid, Window.partitionBy("_run").orderBy("_extra", "_key", "doc_id", "text")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: fingerprints of the text and of its edited text, and their likeness.

    The edited text keeps the first half and ends with as many code points (or
    all) of the next document by doc_id, the first after the last. NULL texts
    count as empty and have an empty fingerprint; a text of fewer than five units
    has one hash, of all of them. A NULL doc_id comes first, rows that repeat a
    doc_id follow each other by text. Other columns are not read. A task holds
    one text and its hashes at a time, about 100 bytes per unit.
    """
    laid, order = laid_out(texts_of(docs, key, text))
    own = with_fingerprint(laid, "text", "fp")
    n = F.length("text").cast("long")
    half = F.floor(F.length("text") / 2).cast("int")
    both = (own.withColumn("next_text", F.lead("text").over(order)).withColumn("next_fp", F.lead("fp").over(order))
            .filter(~F.col("_extra"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                                           F.substring("next_text", F.lit(1), half)))
            .select("doc_id", n.alias("n_chars"), "fp", "next_fp", "edited"))
    return with_fingerprint(both, "edited", "edited_fp").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("fp")).alias("fingerprint"), written(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(hashes(F.col("fp")), hashes(F.col("edited_fp"))).alias("near_edited"),
        likeness(hashes(F.col("fp")), hashes(F.col("next_fp"))).alias("near_next"))
