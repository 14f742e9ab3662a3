"""Hyper-parameter search as tables: space, grid, sampled trials, best trial.

A search space is one row per (task, method) whose bounds are text, as they
come from a parameter file. Everything up to the fits is a table job; only the
fits themselves are driven trial by trial, each a distributed job.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

# The parameters each method searches, and whether they are whole.
AXES = {
    "xgboost": (("lr", "learning_rate", "double"), ("ne", "n_estimators", "int")),
    "random_forest": (("ne", "n_estimators", "int"),),
    "knn": (("nn", "n_neighbors", "int"),),
    "lr": (("it", "iterators", "int"),),
}
METHODS = tuple(AXES)
PREFIXES = ("learning_rate", "n_estimators", "n_neighbors", "iterators")
BOUNDS = ("min", "max", "step")
COUNTS = ("max_trial_counts", "max_failed_trial_counts", "parallel_trial_counts")
SPACE_FIELDS = tuple(f"{p}_{b}" for p in PREFIXES for b in BOUNDS) + ("random_state",) + COUNTS

# The accuracy at which a search stops, and the seed when none is given.
GOAL = 0.99
DEFAULT_SEED = 42


def read_search_space(spark: SparkSession, path: str) -> DataFrame:
    """The parameter file: a JSON array with one object per method.

    Methods that are not searched are skipped; fields that are not used here
    are left out; all values are kept as text until they are checked.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("method",) + SPACE_FIELDS])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.filter(F.col("method").isin(*METHODS))


def _whole(column: str) -> Column:
    """The text as a whole number, or NULL ('1.5' and 'x' are none)."""
    text = F.trim(F.col(column))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text).try_cast("bigint")


def _bound(prefix: str, bound: str, kind: str) -> Column:
    column = f"{prefix}_{bound}"
    return _whole(column) if kind == "int" else F.trim(F.col(column)).try_cast("double")


def space_problems(space: DataFrame) -> DataFrame:
    """Add ``reason`` (NULL for a sound row) and the seed to use.

    Checked in order: all bounds given, bounds numeric, neighbours odd with an
    even step, step positive, seed whole, trial counts given and whole. A
    missing seed is the default one.
    """
    tests: list[tuple[Column, str]] = []
    for method, axes in AXES.items():
        mine = F.col("method") == method
        for _, prefix, kind in axes:
            names = [f"{prefix}_{b}" for b in BOUNDS]
            absent = F.lit(False)
            unreadable = F.lit(False)
            for b in BOUNDS:
                absent = absent | F.col(f"{prefix}_{b}").isNull()
                unreadable = unreadable | _bound(prefix, b, kind).isNull()
            tests.append((mine & absent, f"{prefix} needs min, max and step"))
            tests.append((mine & unreadable, f"{prefix} must be {kind}"))
            if prefix == "n_neighbors":
                low, high, step = (_whole(n) for n in names)
                odd = (F.pmod(low, F.lit(2)) == 1) & (F.pmod(high, F.lit(2)) == 1)
                tests.append((mine & ~(odd & (F.pmod(step, F.lit(2)) == 0)),
                              "n_neighbors must stay odd"))
            tests.append((mine & (_bound(prefix, "step", kind) <= 0),
                          f"{prefix} step must be positive"))
    tests.append((F.col("random_state").isNotNull() & _whole("random_state").isNull(),
                  "random_state must be int"))
    for c in COUNTS:
        tests.append((F.col(c).isNull(), f"{c} is missing"))
        tests.append((_whole(c).isNull(), f"{c} must be int"))
    chained = F
    for test, text in tests:
        chained = chained.when(test, F.lit(text))
    seed = F.coalesce(_whole("random_state"), F.lit(DEFAULT_SEED))
    return space.withColumns(
        {"reason": chained.otherwise(F.lit(None).cast("string")), "seed": seed})


def sound_space(space: DataFrame) -> DataFrame:
    """The checked space; an unsound row is an error that names its method."""
    checked = space_problems(space)
    bad = checked.filter(F.col("reason").isNotNull()).select("method", "reason").first()
    if bad is not None:
        raise ValueError(f"{bad.method}: {bad.reason}")
    return checked.drop("reason")


def _steps(prefix: str, kind: str) -> Column:
    """Indices 0..n of an axis; none if the maximum lies below the minimum."""
    low, high, step = (_bound(prefix, b, kind).cast("double") for b in BOUNDS)
    last = F.floor(F.try_divide(high - low, step) + F.lit(1e-9))
    return F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).otherwise(
        F.array().cast("array<bigint>"))


def trial_grid(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All trials of the sound rows: ``min + i * step`` per axis, axes combined.

    Both axes are exploded from the row that defines them: one narrow pass over
    the space for all methods, no join of axes and no union of methods. Columns
    of axes a method lacks are NULL.
    """
    sound = checked.filter(F.col("reason").isNull()) if "reason" in checked.columns else checked
    lacking = F.array(F.lit(None).cast("bigint"))
    axis = {"_rates": F, "_rate_low": F, "_rate_by": F, "_wholes": F, "_low": F, "_by": F}
    methods_of: dict[str, list[str]] = {}
    for method, axes in AXES.items():
        mine = F.col("method") == method
        for name, prefix, kind in axes:
            methods_of.setdefault(name, []).append(method)
            steps, low, by_ = (("_rates", "_rate_low", "_rate_by") if kind == "double"
                               else ("_wholes", "_low", "_by"))
            axis[steps] = axis[steps].when(mine, _steps(prefix, kind))
            axis[low] = axis[low].when(mine, _bound(prefix, "min", kind))
            axis[by_] = axis[by_].when(mine, _bound(prefix, "step", kind))
    for steps in ("_rates", "_wholes"):
        axis[steps] = axis[steps].otherwise(lacking)
    # The texts are read once per row of the space, below the explosion.
    read = sound.select(*by, "method", "seed", *COUNTS, *[c.alias(n) for n, c in axis.items()])
    whole = F.col("_low") + F.col("_whole") * F.col("_by")
    grid = (
        read.withColumn("_rate", F.explode("_rates")).withColumn("_whole", F.explode("_wholes"))
        .select(*by, "method", "seed", *COUNTS,
                F.round(F.col("_rate_low") + F.col("_rate") * F.col("_rate_by"), 10).alias("lr"),
                *[F.when(F.col("method").isin(*methods_of[n]), whole).alias(n)
                  for n in ("ne", "nn", "it")])
    )
    named = [F.concat(F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit("")))
             for n in ("ne", "nn", "it")]
    millionths = F.round(F.col("lr") * 1_000_000).cast("bigint").cast("string")
    return grid.withColumn("trial", F.concat_ws(
        ",", *named, F.concat(F.lit("lr="), F.coalesce(millionths, F.lit("")))))


#: Rounds of the permutation, and passes of it after which a number surely lies in the space.
_ROUNDS, _PASSES = 6, 40
#: Passes after the first one, in turns: each turn is only gone through by numbers that lie outside before it.
_AGAIN = (1, 3, _PASSES - 5)


def _permuted(drawn: DataFrame, number: str, seed: str, total: str, out: str) -> DataFrame:
    """Add where a keyed permutation of 0 .. total - 1 takes a number.

    The number is a pair (left, right) of about equal sides; each round adds a hash
    of one half to the other. The rectangle of pairs is larger than the space by
    less than one side, and a number outside it is permuted again: at most once per
    number outside, and as good as never more than a few times. So the first pass is
    plain columns, and only numbers it leaves outside go through the others.
    """
    l, r, m, n, t = (F.col(f"_p{c}") for c in "lrmnt")

    def word(k, half):
        text = F.concat_ws("|", F.col(seed).cast("string"), k.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

    rows = drawn.withColumns({"_pt": F.col(total), "_pm": F.ceil(F.sqrt(F.col(total).cast("double"))).cast("bigint")})
    rows = rows.withColumn("_pn", F.floor((t + m - 1) / m).cast("bigint"))
    rows = rows.withColumns({"_pl": F.floor(F.col(number) / n).cast("bigint"), "_pr": F.col(number) % n})
    for turn in range(_ROUNDS):
        half, other, side = ("_pl", r, m) if turn % 2 == 0 else ("_pr", l, n)
        rows = rows.withColumn(half, (F.col(half) + word(F.lit(turn), other)) % side)

    def step(at, k):
        turn = k % _ROUNDS
        going = F.when(turn == 0, at["l"] * n + at["r"] >= t).otherwise(at["going"])
        left = F.when(going & (turn % 2 == 0), (at["l"] + word(turn, at["r"])) % m).otherwise(at["l"])
        right = F.when(going & (turn % 2 == 1), (at["r"] + word(turn, at["l"])) % n).otherwise(at["r"])
        return F.struct(left.alias("l"), right.alias("r"), going.alias("going"))

    for passes in _AGAIN:
        again = F.aggregate(F.sequence(F.lit(0), F.lit(_ROUNDS * passes - 1)),
                            F.struct(l.alias("l"), r.alias("r"), F.lit(True).alias("going")), step)
        inside = F.struct(l.alias("l"), r.alias("r"), F.lit(False).alias("going"))
        rows = rows.withColumn("_pa", F.when(l * n + r < t, inside).otherwise(again))
        rows = rows.withColumns({"_pl": F.col("_pa")["l"], "_pr": F.col("_pa")["r"]})
    return rows.withColumn(out, l * n + r).drop("_pl", "_pr", "_pm", "_pn", "_pt", "_pa")


def draw_trials(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A seeded random draw of ``max_trial_counts`` trials per (task, method), without their grid.

    Trials are numbered rate by rate; draw i is the number that a keyed permutation
    of all numbers takes i to. So a space of any size (up to 2^52 combinations) costs
    as many rows as trials are drawn, and the same seed gives the same trials
    anywhere. ``trial`` is the number as text; columns of axes a method lacks are NULL.
    """
    sound = checked.filter(F.col("reason").isNull()) if "reason" in checked.columns else checked
    axis = {"_rates": F, "_rate_low": F, "_rate_by": F, "_wholes": F, "_low": F, "_by": F}
    methods_of: dict[str, list[str]] = {}
    for method, axes in AXES.items():
        mine = F.col("method") == method
        for name, prefix, kind in axes:
            methods_of.setdefault(name, []).append(method)
            names = ("_rates", "_rate_low", "_rate_by") if kind == "double" else ("_wholes", "_low", "_by")
            low, high, by_ = (_bound(prefix, b, kind) for b in BOUNDS)
            count = F.greatest(F.floor(F.try_divide((high - low).cast("double"), by_.cast("double")) + F.lit(1e-9)) + 1, F.lit(0))
            for column, value in zip(names, (count.cast("bigint"), low, by_)):
                axis[column] = axis[column].when(mine, value)
    # A method without rates has one, which stands for none.
    read = sound.select(*by, "method", "seed", *COUNTS, *[
        F.coalesce(c.otherwise(None), F.lit(1).cast("bigint")).alias(n) if n in ("_rates", "_wholes") else c.otherwise(None).alias(n)
        for n, c in axis.items()])
    read = read.withColumn("_total", F.col("_rates") * F.col("_wholes"))
    most = F.least(F.col("max_trial_counts").cast("bigint"), F.col("_total"))
    drawn = _permuted(read.filter("_total > 0").filter(most > 0)
                      .withColumn("_draw", F.explode(F.sequence(F.lit(0).cast("bigint"), most - 1))),
                      "_draw", "seed", "_total", "_number")
    rate = F.floor(F.col("_number") / F.col("_wholes")).cast("bigint")
    whole = F.col("_low") + (F.col("_number") % F.col("_wholes")) * F.col("_by")
    return drawn.select(
        *by, "method", "seed", *COUNTS, F.round(F.col("_rate_low") + rate * F.col("_rate_by"), 10).alias("lr"),
        *[F.when(F.col("method").isin(*methods_of[n]), whole).cast("bigint").alias(n) for n in ("ne", "nn", "it")],
        F.col("_number").cast("string").alias("trial"), (F.col("_draw") + 1).alias("draw"))


def best_trial(trials: DataFrame, by: Sequence[str] = (), params: Sequence[str] = ("trial",),
               order: str = "trial") -> DataFrame:
    """Per (task, method) the trial of highest accuracy, the first in ``order`` on ties.

    One aggregate with map-side combine instead of sorting each group. The
    accuracy is negated rather than the order, which may be text.
    """
    scored = trials.filter(F.col("accuracy").isNotNull())
    row = F.struct(*dict.fromkeys([*params, "accuracy"]))
    best = scored.groupBy(*by, "method").agg(
        F.min_by(row, F.struct((-F.col("accuracy")).alias("cost"), order)).alias("best"))
    return best.select(*by, "method", "best.*")


@dataclass(frozen=True)
class TrialResult:
    trial: str
    params: dict
    accuracy: float | None
    error: str | None = None


def run_trials(spark: SparkSession, trials: Sequence[dict], objective: Callable[[dict], float],
               parallel: int = 1, goal: float = GOAL, max_failed: int = 0) -> list[TrialResult]:
    """Score trials until one reaches the goal or more than ``max_failed`` fail.

    Each objective call is a distributed fit; up to ``parallel`` run at once, and the
    next one starts as soon as one ends. The jobs of a trial carry a tag of its own: at
    the goal, or after too many failures, the jobs of the trials still running are
    cancelled and their results left out. A failed trial is recorded and does not
    stop the search by itself.
    """
    sc = spark.sparkContext
    search = uuid.uuid4().hex
    stopping = threading.Event()

    def attempt(number: int, params: dict) -> TrialResult | None:
        sc.addJobTag(f"{search}-{number}")
        try:
            if stopping.is_set():
                return None
            return TrialResult(params["trial"], params, float(objective(params)))
        except Exception as problem:  # a trial may fail for any reason
            return TrialResult(params["trial"], params, None, str(problem))
        finally:
            sc.removeJobTag(f"{search}-{number}")

    done: list[TrialResult] = []
    waiting = list(enumerate(trials))[::-1]
    running: dict = {}
    problem = None
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        while waiting or running:
            while waiting and len(running) < max(1, parallel):
                number, params = waiting.pop()
                running[pool.submit(inheritable_thread_target(spark)(attempt), number, dict(params))] = number
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            # Those that ended together count in the order in which they were drawn.
            for job in sorted(ended, key=running.__getitem__):
                del running[job]
                done.append(job.result())
            failed = [r.error for r in done if r.error is not None]
            if len(failed) > max_failed:
                problem = f"{len(failed)} trials failed, the last: {failed[-1]}"
            if problem or any(r.accuracy is not None and r.accuracy >= goal for r in done):
                stopping.set()
                # A trial between two jobs has none to cancel, so its tag is cancelled until it has ended.
                while wait(running, timeout=0.1).not_done:
                    for number in running.values():
                        sc.cancelJobsWithTag(f"{search}-{number}")
                break
    if problem:
        raise RuntimeError(problem)
    return done


TRIALS_SCHEMA = T.StructType([
    T.StructField("method", T.StringType(), False), T.StructField("trial", T.StringType(), False),
    T.StructField("lr", T.DoubleType()), T.StructField("ne", T.LongType()),
    T.StructField("nn", T.LongType()), T.StructField("it", T.LongType()),
    T.StructField("accuracy", T.DoubleType()), T.StructField("error", T.StringType()),
])


def trials_table(spark: SparkSession, results: dict[str, list[TrialResult]]) -> DataFrame:
    """The finished trials of all methods as a table."""
    rows = [(method, r.trial, *[r.params.get(n) for n in ("lr", "ne", "nn", "it")],
             r.accuracy, r.error) for method, found in results.items() for r in found]
    return spark.createDataFrame(rows, TRIALS_SCHEMA)
