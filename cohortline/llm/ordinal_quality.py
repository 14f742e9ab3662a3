"""Quality grades by ordinal cumulative-link regression on hashed text.

P(grade >= g) = sigmoid(score - threshold_g): one score per text from weights that
all grades share, and ordered thresholds. The score adds up hashed weights of the
text's words (divided by the root of their number), of its runs of three character
classes (divided by their number), and of the share of words that repeat the word
before. A whole text is scored in one pass over its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import words
from cohortline.llm.inputs import batch, hashed_sample, steps, texts_of

#: Most ratings that the fit uses: those whose hashed doc_id is smallest.
RATINGS = 6000
WORD_SLOTS, SHAPE_SLOTS = 1 << 16, 1 << 12
SLOTS = WORD_SLOTS + SHAPE_SLOTS + 1
#: Scale of the shares beside the words.
SHARE = 10.0
#: Bytes of text that a run works on, as each takes about 100 bytes at work; a longer text is a run of its own.
RUN_BYTES = 1 << 18
ROUNDS, STEP, SHRINK = 300, 0.5, 1e-4


def _classes() -> np.ndarray:
    """A class for every byte: lower, upper, digit, space, line end, control, beyond ASCII, or its own."""
    kind = np.arange(256, dtype=np.uint64) + np.uint64(16)
    for value, members in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, 9), (10, 13),
                                     [*range(9), 11, 12, *range(14, 32), 127], range(128, 256))):
        kind[list(members)] = value
    return kind


CLASS = _classes()


@dataclass
class _Run:
    """Slots of some rows in turn: for each slot its row and value; ``first`` is their first row."""

    first: int
    rows: int
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # (row, slot, value)


def _runs(column: pa.Array):
    for first, last, data, offsets in steps(column, RUN_BYTES):
        n = last - first
        texts = column.slice(first, n)
        found = list(words.hashed_words(texts, words.LETTERED))
        hashes, counts = (np.concatenate([f[i] for f in found]) for i in (2, 3))
        row = np.repeat(np.arange(n), counts)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        repeats = SHARE * np.bincount(row[again], minlength=n) / np.maximum(counts, 1)
        parts = [(row, (hashes % np.uint64(WORD_SLOTS)).astype(np.int32), 1 / np.sqrt(counts[row])),
                 (np.arange(n), np.full(n, SLOTS - 1, np.int32), repeats)]
        if len(data) > 2:
            kind = CLASS[data]
            triple = words.mixed(kind[:-2] * np.uint64(1 << 18) + kind[1:-1] * np.uint64(512) + kind[2:])
            owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
            whole = owner[:-2] == owner[2:]
            owner = owner[:-2][whole]
            slot = (triple[whole] % np.uint64(SHAPE_SLOTS)).astype(np.int32) + np.int32(WORD_SLOTS)
            share = SHARE / np.maximum(np.bincount(owner, minlength=n), 1)
            parts.append((owner, slot, share[owner]))
        yield _Run(first, n, parts)


def _rated(batches):
    """(grade, slots, values) of each rated text, slots once each."""
    schema = pa.schema([("grade", pa.int32()), ("slots", pa.binary()), ("amounts", pa.binary())])
    for rows in batches:
        for run in _runs(rows.column(1)):
            row, slot, value = (np.concatenate([p[i] for p in run.parts]) for i in range(3))
            key, place = np.unique(row.astype(np.int64) * SLOTS + slot, return_inverse=True)
            amounts = np.bincount(place, value).astype(np.float32)
            cuts = np.searchsorted(key, np.arange(run.rows + 1) * SLOTS)
            slots = (key % SLOTS).astype(np.int32)
            yield batch(schema.names, [
                rows.column(0).slice(run.first, run.rows).cast(pa.int32()),
                [slots[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                [amounts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]], schema)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class GradeModel:
    """Shared weights and ordered thresholds for grades 0 .. len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, column: pa.Array):
        """(first row, scores) for runs of rows of a string column without NULLs."""
        for found in _runs(column):
            yield found.first, sum(np.bincount(row, self.weights[slot] * value, minlength=found.rows)
                                   for row, slot, value in found.parts)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= g) for each score and g = 1 .. G."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])

    def keep(self, docs: DataFrame, least: float, text: str = "text") -> DataFrame:
        """The rows of ``docs`` whose top grade has at least the chance ``least``, with all their columns."""
        shared = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            for rows in batches:
                if rows.num_rows:
                    column = pc.fill_null(rows.column(rows.schema.get_field_index(text)).cast(pa.large_string()), "")
                    score = np.concatenate([s for _, s in shared.value.scores(column)])
                    yield rows.filter(pa.array(shared.value.tails(score)[:, -1] >= least))
        return docs.mapInArrow(run, docs.schema)

    def grade(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, score, expected_grade, tail_1 .. tail_G), one row per row of ``docs``.

        tail_g is P(grade >= g). NULL and empty texts score 0; repeated rows are
        scored each; a NULL doc_id stays NULL; other columns are not read.
        """
        names = [f"tail_{g + 1}" for g in range(len(self.thresholds))]
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("expected_grade", pa.float64()),
                            *((n, pa.float64()) for n in names)])
        shared = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            for rows in batches:
                for first, score in shared.value.scores(rows.column(1)):
                    tails = shared.value.tails(score)
                    yield batch(schema.names, [rows.column(0).slice(first, len(score)), score,
                                               tails.sum(1), *(tails[:, g] for g in range(len(names)))], schema)
        return texts_of(docs, key, text).mapInArrow(
            run, "doc_id long, score double, expected_grade double, " + ", ".join(f"{n} double" for n in names))


def fit_grades(rated: DataFrame, grades: int, text: str = "text", grade: str = "grade") -> GradeModel:
    """Fit on texts with grades 0 .. ``grades`` - 1 (at most a few thousand rows).

    The rows reach the driver as slots, never as texts. Rows with a NULL grade or
    one out of range are left out; without any row all weights are 0.
    """
    schema = "grade int, slots binary, amounts binary"
    rows = (rated.filter(F.col(grade).between(0, grades - 1))
            .select(F.col(grade).cast("int").alias("grade"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInArrow(_rated, schema).collect())
    # the same numbers in the same order for any partitioning
    rows.sort(key=lambda r: (r.grade, bytes(r.slots), bytes(r.amounts)))
    y = np.array([r.grade for r in rows], np.int64)
    slots = [np.frombuffer(r.slots, np.int32) for r in rows]
    owner = np.repeat(np.arange(len(rows)), [len(s) for s in slots])
    slot = np.concatenate([*slots, np.zeros(0, np.int32)])
    value = np.concatenate([*(np.frombuffer(r.amounts, np.float32) for r in rows), np.zeros(0, np.float32)])
    weights, moments = np.zeros(SLOTS), np.full(SLOTS, 1e-8)
    cuts, cut_moments = np.linspace(-1, 1, grades - 1), np.full(grades - 1, 1e-8)
    for _ in range(ROUNDS if len(rows) else 0):
        score = np.bincount(owner, weights[slot] * value, minlength=len(rows))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        low = _sigmoid(score - edges[y])  # P(grade >= y)
        high = _sigmoid(score - edges[y + 1])  # P(grade > y)
        chance = np.maximum(low - high, 1e-9)
        gradient = np.bincount(slot, value * (1 - low - high)[owner], minlength=SLOTS) - SHRINK * len(rows) * weights
        pull = np.bincount(y, -low * (1 - low) / chance, minlength=grades)[1:]
        push = np.bincount(y, high * (1 - high) / chance, minlength=grades)[:-1]
        moments += gradient ** 2
        cut_moments += (pull + push) ** 2
        weights += STEP * gradient / np.sqrt(moments)
        cuts = np.sort(cuts + STEP * (pull + push) / np.sqrt(cut_moments))
    return GradeModel(weights, cuts)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Up to ``RATINGS`` texts with their grade: 0 bad, 1 good but toxic, 2 good.

    Labels without quality or doc_id are left out, a missing toxic mark counts
    as 0; labels of unknown documents give nothing. The labels are chosen by
    hash before the join, so what is sent to the tasks has at most that many rows; of
    a doc_id with several texts the first in code point order is rated.
    """
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    chosen = hashed_sample(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
                           .filter("doc_id is not null and quality is not null")
                           .select("doc_id", grade.alias("grade")), ["doc_id", "grade"], RATINGS)
    return (texts_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade")
            .agg(F.min("text").alias("text")).select("grade", "text"))


#: Least chance of the top grade that a selected document must have.
LEAST = 0.4


def quality(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """Fit on ``labels`` and grade every row of ``docs``: grade columns and ``selected``.

    A document is selected if P(grade = 2), the tail above the last threshold,
    is at least ``least``; so NULL and empty texts are judged by the thresholds alone.
    """
    model = fit_grades(graded(docs, labels), grades=3)
    return model.grade(docs).withColumn("selected", F.col("tail_2") >= least)


def good_documents(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that ``quality`` selects, with all their columns."""
    return fit_grades(graded(docs, labels), grades=3).keep(docs, least)
