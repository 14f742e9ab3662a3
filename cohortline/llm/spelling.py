"""Spelling variants: words one edit apart, found over a reduced alphabet.

1. Maximal runs of letters are counted over all texts; the words kept are long and
   frequent enough.
2. Letters are hashed to ``SYMBOLS`` symbols. Two words one edit apart have reduced
   words that are equal or one edit apart, so every reduced word generates its full
   one-edit neighbourhood (itself, all deletions, replacements and insertions), as
   64-bit polynomial hashes that prefix and suffix sums give one by one.
3. The neighbourhoods are joined with the reduced vocabulary by hash. A bitmap of
   fixed size holds the reduced vocabulary and rules out most neighbours before the
   shuffle; where it is full it only rules out fewer.
4. The words behind the pairs that remain are compared as they are written, so that
   collisions of symbols or hashes add work but no result.
5. A word points to its most frequent near word, if that is at least twice as
   frequent; pointers are doubled until every word has its root.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.inputs import batch, steps
from cohortline.settings import cut_lineage

LETTERS_LEAST, TIMES_LEAST, RATIO = 5, 3, 2
#: One run in so many, by its hash, loses a letter before it is counted.
TYPO_EVERY = 97
SYMBOLS = 16
#: Bits of the vocabulary's bitmap (16 MB); all that is broadcast.
BITMAP_BITS = 27
#: Neighbours that are generated at a time in a task.
CHUNK = 1 << 20

# Bytes of a UTF-8 text: letters in lower case, the lead byte of U+00C0 to U+00FF, all else a blank.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0xC3] = 0xC3

#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
CODES = np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 63, SYMBOLS, dtype=np.uint64)


def letter_runs(data: np.ndarray) -> bytes:
    """UTF-8 bytes with A-Z in lower case and every byte that is in no run turned into a blank."""
    out = _LETTER[data]
    after = np.flatnonzero(data == 0xC3) + 1
    out[after] = data[after]
    return out.tobytes()


def with_typo(run: bytes, prefix: int, every: int = TYPO_EVERY) -> bytes:
    """The run, or the run without one code point, as its hash with its document's prefix says."""
    h = zlib.crc32(run, prefix)
    if h % every:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) over all texts, sums per batch before the shuffle."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        for rows in batches:
            found: Counter = Counter()
            ids = rows.column(0).to_pylist()
            for first, last, data, offsets in steps(rows.column(1)):
                raw, edges = letter_runs(data), offsets.tolist()
                for row in range(first, last):
                    prefix = zlib.crc32(f"{ids[row]}:".encode())
                    for word, n in Counter(raw[edges[row - first]:edges[row - first + 1]].split()).items():
                        found[with_typo(word, prefix)] += n
            found.pop(b"", None)
            yield batch(schema.names, [pa.array(list(found), pa.binary()).cast(pa.string()), list(found.values())], schema)

    named = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc_id"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def symbols_of(points: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol of every code point."""
    return ((points.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(7)).astype(np.int64) % symbols


def powers(n: int) -> np.ndarray:
    """1, BASE, BASE^2 .. modulo 2^64."""
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def reduced_hash(reduced: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the rows of a matrix of symbols, one reduced word per row."""
    return (CODES[reduced] * powers(reduced.shape[1] + 1)[:-1]).sum(axis=1, dtype=np.uint64)


def neighbourhood(word: np.ndarray, low: int, high: int) -> np.ndarray:
    """Hashes of the one-edit neighbours of one reduced word, edits at places low .. high - 1 of 0 .. length."""
    n = len(word)
    power = powers(n + 1)
    terms = CODES[word] * power[:-1]
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    whole = before[-1]
    at = np.arange(low, min(high, n))
    spot = np.arange(low, high)
    deleted = before[at] + (whole - before[at + 1]) * np.uint64(BASE_INVERSE)
    replaced = (whole - terms[at])[:, None] + CODES[None, :] * power[at][:, None]
    inserted = (before[spot] + (whole - before[spot]) * np.uint64(BASE))[:, None] + CODES[None, :] * power[spot][:, None]
    return np.concatenate([deleted, replaced.ravel(), inserted.ravel()])


def neighbourhoods(reduced: np.ndarray) -> np.ndarray:
    """The same of many reduced words of one length, whole, one row of hashes per word."""
    n = reduced.shape[1]
    power = powers(n + 1)
    terms = CODES[reduced] * power[:-1]
    before = np.concatenate([np.zeros((len(reduced), 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    whole = before[:, -1:]
    deleted = before[:, :-1] + (whole - before[:, 1:]) * np.uint64(BASE_INVERSE)
    replaced = (whole - terms)[:, :, None] + (CODES[None, :] * power[:-1][:, None])[None]
    inserted = (before + (whole - before) * np.uint64(BASE))[:, :, None] + (CODES[None, :] * power[:, None])[None]
    m = len(reduced)
    return np.concatenate([whole, deleted, replaced.reshape(m, -1), inserted.reshape(m, -1)], axis=1)


def _by_length(words: list[str]):
    """Reduced words as matrices of one length each, bounded in size."""
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    for n, same in groups.items():
        most = max(1, CHUNK // ((2 * SYMBOLS + 1) * (n + 1)))
        for begin in range(0, len(same), most):
            part = same[begin:begin + most]
            points = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), n)
            yield part, symbols_of(points)


def with_reduced(words: DataFrame) -> DataFrame:
    """Add ``reduced``, the hash of the reduced word, and ``shape``, the reduced word itself."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("shape", pa.binary()), ("reduced", pa.int64())])

    def run(batches):
        for rows in batches:
            times = dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
            for part, reduced in _by_length(list(times)):
                flat = reduced.astype(np.uint8)
                yield batch(schema.names, [part, [times[w] for w in part], [r.tobytes() for r in flat],
                                           pa.array(reduced_hash(reduced).view(np.int64))], schema)

    return words.select("word", "n").mapInArrow(run, "word string, n long, shape binary, reduced long")


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for every value modulo 2^bits; words of 64 bits come from a sum per word, at most 2^(bits - 6) of them."""
    place = F.col("reduced").bitwiseAND(F.lit((1 << bits) - 1))
    found = (hashes.groupBy(F.shiftright(place, 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(reduced & 63 as int))")).alias("bits")).toPandas())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def near_shapes(words: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """(source, target): hashes of reduced words of ``words`` that are equal or one edit apart, each pair once a side."""
    shapes = words.select("shape", "reduced").distinct()
    hashes = shapes.select("reduced").distinct()
    shared = words.sparkSession.sparkContext.broadcast(_bitmap(hashes, bits))
    schema = pa.schema([("source", pa.int64()), ("target", pa.int64())])

    def likely(found, own):
        place = found & np.uint64((1 << bits) - 1)
        return found != own, (shared.value[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def run(batches):
        for rows in batches:
            groups: dict[int, list[bytes]] = {}
            for shape in rows.column(0).to_pylist():
                groups.setdefault(len(shape), []).append(shape)
            for n, same in groups.items():
                most = CHUNK // ((2 * SYMBOLS + 1) * (n + 1))
                if most:
                    for begin in range(0, len(same), most):
                        part = same[begin:begin + most]
                        made = neighbourhoods(np.frombuffer(b"".join(part), np.uint8).reshape(len(part), n))
                        own = made[:, :1]
                        other, inside = likely(made, own)
                        at = np.nonzero(other & inside)
                        yield batch(schema.names, [pa.array(own[at[0], 0].view(np.int64)),
                                                   pa.array(made[at].view(np.int64))], schema)
                    continue
                for shape in same:  # a very long word: some places at a time
                    word = np.frombuffer(shape, np.uint8)
                    own = reduced_hash(word[None])[0]
                    step = max(1, CHUNK // (2 * SYMBOLS + 1))
                    for low in range(0, n + 1, step):
                        made = neighbourhood(word, low, min(low + step, n + 1))
                        other, inside = likely(made, own)
                        made = made[other & inside]
                        yield batch(schema.names, [pa.array(np.full(len(made), own).view(np.int64)),
                                                   pa.array(made.view(np.int64))], schema)

    found = shapes.select("shape").mapInArrow(run, "source long, target long").distinct()
    apart = found.join(hashes.select(F.col("reduced").alias("target")), "target", "left_semi")
    return apart.select("source", "target").unionByName(
        hashes.select(F.col("reduced").alias("source"), F.col("reduced").alias("target")))


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns one word into the other, in time linear in them."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[same + 1:] == (b[same + 1:] if len(a) == len(b) else b[same:])


def near_words(words: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words exactly one edit apart; ``words`` is (word, n, shape, reduced)."""
    own = words.select("word", F.col("reduced").alias("source"))
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("reduced").alias("target"))
    pairs = near_shapes(words, bits).join(own, "source").join(other, "target")

    def run(batches):
        for rows in batches:
            kept = [one_edit(a, b) for a, b in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())]
            yield rows.filter(pa.array(kept, pa.bool_()))

    return pairs.filter("word <> near").select("word", "near", "near_n").mapInArrow(
        run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): forms followed to the last, by pointer doubling.

    A form is at least twice as frequent as its word, so chains are short and have
    no circles. Words without a form are no rows.
    """
    done = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = done.select(F.col("word").alias("root"), F.col("root").alias("further"))
        done = cut_lineage(done.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if done.filter("moved").isEmpty():
            return done.select("word", "root")
        done = done.select("word", "root")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITMAP_BITS) -> DataFrame:
    """One row per word of at least five letters and three occurrences: word, form, root, n, n_near, form_n.

    NULL and empty texts hold no words; the rows of a NULL doc_id count as those of
    the empty name; repeated rows count each. Very long texts and words are worked
    on whole. An empty table gives no rows. Other columns are not read. ``bits``
    changes the work, never the result.
    """
    words = cut_lineage(with_reduced(counted_words(docs, key, text).filter(
        (F.col("n") >= TIMES_LEAST) & (F.char_length("word") >= LETTERS_LEAST))))
    # The largest count first, then the first in code point order.
    best = near_words(words, bits).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("cost"), "near")).alias("best"))
    frequent = -F.col("best.cost") >= RATIO * F.col("n")
    judged = cut_lineage(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.cost")).alias("form_n")))
    ends = roots(judged.filter("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
