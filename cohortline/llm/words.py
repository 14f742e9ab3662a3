"""Word and shingle hashes of texts, whole Arrow columns at a time.

Words are runs of bytes other than space and 09-0D; A-Z count as a-z. A word's
hash is a polynomial over its bytes modulo 2^64, finished by a bit mixer, so two
different words or shingles agree with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cohortline.llm.inputs import STEP_BYTES, steps

BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = {"table": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd multipliers."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * BASE + np.uint64(seed)) | np.uint64(1)


def _powers(length: int) -> np.ndarray:
    if len(_POWERS["table"]) < length:
        table = np.full(max(length, 64), BASE, np.uint64)
        table[0] = 1
        _POWERS["table"] = np.multiply.accumulate(table)
    return _POWERS["table"]


#: Bytes that words are made of: all but space and 09-0D; or ASCII letters, digits and what lies beyond ASCII.
SPACED = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
LETTERED = np.array([b > 127 or chr(b).isalnum() for b in range(256)])


def _hashes(data: np.ndarray, cuts: np.ndarray, bytes_in: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each word, its hash); a word also ends at each of ``cuts``."""
    inside = bytes_in[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at = cuts[cuts < len(data)]
    opens[at] = inside[at]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    # In place and with narrow numbers: some 30 bytes at work per byte of text.
    place = np.cumsum(opens, dtype=np.int32)
    np.maximum(place, 1, out=place)
    place -= 1
    place = np.arange(len(data), dtype=np.int32) - starts.astype(np.int32)[place]
    outside = ~inside
    place[outside] = 0
    terms = data.astype(np.uint64)
    terms[(data >= 65) & (data <= 90)] += np.uint64(32)
    terms += np.uint64(1)
    terms *= _powers(int(place.max()) + 1)[place]
    terms[outside] = 0
    return starts, mixed(np.add.reduceat(terms, starts))


def hashed_words(column: pa.Array, bytes_in: np.ndarray = SPACED,
                 most: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, word hashes, words per row) for runs of rows of a string column, of at most ``most`` bytes."""
    for first, last, data, offsets in steps(column, most):
        if len(data) <= 2 * STEP_BYTES:
            starts, hashes = _hashes(data, offsets[:-1], bytes_in)
            yield first, last, hashes, np.diff(np.searchsorted(starts, offsets))
            continue
        parts, begin = [], 0  # one long text: piece by piece, cut where a word ends
        while begin < len(data):
            end = min(begin + STEP_BYTES, len(data))
            while end < len(data):
                gaps = np.flatnonzero(np.isin(data[end:end + STEP_BYTES], (9, 10, 11, 12, 13, 32)))
                if len(gaps):
                    end += int(gaps[0])
                    break
                end = min(end + STEP_BYTES, len(data))
            parts.append(_hashes(data[begin:end], np.zeros(1, np.int64), bytes_in)[1])
            begin = end
        hashes = np.concatenate(parts)
        yield first, last, hashes, np.array([len(hashes)])


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each row, and how many each row has.

    A row with fewer words has its whole sequence as its one shingle.
    """
    factors = constants(width, 5)
    ends = np.cumsum(counts)
    begins = ends - counts
    full = np.maximum(counts - width + 1, 0)
    sums = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for j in range(width if len(sums) else 0):
        sums += hashes[j:j + len(sums)] * factors[j]
    short = np.flatnonzero((counts > 0) & (counts < width))
    sizes = full.copy()
    sizes[short] = 1
    places = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)
    if len(short):
        long_row = np.repeat(full > 0, sizes)
        out = np.zeros(len(places), np.uint64)
        out[long_row] = sums[places[long_row]]
        tail = np.array([(hashes[b:e] * factors[:e - b]).sum(dtype=np.uint64) + np.uint64(e - b)
                         for b, e in zip(begins[short], ends[short])], np.uint64)
        out[~long_row] = tail
    else:
        out = sums[places]
    return mixed(out), sizes
