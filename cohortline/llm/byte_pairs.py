"""Byte-level BPE: boundaries by transition functions, cached merges, decoding.

Text is cut as the public pattern asks, without a regular expression: every
codepoint becomes a symbol (its class, and what follows it where the pattern
looks ahead), every symbol is a function on the eight states of a small
automaton, and an associative scan over the composed functions (runs of one
symbol taken as a power of its function) gives the state before every run, hence
where a piece begins. Each piece is merged by rank once and then read from a
bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortline.llm.inputs import batch, steps, texts_of

#: Most pieces of one generation of remembered merges; a task keeps two.
CACHED = 200_000
#: Pieces up to this many bytes are merged by plain list search, longer ones by a queue.
PLAIN = 48
#: Most bytes of a vocabulary file that is sent to the tasks.
VOCABULARY_BYTES = 16 << 20

# Symbols: letter, number, other, apostrophe before one or two contraction letters,
# white space that more white space or the end follows, the last space or other
# white space of a run; the same again for the first codepoint of a text.
LETTER, NUMBER, OTHER, SHORT, LONG, GAP, SPACE, BREAK = range(8)
FIRST = 8
# States: what the piece in progress may still take.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, AFTER_SPACE, CLOSED, ONE_MORE, TWO_MORE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece begins) for each state and symbol."""
    opened = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE_MORE, LONG: TWO_MORE,
              GAP: IN_GAP, SPACE: AFTER_SPACE, BREAK: CLOSED}
    after, begins = np.zeros((8, 16), np.uint8), np.ones((8, 16), bool)
    for symbol, state in opened.items():
        after[:, symbol] = after[:, symbol + FIRST] = state
    goes_on = {(IN_LETTERS, LETTER): IN_LETTERS, (IN_NUMBERS, NUMBER): IN_NUMBERS, (IN_OTHERS, OTHER): IN_OTHERS,
               (IN_OTHERS, SHORT): IN_OTHERS, (IN_OTHERS, LONG): IN_OTHERS, (IN_GAP, GAP): IN_GAP,
               (AFTER_SPACE, LETTER): IN_LETTERS, (AFTER_SPACE, NUMBER): IN_NUMBERS,
               (AFTER_SPACE, OTHER): IN_OTHERS, (AFTER_SPACE, SHORT): IN_OTHERS, (AFTER_SPACE, LONG): IN_OTHERS,
               (TWO_MORE, LETTER): ONE_MORE, (ONE_MORE, LETTER): CLOSED}
    for (state, symbol), then in goes_on.items():
        after[state, symbol], begins[state, symbol] = then, False
    return after, begins


def _monoid(after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions: (of each symbol, product table, function table)."""
    functions = [tuple(range(8))]
    place = {functions[0]: 0}
    generators = [tuple(after[:, s].tolist()) for s in range(16)]
    for known in functions:  # grows while it is read
        for step in generators:
            then = tuple(step[s] for s in known)
            if then not in place:
                place[then] = len(functions)
                functions.append(then)
    table = np.array(functions, np.uint8)
    product = np.array([[place[tuple(g[f].tolist())] for g in table] for f in table], np.intp)
    return np.array([place[g] for g in generators], np.intp), product, table


AFTER, BEGINS = _automaton()
OF_SYMBOL, PRODUCT, FUNCTIONS = _monoid(AFTER)
#: State that each function leads to from the state before any text.
FROM_START = FUNCTIONS[:, CLOSED]
#: A symbol repeated three times acts as it does ever after.
LONGEST = 3
OF_RUN = np.stack([np.zeros_like(OF_SYMBOL), OF_SYMBOL, PRODUCT[OF_SYMBOL, OF_SYMBOL],
                   PRODUCT[PRODUCT[OF_SYMBOL, OF_SYMBOL], OF_SYMBOL]], axis=1)
_KINDS: dict[str, np.ndarray] = {}


def _kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or GAP for every codepoint."""
    if "table" not in _KINDS:
        table = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LN":
                table[c] = LETTER if kind == "L" else NUMBER
        # White_Space, a fixed list of Unicode
        for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
            table[c] = GAP
        _KINDS["table"] = table
    return _KINDS["table"]


def _scan(steps_: np.ndarray) -> np.ndarray:
    """Inclusive scan of functions under composition: runs side by side, then the runs themselves."""
    n, width = len(steps_), len(PRODUCT)
    if n <= 256:
        out = np.empty(n, np.intp)
        total = 0
        for i, f in enumerate(steps_.tolist()):
            total = int(PRODUCT[total, f])
            out[i] = total
        return out
    length = 256
    runs = -(-n // length)
    padded = np.zeros(runs * length, np.intp)
    padded[:n] = steps_
    lanes = np.ascontiguousarray(padded.reshape(runs, length).T)
    flat = PRODUCT.ravel()
    at = np.empty(runs, np.intp)
    for t in range(1, length):
        np.multiply(lanes[t - 1], width, out=at)
        np.add(at, lanes[t], out=at)
        flat.take(at, out=lanes[t], mode="clip")
    before = np.zeros(runs, np.intp)
    before[1:] = _scan(lanes[-1])[:-1] * width
    lanes += before
    return flat.take(lanes, mode="clip").T.reshape(-1)[:n]


def boundaries(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts laid end to end; ``firsts`` are the texts' first codepoints."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    symbol = _kinds()[points]
    new = np.zeros(n + 1, bool)
    new[firsts] = True
    new[n] = True
    gap = symbol == GAP
    last = gap.copy()
    last[:-1] &= ~gap[1:]
    last &= ~new[1:]
    symbol[last] = np.where(points[last] == 32, SPACE, BREAK)
    marks = np.flatnonzero(points == 39)
    if len(marks):
        follow = [np.where((marks + k < n), points[np.minimum(marks + k, n - 1)], 0) for k in (1, 2)]
        inside = [~new[np.minimum(marks + 1, n)], ~new[np.minimum(marks + 2, n)]]
        one = inside[0] & np.isin(follow[0], [ord(c) for c in "stmd"])
        pair = [follow[0] == ord(a) for a in "rvl"], [follow[1] == ord(b) for b in "eel"]
        two = inside[0] & inside[1] & np.any([a & b for a, b in zip(*pair)], axis=0)
        symbol[marks[one]], symbol[marks[two]] = SHORT, LONG
    symbol[firsts] += FIRST
    changed = np.ones(n, bool)
    np.not_equal(symbol[1:], symbol[:-1], out=changed[1:])
    changed[firsts] = True
    runs = np.flatnonzero(changed)
    length = np.diff(runs, append=n)
    kind = symbol[runs]
    ends = FROM_START.take(_scan(OF_RUN[kind, np.minimum(length, LONGEST)]))
    before = np.empty(len(runs), np.uint8)
    before[0], before[1:] = CLOSED, ends[:-1]
    begins = [runs[BEGINS[before, kind]]]
    for state, letters in ((ONE_MORE, 1), (TWO_MORE, 2)):  # a contraction ends inside a run of letters
        begins.append(runs[(before == state) & (kind == LETTER) & (length > letters)] + letters)
    return np.sort(np.concatenate(begins), kind="stable")


def _merged_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    none = 1 << 60
    rank = ranks.get
    edges = list(range(len(piece) + 1))
    joined = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while joined:
        least = min(joined)
        if least == none:
            break
        i = joined.index(least)
        del edges[i + 1], joined[i]
        if i < len(joined):
            joined[i] = rank(piece[edges[i]:edges[i + 2]], none)
        if i:
            joined[i - 1] = rank(piece[edges[i - 1]:edges[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(edges, edges[1:])]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the adjacent pair of lowest rank, leftmost first, is joined again and again."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n <= PLAIN:
        return _merged_short(piece, ranks)
    ends = list(range(1, n + 1))  # end of the part that begins here
    before = list(range(-1, n - 1))
    alive = [True] * n
    queue = []

    def offer(i):
        j = ends[i]
        if j < n:
            rank = ranks.get(piece[i:ends[j]])
            if rank is not None:
                heapq.heappush(queue, (rank, i, ends[j]))
    for i in range(n):
        offer(i)
    while queue:
        _, i, end = heapq.heappop(queue)
        j = ends[i]
        if not alive[i] or j >= n or ends[j] != end:
            continue
        alive[j] = False
        ends[i] = end
        if end < n:
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i:ends[i]]] for i in range(n) if alive[i]]


class _Merges(dict):
    """Piece -> its ids as little-endian 32-bit integers; when full, it becomes the older generation."""

    def __init__(self, ranks):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece):
        if len(self) >= CACHED:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            ids = merged(piece, self.ranks)
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[piece] = found
        return found


class Vocabulary:
    """The ranks of a rank file: one token in base64 and its rank per line."""

    _loaded: dict[str, "Vocabulary"] = {}

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = tokens
        self.cache = _Merges(self.ranks)

    @classmethod
    def of(cls, content: bytes) -> "Vocabulary":
        """Parsed once in a task's process."""
        name = hashlib.blake2b(content).hexdigest()
        if name not in cls._loaded:
            cls._loaded[name] = cls(content)
        return cls._loaded[name]

    def encode(self, column: pa.Array):
        """(row, ids as little-endian bytes, byte offset of each piece) of each text of a column."""
        cache = self.cache
        for first, last, data, offsets in steps(column):
            raw = data.tobytes()
            points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
            places = np.flatnonzero((data & 0xC0) != 0x80)
            firsts = np.searchsorted(places, offsets[:-1][np.diff(offsets) > 0])
            cuts = places[boundaries(points, firsts)]
            rows = np.searchsorted(cuts, offsets)
            edges = cuts.tolist() + [len(raw)]
            found = [cache[raw[a:b]] for a, b in zip(edges, edges[1:])]
            for row in range(last - first):
                low, high = rows[row], rows[row + 1]
                yield first + row, b"".join(found[low:high]), cuts[low:high] - offsets[row]

    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()])


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is over {VOCABULARY_BYTES} bytes")
    return content


def round_trips(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids again, one row per row of ``docs``.

    Returns doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit
    integers), decoded_sha256 (of the decoded bytes), n_pieces, and with
    ``with_ids`` also ids and piece_offsets (byte offset of every piece, 64-bit
    little-endian). ``vocabulary`` is the path of a rank file that the driver can
    read. NULL and empty texts have no tokens; repeated rows are encoded each;
    a NULL doc_id stays NULL; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string()), ("n_pieces", pa.int64())]
    if with_ids:
        fields += [("ids", pa.binary()), ("piece_offsets", pa.binary())]
    schema = pa.schema(fields)

    def run(batches):
        words = Vocabulary.of(shared.value)
        for rows in batches:
            out: list[list] = [[] for _ in schema]
            begun = 0
            for row, ids, pieces in words.encode(rows.column(1)):
                decoded = words.decode(np.frombuffer(ids, "<u4"))
                made = [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest(), len(pieces)]
                made += [ids, pieces.astype("<i8").tobytes()] if with_ids else []
                for values, value in zip(out[1:], made):
                    values.append(value)
                if with_ids and len(out[1]) >= 1000:
                    yield batch(schema.names, [rows.column(0).slice(begun, row + 1 - begun), *out[1:]], schema)
                    begun, out = row + 1, [[] for _ in schema]
            if out[1]:
                yield batch(schema.names, [rows.column(0).slice(begun), *out[1:]], schema)
        words.cache.older = {}  # the process may go on to other stages

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return texts_of(docs, key, text).mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in fields))
