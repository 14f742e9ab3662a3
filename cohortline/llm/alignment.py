"""Align the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the token of the other
side that reaches farthest right among those it overlaps, or to itself if none
reaches as far; where both end at one byte, the second side's token is the end.
Doubling the pointers of all tokens of many texts at once brings every token to
the last one of its component, and that labels the groups.

A run of texts is one step. Its digests, its pairs of linked ids with the number
of texts that hold them, and every text's share of those pairs are packed into
one row and written once, to the checkpoint folder. Pairs are then counted over
the whole corpus, and their counts go back to the steps that asked for them: what
is shuffled is one row per step and pair, not one per link.
"""

from __future__ import annotations

import base64
import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.byte_pairs import Vocabulary, read_vocabulary
from cohortline.llm.inputs import batch, steps, texts_of
from cohortline.settings import cut_lineage

#: Bytes of text of one step; a longer text is a step of its own.
STEP = 1 << 21
#: Most pieces whose merges a task remembers.
REMEMBERED = 400_000
_PACK, _PACKED = "step long, docs binary, links binary, pairs binary", ("docs", "links", "pairs")
_OUT = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())]


def byte_level(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The bytes of each entry of a byte-level vocabulary, whose 256 letters stand for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {
        chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}


def rank_file(content: bytes) -> bytes:
    """The rank file of a byte-level BPE in JSON form whose ids are the ranks of its merges."""
    model = json.loads(content)["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(model["vocab"]["".join(m)] != 256 + i for i, m in enumerate(merges)):
        raise ValueError("the ids of the vocabulary are not the ranks of its merges")
    merged = {"".join(m) for m in merges}
    ranks = byte_level({t: i for t, i in model["vocab"].items() if t in merged or i < 256})
    return b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items())


class _Side:
    """Lengths and bytes of the tokens of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of tokens."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.data[np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class _Merged(dict):
    """Ids of pieces as packed bytes, merged by the public library, remembered up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        import public_tokenizers
        import tiktoken

        self.encoding = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece):
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[piece] = np.array(self.encoding._encode_single_piece(piece), "<u4").tobytes()
        return found


class Pair:
    """Both tokenizers, loaded once in a task's process."""

    _loaded: dict[str, "Pair"] = {}

    def __init__(self, ranks: bytes, pieces: bytes):
        import sentencepiece

        self.a, self.b = Vocabulary(ranks), sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.a.cache = _Merged(self.a.ranks)
        self.side_a = _Side(self.a.tokens)
        self.side_b = _Side([bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                             else self.b.id_to_piece(i).replace("▁", " ").encode()
                             for i in range(self.b.get_piece_size())])

    @classmethod
    def of(cls, ranks: bytes, pieces: bytes) -> "Pair":
        name = hashlib.blake2b(ranks + pieces).hexdigest()
        if name not in cls._loaded:
            cls._loaded[name] = cls(ranks, pieces)
        return cls._loaded[name]

    def encode(self, texts: pa.Array):
        """(ids, row of each) for A and B, of the rows whose tokens spell a blank and the text on both sides."""
        spaced = pc.binary_join_element_wise("", texts, " ")
        found = list(self.a.encode(spaced))
        n_a = np.array([len(ids) // 4 for _, ids, _ in found], np.int64)
        ids_a = np.frombuffer(b"".join(ids for _, ids, _ in found), "<u4").astype(np.int64)
        pieces = self.b.encode(texts.to_pylist(), num_threads=1)
        n_b = np.array([len(p) for p in pieces], np.int64)
        ids_b = np.concatenate([np.array(p, np.int64) for p in pieces]) if len(pieces) else np.zeros(0, np.int64)
        size = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.arange(len(size))
        rows_a, rows_b = np.repeat(rows, n_a), np.repeat(rows, n_b)
        kept = size > 1
        for side, ids, at in ((self.side_a, ids_a, rows_a), (self.side_b, ids_b, rows_b)):
            kept &= np.bincount(at, side.lengths[ids], len(size)).astype(np.int64) == size
        for _ in range(2):  # lengths first, so that the bytes of the rest lie side by side
            in_a, in_b = kept[rows_a], kept[rows_b]
            ids_a, rows_a, ids_b, rows_b = ids_a[in_a], rows_a[in_a], ids_b[in_b], rows_b[in_b]
            wanted = np.frombuffer("".join(pc.filter(spaced, pa.array(kept)).to_pylist()).encode(), np.uint8)
            differs = (self.side_a.spelled(ids_a) != wanted) | (self.side_b.spelled(ids_b) != wanted)
            if not differs.any():
                break
            kept[np.repeat(rows[kept], size[kept])[differs]] = False
        return ids_a, rows_a, ids_b, rows_b


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token (a number on side B) of the component of each A and each B token, from their end offsets."""
    n = len(ends_a)
    of_a = np.searchsorted(ends_b, ends_a)
    of_b = np.searchsorted(ends_a, ends_b)
    own = n + np.arange(len(ends_b))
    further = np.where(ends_a[np.minimum(of_b, max(n - 1, 0))] > ends_b, of_b, own) if n else own
    jump = np.concatenate([n + of_a, further])
    while True:
        twice = jump[jump]
        if np.array_equal(twice, jump):
            return jump[:n] - n, jump[n:] - n
        jump = twice


def written_groups(ids_a, last_a, rows_a, ids_b, last_b, rows_b, count: int) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each of ``count`` rows, made for all rows at once."""
    n, m = len(ids_a), len(ids_b)
    if not n:
        return [b""] * count
    ends = np.flatnonzero(last_b == np.arange(m))
    group_a, group_b = np.searchsorted(ends, last_a), np.searchsorted(ends, last_b)
    # Before an A token stand the B tokens of earlier groups, before a B token the A tokens of its own as well.
    at_a = np.arange(n) + np.append(0, ends[:-1] + 1)[group_a]
    at_b = np.arange(m) + np.cumsum(np.bincount(group_a, minlength=len(ends)))[group_b]
    ids, group, row = (np.empty(n + m, np.int32) for _ in range(3))
    side = np.zeros(n + m, bool)
    ids[at_a], group[at_a], row[at_a] = ids_a, group_a, rows_a
    ids[at_b], group[at_b], row[at_b], side[at_b] = ids_b, group_b, rows_b, True
    last_of_row = np.append(row[1:] != row[:-1], True)
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[:-1][side[1:] != side[:-1]] = ord("|")
    mark[:-1][group[1:] != group[:-1]] = ord(";")
    digits = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, len(str(int(ids.max())))))
    width = digits + ~last_of_row
    upto = np.cumsum(width)
    out = np.empty(int(upto[-1]), np.uint8)
    begin = upto - width
    rest = ids.copy()
    for k in range(int(digits.max())):
        here = digits > k
        out[(begin + digits - 1 - k)[here]] = (rest % 10 + ord("0")).astype(np.uint8)[here]
        rest //= 10
    out[(begin + digits)[~last_of_row]] = mark[~last_of_row]
    edges = np.zeros(count + 1, np.int64)
    np.add.at(edges, row[last_of_row] + 1, upto[last_of_row] - np.append(0, upto[last_of_row][:-1]))
    edges = np.cumsum(edges)
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _pack(**arrays) -> bytes:
    """Integer arrays as one compressed block, each in the width it needs."""
    parts = []
    for values in arrays.values():
        kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(values) or values.max() <= np.iinfo(k).max)
        parts.append(np.array([len(values), int(kind[2])], "<u8").tobytes() + values.astype(kind).tobytes())
    return zstandard.compress(b"".join(parts), 1)


def _unpack(block: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(block), 0, []
    while at < len(raw):
        n, width = np.frombuffer(raw, "<u8", 2, at).tolist()
        out.append(np.frombuffer(raw, f"<u{width}", n, at + 16).astype(np.int64))
        at += 16 + n * width
    return out


def aligned_step(pair: Pair, ids: pa.Array, texts: pa.Array) -> tuple[bytes, bytes, bytes]:
    """One step packed: (documents, links of each document, pairs with the number of documents that hold them)."""
    count = len(texts)
    ids_a, rows_a, ids_b, rows_b = pair.encode(texts)
    ends_a = np.cumsum(pair.side_a.lengths[ids_a])
    ends_b = np.cumsum(pair.side_b.lengths[ids_b])
    last_a, last_b = terminals(ends_a, ends_b)
    n_groups = np.bincount(rows_b[last_b == np.arange(len(ids_b))], minlength=count)
    written = written_groups(ids_a, last_a, rows_a, ids_b, last_b, rows_b, count)
    # Between two neighbouring ends of either side lies one overlap of one A and one B token.
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])[:len(ends)]]
    link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    rows = rows_a[link_a]
    wide = len(pair.side_b.lengths)
    at, codes = pd.factorize(ids_a[link_a] * wide + ids_b[link_b])
    held = rows * max(len(codes), 1) + at
    held.sort()
    first = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(held)))
    of_row, of_pair = np.divmod(held[first], max(len(codes), 1))
    known = np.array([i is not None for i in ids.to_pylist()], np.int64)
    names = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    digests = [hashlib.sha256(w).digest() if w else b"" for w in written]
    docs = _pack(names=names, known=known, n_a=np.bincount(rows_a, minlength=count),
                 n_b=np.bincount(rows_b, minlength=count), n_groups=n_groups, n_links=np.bincount(rows, minlength=count),
                 sha=np.frombuffer(b"".join(digests), np.uint8))
    # Pairs of one document ascend, so that their differences pack well.
    gaps = np.diff(of_pair, prepend=0)
    gaps[np.append(True, of_row[1:] != of_row[:-1])[:len(gaps)]] = of_pair[np.append(True, of_row[1:] != of_row[:-1])[:len(gaps)]]
    links = _pack(each=np.bincount(of_row, minlength=count), gaps=gaps, times=times)
    return docs, links, _pack(codes=codes, held=np.bincount(of_pair, minlength=len(codes)))


def _steps_of(docs: DataFrame, ranks: bytes, pieces: bytes, step: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pieces))
    schema = pa.schema([("docs", pa.binary()), ("links", pa.binary()), ("pairs", pa.binary())])

    def run(batches):
        pair = Pair.of(*shared.value)
        for rows in batches:
            for first, last, _, _ in steps(rows.column(1), step):
                n = last - first
                made = aligned_step(pair, rows.column(0).slice(first, n), rows.column(1).slice(first, n))
                yield batch(schema.names, [[m] for m in made], schema)

    return docs.mapInArrow(run, "docs binary, links binary, pairs binary")


def _pairs_of(packed: DataFrame) -> DataFrame:
    """(step, at, code, held): the pairs of every step."""
    schema = pa.schema([("step", pa.int64()), ("at", pa.int32()), ("code", pa.int64()), ("held", pa.int32())])

    def run(batches):
        for rows in batches:
            for step, block in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                codes, held = _unpack(block)
                yield batch(schema.names, [pa.array(np.full(len(codes), step)), pa.array(np.arange(len(codes), dtype=np.int32)),
                                           pa.array(codes), pa.array(held.astype(np.int32))], schema)

    return packed.select("step", "pairs").mapInArrow(run, "step long, at int, code long, held int")


def _summed(rows: DataFrame) -> DataFrame:
    """The documents of every step, with the sums of their pairs' counts."""
    schema = pa.schema(_OUT)

    def run(batches):
        for table in batches:
            for docs, links, at, held, best in zip(*(table.column(i) for i in range(5))):
                names, known, n_a, n_b, n_groups, n_links, sha = _unpack(docs.as_py())
                each, gaps, times = _unpack(links.as_py())
                count, top = np.zeros((2, len(at) if at.is_valid else 0), np.int64)
                if at.is_valid:
                    place = at.values.to_numpy()
                    count[place] = held.values.to_numpy()
                    top[place] = best.values.to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(each)), each)
                begin = np.cumsum(each) - each
                total = np.cumsum(gaps)
                pair = total - np.repeat((total - gaps)[np.minimum(begin, max(len(gaps) - 1, 0))] if len(gaps) else begin, each)
                some = (n_links > 0).tolist()
                digest = iter(sha.astype(np.uint8).tobytes()[i:i + 32].hex() for i in range(0, len(sha), 32))
                sums = [np.bincount(row, times * values[pair], len(each)).astype(np.int64) if len(row) else np.zeros(len(each), np.int64)
                        for values in (top, count)]
                yield batch(schema.names, [pa.array(names, mask=known == 0), n_a, n_b, n_groups, n_links, *sums,
                                           [next(digest) if s else "" for s in some]], schema)

    kinds = {pa.int64(): "long", pa.string(): "string"}
    return rows.select("docs", "links", "at", "count", "best").mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in _OUT))


def aligned(docs: DataFrame, byte_level_json: str, piece_model: str, step: int = STEP,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A and B are the tokens of a blank and the text by both tokenizers; both files are
    read on the driver. NULL, empty and those texts that one side does not spell byte
    by byte have no tokens: zeros and ''. Very long texts are steps of their own;
    repeated rows and equal texts count each; a NULL doc_id stays NULL; an empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ranks = rank_file(read_vocabulary(byte_level_json))
    packed = cut_lineage(_steps_of(texts_of(docs, key, text), ranks, read_vocabulary(piece_model), step))
    # The written rows keep their order, so that this number is the same whenever it is made.
    packed = packed.withColumn("step", F.monotonically_increasing_id())
    asked = _pairs_of(packed)
    import sentencepiece

    wide = F.lit(sentencepiece.SentencePieceProcessor(model_file=piece_model).get_piece_size())
    counted = asked.groupBy("code").agg(F.sum("held").alias("count"))
    counted = counted.withColumn("a", F.floor(F.col("code") / wide))
    # One row per id of the first vocabulary at most, as the files' bound on bytes bounds it.
    highest = F.broadcast(counted.groupBy("a").agg(F.max("count").alias("highest")))
    judged = counted.join(highest, "a").select("code", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))
    back = asked.select("step", "at", "code").join(judged, "code").groupBy("step").agg(
        F.collect_list(F.struct("at", "count", "best")).alias("found"))
    return _summed(packed.join(back, "step", "left").select(
        "docs", "links", F.col("found.at").alias("at"), F.col("found.count").alias("count"), F.col("found.best").alias("best")))
