"""MinHash near-duplicates: banding, signature check, full-set check, components.

1. Each text gets its set of word-shingle hashes, a digest of that set and 128
   universal-hash minima. Texts with equal sets are one class from then on. Its
   number is its smallest doc_id; where classes share that one, since a doc_id has
   several texts, all but one are numbered by their digests.
2. Every 4 minima form one of 32 bands. Classes that share a band meet in a
   bucket. Of the first classes of its buckets, each class is compared with the
   one it shares most bands with, first by signature, then by the full sets.
3. What the confirmed links leave unconnected is compared exactly inside the
   buckets, in blocks of bounded size, and a spanning forest of the links found
   is kept. No pair list of a group is ever written.
4. Components come from alternating large-star and small-star.

At 0.85 two texts share no band with a chance of 6e-11, at 0.8 of 5e-8. Hashes
and digests have 64 bits; sizes and similarities are those of the hashed sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm import words
from cohortline.llm.components import components
from cohortline.llm.inputs import batch, texts_of
from cohortline.settings import cut_lineage

WIDTH = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: How far a signature's estimate may lie below the wanted similarity (over five deviations).
SLACK = 0.2
#: Most classes of one side of an exact comparison, and about how many hashes their sets have.
BLOCK, BLOCK_HASHES = 512, 1 << 18
CHUNK = 1 << 16
#: Bytes of text that a run works on; a longer text is a run of its own.
RUN_BYTES = 1 << 18

def _signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The minima of 128 universal hashes (a x + b modulo 2^64) of each row's shingles, high halves."""
    a, b = words.constants(HASHES, 11), words.constants(HASHES, 12)
    out = np.full((len(sizes), HASHES), np.iinfo(np.uint64).max, np.uint64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    for begin in range(0, len(hashes), CHUNK):
        x = hashes[begin:begin + CHUNK]
        row = rows[begin:begin + CHUNK]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        held = row[starts]
        work = np.empty_like(x)
        for k in range(HASHES):
            np.multiply(x, a[k], out=work)
            np.add(work, b[k], out=work)
            out[held, k] = np.minimum(out[held, k], np.minimum.reduceat(work, starts))
    return (out >> np.uint64(32)).astype(np.uint32)


def _sets(column: pa.Array):
    """(row, sorted distinct shingle hashes) of each text, with the raw shingles per run of rows."""
    for first, last, hashes, counts in words.hashed_words(column, most=RUN_BYTES):
        grams, sizes = words.shingles(hashes, counts, WIDTH)
        ends = np.cumsum(sizes)
        yield first, grams, sizes, [np.unique(grams[e - s:e]) for e, s in zip(ends, sizes)]


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=8).digest() for s in sets), np.int64)


def _placed(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("n_shingles", pa.int64())])
    for rows in batches:
        for first, _, _, sets in _sets(rows.column(1)):
            yield batch(schema.names, [rows.column(0).slice(first, len(sets)), _digests(sets),
                                       np.array([len(s) for s in sets], np.int64)], schema)


def _sketches(batches):
    schema = pa.schema([("digest", pa.int64()), ("signature", pa.binary())])
    for rows in batches:
        for _, grams, sizes, sets in _sets(rows.column(1)):
            minima = _signatures(grams, sizes)
            some = np.flatnonzero(sizes)
            yield batch(schema.names, [_digests(sets)[some], [minima[i].tobytes() for i in some]], schema)


def _banded(batches):
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])
    factors = words.constants(ROWS, 21)
    for rows in batches:
        if not rows.num_rows:
            continue
        minima = np.frombuffer(b"".join(rows.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        keys = (minima.astype(np.uint64) * factors).sum(2, dtype=np.uint64)
        keys = words.mixed(keys ^ words.constants(BANDS, 22)[None, :]).astype(np.int64)
        yield batch(schema.names, [keys.ravel(), np.repeat(rows.column(0).to_numpy(), BANDS)], schema)


def _estimates(floor: float):
    def estimate(batches):
        schema = pa.schema([("node", pa.int64()), ("pivot", pa.int64()), ("best", pa.bool_())])
        for rows in batches:
            if not rows.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint32).reshape(-1, HASHES)
                           for c in (2, 3))
            agree = (left == right).sum(1)
            near = agree >= floor * HASHES
            near = pa.array(near)
            yield batch(schema.names, [rows.column(c).filter(near) for c in (0, 1, 4)], schema)
    return estimate


def _set_rows(batches):
    schema = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("shingles", pa.binary())])
    for rows in batches:
        for first, _, _, sets in _sets(rows.column(1)):
            yield batch(schema.names, [rows.column(0).slice(first, len(sets)), _digests(sets),
                                       [s.tobytes() for s in sets]], schema)


def _confirmed(percent: int):
    def confirm(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for rows in batches:
            linked = []
            for x, y in zip(rows.column(2), rows.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            linked = np.array(linked, bool)
            yield batch(schema.names, [rows.column(0).to_numpy()[linked], rows.column(1).to_numpy()[linked]], schema)
    return confirm


def _similar(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Every pair (i < j) of sets with enough in common, from counts of common hashes.

    A hash that only one set has joins no pair; a set that keeps too few others
    for its size is left out before the counts are made.
    """
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    while True:
        shared = seen[code] > 1
        kept = np.bincount(owner[shared], minlength=len(sets))
        able = 100 * kept >= percent * size
        left = shared & able[owner]
        if left.all():
            break
        owner, code = owner[left], code[left]
        seen = np.bincount(code, minlength=len(seen))
        if not len(owner):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, owner = np.unique(owner, return_inverse=True)
    _, code = np.unique(code, return_inverse=True)
    common = np.zeros((len(rows), len(rows)), np.float32)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for low in range(0, int(code.max()) + 1, 1024):
        begin, end = np.searchsorted(code, (low, low + 1024))
        part = np.zeros((len(rows), 1024), np.float32)
        part[owner[begin:end], code[begin:end] - low] = 1
        common += part @ part.T
    found, size = [], size[rows]
    for low in range(0, len(rows), 128):
        both = common[low:low + 128].astype(np.int64)
        either = size[low:low + 128, None] + size[None, :] - both
        i, j = np.nonzero(np.triu(100 * both >= percent * either, low + 1))
        found.append((rows[i + low], rows[j]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _forest(percent: int):
    def join(group: pa.Table) -> pa.Table:
        ids, tied = group.column("node").to_numpy(), group.column("component").to_numpy()
        _, tied = np.unique(tied, return_inverse=True)
        parent = np.arange(int(tied.max()) + 1)

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x
        edges = []
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("shingles")]
        if len(parent) > 1:
            for i, j in zip(*_similar(sets, percent)):
                a, b = root(tied[i]), root(tied[j])
                if a != b:
                    parent[a] = b
                    edges.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()),
                         "b": pa.array([e[1] for e in edges], pa.int64())})
    return join


def _with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    return (members.join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node")))


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside buckets between classes that are not connected yet.

    ``members`` has (bucket, node, component). Buckets with the same classes are
    taken once; classes whose unshared shingles rule out any partner in the
    bucket leave it; a large bucket is cut into blocks that meet two by two.
    """
    open_buckets = (members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"),
        F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").dropDuplicates(["n", "same"]).select("bucket"))
    rest = cut_lineage(members.join(open_buckets, "bucket"))
    ids = rest.select(F.col("node").alias("id")).distinct()
    held = cut_lineage(sets.join(ids, "id").withColumn("size", (F.octet_length("shingles") / 8).cast("long")))
    unshared = (held.select("id", F.explode(_hash_list()).alias("shingle"))
                .groupBy("shingle").agg(F.count("*").alias("seen"), F.min("id").alias("id")).filter("seen = 1")
                .groupBy("id").agg(F.count("*").alias("own")))
    sizes = (held.select("id", "size").join(unshared, "id", "left")
             .select(F.col("id").alias("node"), "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("kept")))
    sized = rest.join(sizes, "node")
    least = sized.groupBy("bucket").agg(F.min("size").alias("least"))
    able = cut_lineage(sized.join(least, "bucket").filter(
        f"100 * kept >= {percent} * (size + greatest(kept, least) - kept)").select("bucket", "node", "component", "size"))
    many = able.groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_HASHES)).cast("int").alias("blocks"),
        F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = (able.join(many.select("bucket", "blocks"), "bucket").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "node", "component"))
    return (units.join(held.select(F.col("id").alias("node"), "shingles"), "node")
            .groupBy("bucket", "i", "j").applyInArrow(_forest(percent), "a long, b long"))


def _hash_list():
    """The 8-byte hashes of a set as an array of strings, for counting."""
    n = (F.octet_length("shingles") / 8).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("shingles"), i * 8 + 1, F.lit(8)))


def near_duplicates(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Two documents are linked if 100 * common >= percent * all of their shingle
    sets; component_id is the smallest doc_id that links lead to, and a row is
    kept if that is its own. A text of fewer than five words has its whole word
    sequence as its only shingle; NULL or empty texts have none and stay alone.
    Rows that repeat a doc_id count as one document: their texts are connected,
    and all of them are kept or none. A row without doc_id gets no
    component_id, joins nothing and is kept. Other columns are not read.
    """
    docs = texts_of(docs, key, text)
    placed = cut_lineage(docs.mapInArrow(_placed, "doc_id long, digest long, n_shingles long").withColumn(
        "digest", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest"))))
    several = cut_lineage(placed.filter("digest is not null").groupBy("doc_id").agg(
        F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high").select("doc_id"))
    simple = several.isEmpty()  # then every class has a smallest doc_id of its own
    names = _numbered(placed, simple)
    by_node = cut_lineage(docs.filter("doc_id is not null").mapInArrow(_sketches, "digest long, signature binary")
                          .groupBy("digest").agg(F.first("signature").alias("signature"))
                          .join(names.select("digest", "node"), "digest").select("node", "signature")).repartition("node")

    banded = by_node.mapInArrow(_banded, "bucket long, node long")
    full = banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    members = cut_lineage(banded.join(full, "bucket"))
    # with its most frequent first class a class shares most bands; a bucket of two has one pair
    pairs = cut_lineage(members.filter("node <> pivot").groupBy("node", "pivot").agg(
        F.count("*").alias("bands"), F.max(F.col("n") == 2).alias("alone")))
    most = pairs.groupBy("node").agg(F.max(F.struct("bands", F.bitwise_not("pivot").alias("p"))).alias("m")) \
        .select("node", F.bitwise_not("m.p").alias("pivot"), F.lit(True).alias("best"))
    signed = (pairs.join(most, ["node", "pivot"], "left").filter("best or alone")
              .join(by_node, "node").withColumnRenamed("signature", "left_signature")
              .join(by_node.select(F.col("node").alias("pivot"), "signature"), "pivot")
              .select("node", "pivot", "left_signature", "signature", F.coalesce("best", F.lit(False)).alias("best")))
    near = cut_lineage(signed.mapInArrow(_estimates(percent / 100 - SLACK), "node long, pivot long, best boolean"))

    wanted = names.join(members.select("node").distinct(), "node", "left_semi").select("least")
    sets = docs.join(wanted, docs.doc_id == wanted["least"], "left_semi").mapInArrow(
        _set_rows, "id long, digest long, shingles binary")
    if simple:
        sets = cut_lineage(sets.select("id", "shingles").dropDuplicates(["id"]))
        found = _components_of(None, members, near, sets, percent)
        lowest = found.select("node", F.col("component").alias("low"))
    else:
        sets = cut_lineage(sets.drop("id").dropDuplicates(["digest"]).join(
            names.select("digest", F.col("node").alias("id")), "digest").select("id", "shingles"))
        found = _components_of(_tied(placed, several, names), members, near, sets, percent)
        low = cut_lineage(found.join(names, "node").groupBy("component").agg(F.min("least").alias("low")))
        lowest = found.join(low, "component").select("node", "low")
    # written out, so that hot classes and components are split when they are joined
    ids = cut_lineage(names.join(lowest, "node", "left")
                      .select("digest", F.coalesce("low", "least").alias("component_id")))
    return (placed.join(ids, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _numbered(placed: DataFrame, simple: bool) -> DataFrame:
    """(digest, least, node) of every class: its smallest doc_id, and its number, which no other class has."""
    classes = placed.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least"))
    if simple:
        return cut_lineage(classes.withColumn("node", F.col("least")))
    shared = (classes.groupBy("least").agg(F.min("digest").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("least", "first"))
    return cut_lineage(classes.join(shared, "least", "left").select(
        "digest", "least", F.when(F.col("first") != F.col("digest"), F.col("digest")).otherwise(F.col("least")).alias("node")))


def _tied(placed: DataFrame, several: DataFrame, names: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of every doc_id that has several."""
    tied = cut_lineage(placed.join(several, "doc_id", "left_semi").join(names.select("digest", "node"), "digest")
                       .select("doc_id", "node").distinct())
    least = tied.groupBy("doc_id").agg(F.min("node").alias("a"))
    return tied.join(least, "doc_id").select("a", F.col("node").alias("b"))


def _components_of(tied, members, near, sets, percent) -> DataFrame:
    """(node, component) of the classes that links or a common doc_id connect."""
    def confirmed(pairs):
        both = (pairs.join(sets.select(F.col("id").alias("node"), F.col("shingles").alias("x")), "node")
                .join(sets.select(F.col("id").alias("pivot"), F.col("shingles").alias("y")), "pivot")
                .select("node", "pivot", "x", "y"))
        return both.mapInArrow(_confirmed(percent), "a long, b long")

    first = confirmed(near.filter("best").select("node", "pivot"))
    found = components(first if tied is None else first.unionByName(tied))

    def roots(links):
        """The links between components that ``found`` keeps apart."""
        for end in ("a", "b"):
            links = (links.join(found.withColumnRenamed("node", end), end, "left")
                     .withColumn(end, F.coalesce("component", end)).drop("component"))
        return links.filter("a <> b")
    pairs = near.filter(~F.col("best")).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    across = roots(pairs.select("a", "b", F.col("a").alias("node"), F.col("b").alias("pivot"))).select("node", "pivot")
    inside = _rest(_with_component(members.filter("n > 2").select("bucket", "node"), found), sets, percent)
    more = cut_lineage(roots(confirmed(across).unionByName(inside)).select("a", "b").distinct())
    if not more.isEmpty():
        joined = components(more).select(F.col("node").alias("component"), F.col("component").alias("root"))
        found = cut_lineage(found.unionByName(joined.select(F.col("component").alias("node"), "component"))
                            .join(joined, "component", "left")
                            .select("node", F.coalesce("root", "component").alias("component"))
                            .groupBy("node").agg(F.min("component").alias("component")))
    return found


def without_copies(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, one per document: all columns, other rows unchanged.

    Of rows that repeat a doc_id and have words the one stays whose text, then
    whose whole row as JSON, comes first; rows without words or without doc_id
    all stay.
    """
    found = cut_lineage(near_duplicates(docs, percent, key, text))
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs[key].cast("long") == gone["_gone"], "left_anti")
    again = (found.filter(F.col("kept") & F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
             .groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_again")))
    again = cut_lineage(again)
    if again.isEmpty():
        return left
    on = (left[key].cast("long") == again["_again"]) & left[text].rlike(r"[^\x20\x09-\x0D]")
    row = F.struct(*docs.columns)
    first = (left.join(again, on, "left_semi").groupBy(F.col(key).cast("long"))
             .agg(F.min_by(row, F.struct(F.col(text), F.to_json(row))).alias("_row")))
    return left.join(again, on, "left_anti").unionByName(first.select("_row.*"))
