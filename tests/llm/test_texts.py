"""The text operators against plain brute-force forms on small tables."""

import base64
import hashlib
import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from cohortline.llm import (
    byte_pairs, components, licenses, near_duplicates, ordinal_quality, personal_data, secrets, winnowing, words,
)

SCHEMA = "doc_id long, text string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Empty, NULL, short, repeated and long texts, NULL ids, and columns whose names operators use inside.
ODD = [(1, ""), (2, None), (3, "one"), (3, "one"), (4, " \t\n"), (None, "no id here at all today"), (None, None),
       (5, "x" * 50_000), (6, "word " * 20_000), (7, "é漢字😀 ½ mixed\u00a0space"), (8, "same text again and again here"),
       (9, "same text again and again here")]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({
        n: F.lit(1) for n in ("at", "rep", "kept", "component", "spans", "base", "score", "_run", "features", "n_tokens")})


def sequences(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def linked(rows, percent):
    """Smallest reachable id of every id, from all pairs."""
    sets = {i: sequences(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_all_pairs(spark, percent):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    rows = []
    for _ in range(25):  # bases with copies of one to four changed words, so that groups are chains and stars
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3, " ".join(copy)))
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), percent).collect()
    wanted = linked(rows, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_exact_comparison_in_blocks(monkeypatch, spark):
    """Buckets larger than a block are cut, and lose no link."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(150)] = f"x{rng.random()}"
        rows.append((i, " ".join(copy)))
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, SCHEMA), 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == linked(rows, 85)


def test_near_duplicates_on_odd_rows(spark):
    found = near_duplicates.near_duplicates(odd(spark), 85)
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in found.collect()}
    assert found.count() == len(ODD)
    assert rows[(1, 0)] == (1, True) and rows[(9, 2)] == (8, False) and rows[(None, 2)] == (None, True)
    left = near_duplicates.without_copies(odd(spark))
    assert left.columns == odd(spark).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 5, 6, 7, 8]
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates.near_duplicates(empty).collect() == []
    # one id with two texts is one document: what either is like is linked through it
    twice = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "q r s t u v"), (3, "q r s t u v")], SCHEMA)
    assert {r.component_id for r in near_duplicates.near_duplicates(twice).collect()} == {1}


def test_near_duplicates_with_repeated_ids(spark):
    """Ids with several texts connect all of them; classes that share their smallest id stay apart as nodes."""
    for seed in range(4):
        rng = random.Random(seed)
        rows = []
        for _ in range(12):
            base = [f"w{rng.randrange(300)}" for _ in range(rng.randint(20, 60))]
            for _ in range(rng.randint(1, 4)):
                copy = list(base)
                for _ in range(rng.randint(0, 2)):
                    copy[rng.randrange(len(copy))] = f"x{rng.randrange(300)}"
                rows.append((rng.randrange(1, 25), " ".join(copy)))
        single = linked(list(enumerate(t for _, t in rows)), 80)
        root = {i: i for i, _ in rows}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for n, (i, _) in enumerate(rows):  # each row is tied to the first row of its group of like texts
            x, y = find(i), find(rows[single[n][1]][0])
            root[max(x, y)] = min(x, y)
        found = near_duplicates.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), 80).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(
            (i, single[n][0], find(i)) for n, (i, _) in enumerate(rows))


def test_without_copies_keeps_defined_rows(spark):
    rows = [(1, "b c d e f g", "s"), (1, "a c d e f g", "t"), (1, "a c d e f g", "r"), (1, "", "u"), (2, "q r s t u v w", "s"),
            (3, "q r s t u v w", "s"), (None, "q r s t u v w", "n"), (4, None, "z")]
    for parts in (1, 5):
        frame = spark.createDataFrame(rows, SCHEMA + ", source string").repartition(parts)
        left = sorted(map(tuple, near_duplicates.without_copies(frame).collect()), key=str)
        assert left == sorted([(1, "a c d e f g", "r"), (1, "", "u"), (2, "q r s t u v w", "s"),
                               (None, "q r s t u v w", "n"), (4, None, "z")], key=str)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = dict(components.components(edges).distinct().collect())
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_byte_pairs_equal_the_public_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    letters = list("abst'rveldm  \n\t12é!?ñ漢𝒳\u00a0\u3000½😀LS")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["x" * 5000, "'" * 300, " " * 400 + "a", "a" + " " * 300, "don't we've I'll 're'll 'rex ''s 's 't", "a", "b"]
    texts += ["".join(chr(c) for c in range(a, a + 64)) for a in range(0, 0x3400, 64)]
    rows = [*enumerate(texts), *((i, t) for i, t in ODD if i)]
    found = byte_pairs.round_trips(spark.createDataFrame(rows, SCHEMA), VOCABULARY, with_ids=True).collect()
    assert len(found) == len(rows)
    wanted = {}
    for i, text in rows:
        ids = np.array(public.encode_ordinary(text or ""), "<u4").tobytes()
        wanted.setdefault(i, set()).add((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) in wanted[r.doc_id] for r in found)
    assert all(r.n_pieces == len(r.piece_offsets) // 8 for r in found)
    assert byte_pairs.round_trips(spark.createDataFrame([], SCHEMA), VOCABULARY).collect() == []


def test_fingerprints(spark):
    rng = random.Random(2)
    rows = [(i * 7, " ".join(rng.choice("ab cd ef gh ij kl mn".split()) + str(rng.randint(0, 99))
                             for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows[5] = (rows[5][0], rows[9][1])
    found = {r.doc_id: r for r in winnowing.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}
    for n, (i, text) in enumerate(rows):
        half, following = len(text) // 2, rows[(n + 1) % len(rows)][1]
        edited = text[:len(text) - half] + following[:half]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
    assert found[rows[5][0]].fingerprint == found[rows[9][0]].fingerprint


def test_fingerprints_by_hand_and_match_guarantee(spark):
    """The selected grams are the rightmost minima of all windows; a shared run of twelve units is seen."""
    words = [f"w{i % 13}{i * i % 7}" for i in range(60)]
    shared = [f"s{i}" for i in range(12)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:9] + shared + words[20:30])), (3, " ".join(words[40:] + shared))]
    df = spark.createDataFrame(rows, SCHEMA)
    marks = df.select(F.explode(F.split("text", " ")).alias("w")).distinct().select(
        "w", F.pmod(F.xxhash64("w"), F.lit(winnowing.PRIME)).alias("h"))
    unit = {r.w: r.h for r in marks.collect()}
    found = {r.doc_id: r.fingerprint for r in winnowing.fingerprints(df).collect()}
    for i, text in rows:
        hashed = [unit[w] for w in text.split()]
        grams = []
        for at in range(len(hashed) - 4):
            h = 0
            for u in hashed[at:at + 5]:
                h = (h * winnowing.BASE + u) % winnowing.PRIME
            grams.append((h, -at))
        chosen = dict.fromkeys(min(grams[at:at + 8]) for at in range(max(len(grams) - 7, 1)))
        assert found[i] == ",".join(f"{-at}:{h:x}" for h, at in chosen)
    second, third = ({m.split(":")[1] for m in found[i].split(",")} for i in (2, 3))
    assert second & third


def test_fingerprints_of_unspaced_text(spark):
    """A passage of twelve code points is seen at any offset in text without spaces."""
    rng = random.Random(2)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300))
    code = "".join(rng.choice("abcdef(){}=+;.") for _ in range(300))
    rows = [(1, chinese), (2, "前" + chinese), (3, code), (4, "x" + code), (5, "note " + chinese[100:112] + " end"),
            (6, "q" * 20 + code[57:90] + "r" * 20)]
    found = {r.doc_id: {m.split(":")[1] for m in r.fingerprint.split(",")}
             for r in winnowing.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found[1] & found[2]) >= len(found[1]) - 2 and len(found[3] & found[4]) >= len(found[3]) - 2
    assert found[5] & found[1] and found[6] & found[3]
    units = spark.createDataFrame([("ab c" + "d" * 17 + " 漢x 😀y",)], "t string").select(
        F.regexp_extract_all("t", F.lit(winnowing.UNIT), F.lit(0))).first()[0]
    assert units == ["ab", "c", *"d" * 17, "漢", "x", "😀y"]


def test_fingerprints_of_odd_rows(spark):
    found = winnowing.fingerprints(odd(spark))
    assert found.count() == len(ODD)
    rows = {r.doc_id: r for r in found.collect() if r.doc_id}
    assert rows[1].fingerprint == rows[2].fingerprint == "" and rows[8].fingerprint == rows[9].fingerprint
    assert winnowing.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = winnowing.fingerprints(spark.createDataFrame([(1, "a b c d e f g h")], SCHEMA)).first()
    assert alone.near_next == 1.0


def base_spans(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"][::-1]
        if 14 <= len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


def test_personal_data_base_and_added(spark):
    rng = random.Random(3)
    letters = list("a1b2.c@@+-_% ()0045 \n\té😀ab.com1.2.3.4")
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for i in range(1500)]
    rows += [(2000, "a" * 3000), (2001, "1" * 3000), (2002, "a@" + "b." * 900 + "c"), (2003, "+1 " + "( " * 900),
             (2004, "1." * 900), (2009, "é 1.22.3.4 x@y.zz +1 437 555 0689, " * 2000), (2005, None), (2006, ""), (2006, ""),
             (2007, "x@y.z._q@r.s 4111 1111 1111 1111 please call (499) 555-6503 now"), (2008, "plain words only")]
    found = personal_data.digests(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text in rows:
        spans = base_spans(text)
        written = [f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        r = by_id[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | ({""} if not written else set())
    assert "phone_local:45:59" in by_id[2007].spans and by_id[2008].spans == ""


def test_personal_data_model_and_redaction(spark):
    docs = spark.createDataFrame([(i, f"some plain words number {'abcdefghij'[i % 10] * 4} and more words " * 5, 1)
                                  for i in range(400)], SCHEMA + ", n_chars int")
    labelled = personal_data.labelled_candidates(docs.select("doc_id", "text"))
    model = personal_data.fit_spans(labelled)
    held = model.selected(labelled.filter("part = 0"))
    right = held.agg(F.avg("label"), F.sum("label")).first()
    assert right[0] >= 0.95 and right[1] >= 0.5 * labelled.filter("part = 0 and label = 1").count()
    one = docs.limit(3).unionByName(spark.createDataFrame([(900, "mail me@here.org or +1 (437) 555-0689.", 5)], docs.schema))
    out = {r.doc_id: r for r in personal_data.redacted(one).collect()}
    assert out[900].text == "mail [EMAIL] or [PHONE]." and out[900].n_chars == len(out[900].text)
    assert len(out) == 4 and personal_data.redacted(odd(spark)).count() == len(ODD)


def test_personal_data_proposes_whole_cases(spark):
    """Every positive plant is a candidate as it stands, and so are account numbers and dates of any country."""
    plants = spark.createDataFrame([(n, s, t) for n, (label, _, t) in enumerate(personal_data.PLANTS) if label
                                    for s in range(5)], "n int, seed int, template string")
    filled = plants.withColumn("filled", personal_data._filled(F.col("template"), F.xxhash64("seed", "n"))).withColumn(
        "text", F.concat(F.lit("words "), "filled", F.lit(" and more")))
    found = filled.select("filled", "template", personal_data.candidates("text").alias("c"))
    assert [r.template for r in found.filter(~F.exists("c", lambda c: c["match"] == F.col("filled"))).collect()] == []
    whole = ["DE89370400440532013000", "GB29NWBK60161331926819", "NL91ABNA0417164300", "NO9386011117947",
             "DE89 3704 0044 0532 0130 00", "FR14 2004 1010 0505 0001 3M02 606", "MT84MALT011000012345MTLCAST001S",
             "1985-03-12", "03/28/1985", "March 12, 1985", "12 May 1985"]
    rows = [(i, f"so {m} BIC and") for i, m in enumerate(whole)]
    for r in spark.createDataFrame(rows, SCHEMA).select("doc_id", personal_data.candidates("text").alias("c")).collect():
        proposed = [c.match for c in r.c]
        assert whole[r.doc_id] in proposed and max(c.end - c.start for c in r.c) <= personal_data.REACH
    rest = spark.createDataFrame([(m,) for m in whole[:7]], "m string").select(personal_data._iban_rest(F.col("m")))
    assert [r[0] for r in rest.collect()] == [1] * 7


def test_personal_data_takes_whole_account_numbers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = ["iban DE89 3704 0044 0532 0130 00 BIC here", "account DE89370400440532013000.", "bank GB29NWBK60161331926819 x",
             "pay NL91ABNA0417164300 now", "born 1985-03-12 in", "dob 03/28/1985 in"]
    wanted = ["iban [IBAN] BIC here", "account [IBAN].", "bank [IBAN] x", "pay [IBAN] now", "born [BIRTH_DATE] in",
              "dob [BIRTH_DATE] in"]
    rows = spark.createDataFrame([(10 ** 9 + i, t) for i, t in enumerate(texts)], SCHEMA)
    found = personal_data.redacted(docs.unionByName(rows)).filter(f"doc_id >= {10 ** 9}").orderBy("doc_id").collect()
    assert [r.text for r in found] == wanted


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(2))
    model = ordinal_quality.fit_grades(ordinal_quality.graded(docs, labels.filter(part == 0)), 3)
    assert list(model.thresholds) == sorted(model.thresholds)
    held = model.grade(docs).join(labels.filter(part == 1), "doc_id")
    kept = {(r.quality, r.toxic): r.share for r in held.groupBy("quality", "toxic").agg(
        F.avg((F.col("tail_2") >= ordinal_quality.LEAST).cast("int")).alias("share")).collect()}
    assert kept[(1, 0)] >= 0.99 and kept[(0, 0)] <= 0.1
    assert held.filter("tail_1 < tail_2 or abs(expected_grade - tail_1 - tail_2) > 1e-9").isEmpty()
    assert model.grade(odd(spark)).count() == len(ODD)
    assert model.keep(odd(spark), 0.0).columns == odd(spark).columns
    none = labels.limit(0)
    assert ordinal_quality.quality(docs.limit(5), none).count() == 5


def test_license_findings(spark):
    changed = licenses.TEMPLATES["MIT"].replace("free of charge", "at no charge").replace("\n", " ")
    rows = [(1, "words before\nReleased under the MIT License."), (2, "x " * 3000 + changed + " y" * 3000),
            (3, "a licence was granted to nobody in particular"), (4, "Licensed under CC BY-NC 4.0.\nMore\n" +
             licenses.TEMPLATES["GPL-3.0"]), *ODD]
    found = licenses.license_findings(spark.createDataFrame(rows, SCHEMA)).collect()
    names = sorted((r.doc_id, r.license, r.exact) for r in found)
    assert names == [(1, "MIT-line", True), (2, "MIT", False), (4, "CC-BY-NC-4.0-line", True), (4, "GPL-3.0", True)]
    texts = dict(rows[:4])
    second = next(r for r in found if r.doc_id == 2)
    assert texts[2][second.start_at:second.end_at] == changed
    assert (second.words_missing, second.words_added) == (3, 2) or second.words_missing + second.words_added <= 6


def test_secrets_on_held_out_and_whole_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = secrets.dictionary(VOCABULARY)
    labelled = secrets.labelled_findings(docs, secrets.transitions(docs), words)
    forest = secrets.fit_forest(labelled.filter("part <> 0"))
    from pyspark.ml.functions import array_to_vector, vector_to_array
    scored = forest.transform(labelled.filter("part = 0").withColumn("features", array_to_vector("values")))
    hits = scored.select(((vector_to_array("probability")[1] >= 0.5) == (F.col("label") == 1)).cast("int").alias("ok"))
    assert hits.agg(F.avg("ok")).first()[0] >= 0.95
    found = secrets.secret_findings(docs, VOCABULARY).join(docs.select("doc_id", "text"), "doc_id").collect()
    planted = [r for r in found if r.text[max(0, r.start_at - 9):r.start_at] == 'token = "']
    assert planted and all(r.secret for r in planted)
    assert secrets.secret_findings(odd(spark).withColumn("source", F.lit(None).cast("string")), VOCABULARY).count() >= 1


def test_secrets_depend_on_the_path(spark):
    """A key scores less under a test-like path; a word that only holds such letters is none."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    paths = ["src/app/main.py", "tests/test_main.py", "example/main.py", "vendor/main.py", "latest/docker/main.py"]
    rows = spark.createDataFrame([(10 ** 9 + i, 'api_key: "3f9c0a7be1d24856a0c9e7713bd58f42"', p) for i, p in enumerate(paths)],
                                 docs.schema)
    found = secrets.secret_findings(docs.unionByName(rows), VOCABULARY).filter(f"doc_id >= {10 ** 9}").orderBy("doc_id")
    plain, *side, other = [r.score for r in found.collect()]
    assert len(side) == 3 and all(x < plain for x in side) and other == plain >= 0.5


def test_secrets_after_a_cue(spark):
    """Short secrets and ones of any characters are proposed and found; words and references are not secrets."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    held = [("password=", "Tr0ub4dor&3", "\n"), ('api_key = "', "9f86d081884c7d65", '"'), ("postgres://admin:", "S3cr!t~pw9", "@db.example.org/x"),
            ("Authorization: Bearer ", "a8Kd02LmQx7Zt5Wq", "\n"), ("secret: ", "xK9.~!vR$2mQ", "\n"), ("passwd: '", "Hx7$kQ2p", "'")]
    none = [("password: ", "required", "\n"), ("token = ", "getpass.getpass()", "\n"), ("secret: ", "${CLIENT_SECRET}", "\n")]
    rows = [(10 ** 9 + i, f"some text {b}{v}{a}more", "src1") for i, (b, v, a) in enumerate(held + none)]
    found = secrets.secret_findings(docs.unionByName(spark.createDataFrame(rows, docs.schema)), VOCABULARY)
    by_span = {(r.doc_id - 10 ** 9, rows[r.doc_id - 10 ** 9][1][r.start_at:r.end_at]): r.secret
               for r in found.filter(f"doc_id >= {10 ** 9}").collect()}
    assert {k: by_span.get(k) for k in ((i, v) for i, (_, v, _) in enumerate(held))} == {(i, v): True for i, (_, v, _) in enumerate(held)}
    assert [by_span.get((len(held) + i, v)) for i, (_, v, _) in enumerate(none)] == [False] * len(none)
    assert secrets.proposed("x" * 10 + "a" * 40) == [(0, 50)] and secrets.proposed("password=abcdef;") == [(9, 15)]


def test_licenses_beside_each_other():
    """An edited notice is found beside an exact one of another template, and of its own."""
    mit, line = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0-line"]
    edited = mit.replace("free of charge", "at no charge")
    known = licenses.Templates(licenses.TEMPLATES)

    def found(text):
        return [(name, text[start:end]) for name, start, end, *_ in licenses.findings_in(text, known)]
    bare, bare_line = mit.rstrip("."), line.rstrip(".")
    for text in (f"{edited}\n{line}", f"{line}\n{edited}", f"{edited}\n{mit}", f"{mit}\n{edited}", f"{line} {line}\n{edited}\n{line}"):
        names = ["MIT" if "Permission" in x else "Apache-2.0-line" for x in text.replace(f"{line} {line}", f"{line}\n{line}").split("\n")]
        assert [n for n, _ in found(text)] == names, text
        assert all(t.rstrip(".") in (bare, edited.rstrip("."), bare_line) for _, t in found(text))


LICENSE_PROBES = [
    ("Licensed under the MIT License.", ["MIT-line"]), ("Released under the terms of the MIT License", ["MIT-line"]),
    ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1-line"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0-line"]),
    ("Licensed under CC BY 4.0.", ["CC-BY-4.0-line"]), ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0-line"]),
    ("Licensed under CC BY-SA 3.0.", ["CC-BY-SA-3.0-line"]), ("Licensed under CC BY-SA 2.0.", []),
    ("covered by the GNU Lesser General Public License, version 3", ["LGPL-3.0-line"]),
    ("under the GNU Lesser General Public License, version 3.", ["LGPL-3.0-line"]),
    ("under the GNU General Public License, version 2", ["GPL-2.0-line"]), ("sold under the GPLv2 since", ["GPL-2.0-line"]),
    ("under the Foo License, Version 2.0.", []), ("a license plate, and free software", []),
    ("// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\nint main", ["GPL-2.0-only WITH Classpath-exception-2.0"]),
    ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\nimport os", ["MIT OR Apache-2.0"]), ("SPDX-License-Identifier:\nint main", []),
]


def test_license_probes():
    """Names and versions decide; a template is found as itself, also with changed words of other kinds."""
    known = licenses.Templates(licenses.TEMPLATES)

    def names(text):
        return [found[0] for found in licenses.findings_in(f"some words {text} and others", known)]
    for text, wanted in LICENSE_PROBES:
        assert names(text) == wanted, text
    for name, text in licenses.TEMPLATES.items():
        if name != "SPDX":
            assert names(text) == [name.split("#")[0]], name
    agpl = licenses.TEMPLATES["AGPL-3.0"]
    assert names(agpl.replace("This program", "This tool")) == ["AGPL-3.0"]
    assert names(agpl.replace("Affero ", "")) == ["GPL-3.0"] and names(agpl.replace("version 3", "version 4")) == []


def test_license_findings_equal_plain_comparison():
    """What is found is what a plain word-by-word comparison of every window with every template finds."""
    rng = random.Random(6)
    chosen = {n: licenses.TEMPLATES[n] for n in ("MIT", "ISC", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0")}
    known = licenses.Templates(chosen)

    def least_differences(text):
        there, out = [w[0] for w in licenses._words(text)], {}
        for name, template in chosen.items():
            wanted = [w[0] for w in licenses._words(template)]
            row = [0] * (len(there) + 1)  # a match may begin anywhere; inserted and left-out words count
            for i, w in enumerate(wanted, 1):
                last, row = row, [i]
                for j, x in enumerate(there, 1):
                    row.append(last[j - 1] if w == x else 1 + min(last[j], row[j - 1]))
            out[name] = min(row) / len(wanted)
        return out
    plain = "lorem ipsum dolor sit amet".split()
    for _ in range(60):
        name = rng.choice(sorted(chosen))
        tokens = chosen[name].split()
        for _ in range(rng.randint(0, 2)):  # words that decide nothing
            at = rng.choice([i for i, w in enumerate(tokens) if len(licenses._bare(w)) > 3
                             and not licenses._decides([licenses._bare(w)], 0)])
            tokens[at] = rng.choice(plain)
        text = " ".join([*(rng.choice(plain) for _ in range(30)), *tokens, *(rng.choice(plain) for _ in range(30))])
        differences = least_differences(text)
        assert min(differences, key=differences.get) == name
        assert [found[0] for found in licenses.findings_in(text, known)] == [name]
    assert licenses.findings_in("lorem licence ipsum " * 50, known) == []


def test_quality_works_on_small_runs_of_a_column(monkeypatch):
    """No run of several texts is beyond the bound, and runs change no score."""
    import numpy as np
    import pyarrow as pa
    from cohortline.llm import ordinal_quality as q
    column = pa.array([f"text {i} of words " * (i % 400) for i in range(300)], pa.large_string())
    model = q.GradeModel(np.random.default_rng(1).normal(size=q.SLOTS), np.array([-1.0, 1.0]))
    found = list(model.scores(column))
    sizes = [sum(len(column[i].as_py()) for i in range(first, first + len(score))) for first, score in found]
    assert len(found) > 3 and max(sizes) <= 1 << 18
    monkeypatch.setattr(q, "RUN_BYTES", 1 << 30)
    whole, = model.scores(column)
    assert np.concatenate([score for _, score in found]).tolist() == whole[1].tolist()


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_words_take_little_memory_at_work_in_any_runs():
    texts = ["Ab cd\tEF  ", "", " x", "é à" * 5, "longer words here " * 400] * 30
    column = pa.array(texts, pa.string())
    whole = [np.concatenate(x) for x in zip(*[r[2:] for r in words.hashed_words(column)])]
    parts = [np.concatenate(x) for x in zip(*[r[2:] for r in words.hashed_words(column, most=1000)])]
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    data = np.frombuffer(b"some words of a text " * 50_000, np.uint8)
    words._hashes(data, np.zeros(1, np.int64))
    assert _peak(lambda: words._hashes(data, np.zeros(1, np.int64))) < 40 * len(data)


def test_runs_of_near_duplicates_stay_small():
    column = pa.array([" ".join(f"w{i}" for i in range(j, j + 900)) for j in range(400)], pa.string())
    next(near_duplicates._sets(column))
    assert _peak(lambda: [None for _ in near_duplicates._sets(column)]) < 16 << 20
    sets = [np.arange(i, i + 40, dtype=np.uint64) for i in range(1000)]
    near_duplicates._similar(sets, 80)
    i, j = near_duplicates._similar(sets, 80)
    assert list(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(1000) for b in range(a + 1, min(a + 5, 1000))]
    assert _peak(lambda: near_duplicates._similar(sets, 80)) < 24 << 20
