"""Spelling variants against brute force over all pairs, on the given documents and on odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortline.llm import spelling
from cohortline.llm.queries import op13_spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return (a[same + 1:] == b[same + 1:]) if len(a) == len(b) else (
        a[same + 1:] == b[same:] if len(a) > len(b) else a[same:] == b[same + 1:])


def plain(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words}


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    expected = plain([(d.doc_id, d.text) for d in docs])
    assert found(op13_spelling(spark, folder)) == expected
    assert any(row[1] for row in expected)


@pytest.mark.parametrize("bits", [6, 27])
def test_odd_rows_and_a_full_bitmap(spark, bits):
    longest = "zq" * 40_000
    texts = ["colour colour colour colour colour colour colour color color color colours colours colours",
             "Él été Éclair ÉCLAIR éclair éclair éclair éclair éclair éclair ×÷×÷× ×÷×÷× ×÷×÷×",
             "abcde" * 1 + " abcde abcde abcdf abcdf abcdf abcdf abcdf abcdf abdcf abdcf abdcf",
             None, "", "a1b2c3", "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa",
             " ".join([longest] * 3), " ".join([longest + "a"] * 6), " ".join([longest[1:]] * 3)]
    rows = [(i if i != 2 else None, t) for i, t in enumerate(texts)] + [(3, "colour"), (3, "colour")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS word", "2 AS n", "3 AS shape", "4 AS reduced", "5 AS root")
    assert found(spelling.spelling_variants(docs, bits=bits)) == plain(rows)


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_neighbourhood_holds_every_edit():
    rng = np.random.default_rng(5)
    for n in (1, 2, 6):
        word = rng.integers(0, spelling.SYMBOLS, n)
        lists = [word.tolist()] + [np.delete(word, i).tolist() for i in range(n)]
        lists += [word[:i].tolist() + [s] + word[i + k:].tolist()
                  for k in (0, 1) for i in range(n + 1 - k) for s in range(spelling.SYMBOLS)]
        wanted = {int(spelling.reduced_hash(np.array([x], int).reshape(1, -1))[0]) for x in lists}
        assert set(spelling.neighbourhoods(word[None])[0].tolist()) == wanted
        parts = np.concatenate([spelling.neighbourhood(word, i, i + 1) for i in range(n + 1)])
        assert set(parts.tolist()) | {int(spelling.reduced_hash(word[None])[0])} == wanted


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"x{i}", "w0") for i in range(50)]
    ends = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert len(ends) == 87 and {r.root for r in ends} == {"w37"}
