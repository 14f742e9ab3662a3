"""Aligned tokens against the public libraries and a plain walk over both token lists."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortline.llm import alignment
from cohortline.llm.byte_pairs import Vocabulary, read_vocabulary
from cohortline.llm.queries import op12_alignment

JSON, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "Hello  world", "été naïve\n\n\n  x", "\t\r\n mixed \t", "漢字かな交じり文", "👩‍👩‍👧 ok 👍🏽", "\x00\x01", "▁ piece",
       "<|endoftext|> <s> </s> <0x41> <unk>", "don't we'll I'd", "ﬁ ① ｆｕｌｌ é", "﻿bom �    ", " " * 5000,
       "a" * 3000, "ab1" * 2000, "1234567890" * 50, "x\n" * 400]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain}
    for x in range(256):
        if x not in plain:
            letters[chr(256 + len(letters) - len(plain))] = x
    bytes_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab().items() if not t.startswith("<|")}
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())]
    return a, b, bytes_a, bytes_b


def plain(rows, tools):
    a, b, bytes_a, bytes_b = tools
    done, held = [], Counter()
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        if not text or b"".join(bytes_a[i] for i in ids_a) != whole or b"".join(bytes_b[i] for i in ids_b) != whole:
            done.append((key, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(bytes_a[i]) for i in ids_a]).tolist(), np.cumsum([len(bytes_b[i]) for i in ids_b]).tolist()
        groups, links, at_a, at_b, x, y = [], [], 0, 0, 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        while x < len(ids_a) and y < len(ids_b):
            links.append((ids_a[x], ids_b[y]))
            end = min(ends_a[x], ends_b[y])
            x, y = x + (ends_a[x] == end), y + (ends_b[y] == end)
        held.update(set(links))
        done.append((key, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return Counter((key, na, nb, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha)
                   for key, na, nb, g, links, sha in done)


def test_query_over_the_whole_table(spark, tools):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert Counter(map(tuple, op12_alignment(spark, folder).collect())) == plain([(d.doc_id, d.text) for d in docs], tools)


@pytest.mark.parametrize("step", [1, 1 << 21])
def test_odd_rows(spark, tools, step):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(ODD)] + [(-1, "Hello  world")] * 5 + [(9, "Hello world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS docs", "2 AS step", "3 AS links", "4 AS n_a").repartition(3)
    assert Counter(map(tuple, alignment.aligned(docs, JSON, PIECES, step=step).collect())) == plain(rows, tools)
    assert alignment.aligned(docs.limit(0), JSON, PIECES).collect() == []


def test_ids_of_every_code_point(tools):
    words = Vocabulary(alignment.rank_file(read_vocabulary(JSON)))
    import pyarrow as pa
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}\n" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    wanted = tools[0].encode_batch_fast(texts, add_special_tokens=False)
    ours = {row: np.frombuffer(ids, "<u4").tolist() for row, ids, _ in words.encode(pa.array(texts))}
    assert [i for i, e in enumerate(wanted) if e.ids != ours[i]] == []


def test_pointers_end_where_both_sides_end():
    rng = np.random.default_rng(1)
    for _ in range(50):
        total = int(rng.integers(1, 400))
        ends = [np.unique(np.append(rng.integers(1, total + 1, int(rng.integers(1, 60))), total)) for _ in range(2)]
        both = np.intersect1d(*ends)
        for of, own in zip(alignment.terminals(*ends), ends):
            assert ends[1][of].tolist() == both[np.searchsorted(both, own)].tolist()
