import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from condofin.llm import packing as P
from condofin.llm.queries import op11_packing

from .brute import random_texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def of():
    with open(VOCABULARY, "rb") as f:
        return P.encoder(f.read())


def test_ids_of_every_code_point(exact, of):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f" {chr(c)}{chr(c)} a{chr(c)}1\n{chr(c)}" for c in points[at:at + 50_000]]
        assert [of.ids(t) for t in texts] == exact(texts)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85 'stremvld1a!<|endoftext|>"), st.characters(exclude_categories=["Cs"]))))
def test_ids_of_any_text(exact, of, text):
    assert of.ids(text) == exact([text])[0]
    assert "".join(P.parts(text, 3)) == text


def test_ids_of_long_texts(exact, of, monkeypatch):
    monkeypatch.setattr(P, "PART", 50)
    rng = random.Random(2)
    texts = ["".join(rng.choice(["ab", " ", "  ", "\n", "\n\n ", "x" * 90, " ", "'s", "9"]) for _ in range(2000)),
             " " * 30_000 + "x", "a" + "\n" * 5000, "x" * 100_000, "<|endoftext|> a<|endoftext|>"]
    assert [of.ids(t) for t in texts] == exact(texts)


def test_differencing():
    """The textbook example, and near-equal sums of many sizes."""
    two = P.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in g) for g in two) == [14, 16]
    rng = random.Random(1)
    for n, k in ((1, 1), (5, 9), (300, 7), (2000, 130), (2000, 1)):
        sizes = [rng.randint(1, 256) for _ in range(n)]
        groups = P.differencing(sizes, k)
        assert len(groups) <= k and sorted(i for g in groups for i in g) == list(range(n))
        sums = [sum(sizes[i] for i in g) for g in groups]
        if n >= 10 * k:
            assert max(sums) - min(sums) <= 4
    assert P.differencing([], 3) == [] and P.windows([]) == []


def test_window_count_rises_only_on_overflow():
    assert len(P.windows([600, 600, 600])) == 3
    assert len(P.windows([512] * 8)) == 4
    rng = random.Random(5)
    sizes = [rng.randint(1, 256) for _ in range(4000)]
    groups = P.windows(sizes)
    assert max(sum(sizes[i] for i in g) for g in groups) <= 1024
    assert len(groups) <= 1.01 * sum(sizes) / 1024 + 1
    start = time.time()
    P.windows([256] * 4096)
    assert time.time() - start < 5


def check(rows, docs, ids_of):
    """Every id in exactly one piece, sequences gapless and within the window."""
    want = {}
    for i, text in docs:
        every = ids_of(text or "") + [0]
        want.setdefault(i, []).append(every)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for of_one in sequences.values():
        at = 0
        for r in sorted(of_one, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    expected = {}
    for i, lists in want.items():
        for every in lists:
            raw = np.array(every, "<u4")
            expected.setdefault(i, []).extend(
                (a, n, zlib.crc32(raw[a:a + n].tobytes()), len(every)) for a, n in P.cuts(len(every)))
    assert {i: sorted(p) for i, p in by_doc.items()} == {i: sorted(p) for i, p in expected.items()}
    total = sum(r["length"] for r in rows)
    return sum(P.padding(sum(r["length"] for r in s)) for s in sequences.values()) / max(1, total)


@pytest.mark.parametrize("block", [4096, 60])
def test_every_id_in_one_piece(make_docs, exact, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    docs = list(enumerate(random_texts(150, 3, longest=900))) + [(7, "twice"), (7, "twice"), (None, None), (None, "")]
    out = P.pack(make_docs(docs), VOCABULARY, ids=True)
    rows = out.select("doc.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids").collect()
    assert check(rows, docs, lambda t: exact([t])[0]) < (0.02 if block == 4096 else 0.2)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_edges(make_docs, edges, exact, spark):
    docs = make_docs(edges, extra=True)
    out = P.pack(docs, VOCABULARY)
    assert out.select("doc.*").columns == [c for c in docs.columns if c != "text"]
    rows = out.select("doc.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    check(rows, edges, lambda t: exact([t])[0])
    assert P.pack(make_docs([]), VOCABULARY).count() == 0
    alone = P.pack(spark.createDataFrame([("a b",)], "text string"), VOCABULARY).collect()
    assert [(r["start"], r["length"], r["offset"]) for r in alone] == [(0, 3, 0)]
    with pytest.raises(FileNotFoundError, match="vocabulary"):
        P.pack(docs, "/nowhere/file.json")


def test_query(spark, exact):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = op11_packing(spark, sf)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(out.collect(), docs, lambda t: exact([t])[0]) < 0.02


def test_equal_rows_are_spread(make_docs, monkeypatch):
    """A third of the rows are one row: no block holds much more than others."""
    monkeypatch.setattr(P, "BLOCK", 100)
    docs = [(1, "same text here")] * 400 + [(i, f"text {i}") for i in range(2, 802)]
    seq = P.pack(make_docs(docs), VOCABULARY, keep=["doc_id"]).select(
        F.expr("sequence_id div (2 * 1048576)").alias("block")).groupBy("block").count().collect()
    assert len(seq) == 12 and max(r["count"] for r in seq) < 180
