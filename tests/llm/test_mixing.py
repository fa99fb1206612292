import random

import numpy as np
import pytest

from condofin.llm import mixing as M

from .brute import plain_words, random_texts, targets


def rows_of(docs, **kw):
    return [(r["doc"]["doc_id"], r["doc"]["source"], r["doc"]["text"], r["size"], r["source_size"], r["target"], r["copies"])
            for r in M.mix(docs, **kw).collect()]


def check(rows, exact=False):
    sizes, taken = {}, {}
    for _, s, t, size, _, _, copies in rows:
        assert size == len(plain_words(t)) and 0 <= copies <= 3
        sizes[s] = sizes.get(s, 0) + size
        taken[s] = taken.get(s, 0) + copies * size
    goal = targets(sizes)
    for _, s, _, _, total, target, _ in rows:
        assert total == sizes[s] and target == pytest.approx(goal[s])
    return {s: taken[s] / goal[s] for s in goal if goal[s]}


@pytest.mark.parametrize("block", [4096, 40])
def test_targets_are_met(make_docs, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rng = random.Random(4)
    sources = ["a"] * 10 + ["b", "c", "d", "\U0001F600", "Z", None, "hot", "hot", "hot", "hot"]
    docs = [(i, " ".join(["w"] * min(900, int(rng.paretovariate(1.1) * 8))), "en", rng.choice(sources)) for i in range(3000)]
    first = rows_of(make_docs(docs))
    ratios = check(first)
    assert all(abs(r - 1) < 0.02 for r in ratios.values()), ratios
    assert sorted(rows_of(make_docs(docs)), key=repr) == sorted(first, key=repr)


def test_caps_and_reshared_excess(make_docs):
    docs = [(i, "w " * 50, "en", s) for i, s in enumerate(["a"] * 2 + ["b"] * 200 + ["c"] * 300 + ["d"] * 3)]
    rows = rows_of(make_docs(docs))
    check(rows)
    assert all(r[6] == 3 for r in rows if r[1] == "a")


def test_edges(make_docs, edges):
    docs = [(i, t, "en", s) for (i, t), s in zip(edges, [None, "a", "b", "a", "", "a", "a", None, "b", "c", "c", "c", "a", "b", "d"])]
    rows = rows_of(make_docs(docs, extra=True))
    assert len(rows) == len(docs)
    check(rows)
    assert M.mix(make_docs([])).count() == 0
    empty = rows_of(make_docs([(1, None), (2, ""), (3, " \n")]))
    assert [(r[3], r[5], r[6]) for r in empty] == [(0, 0.0, 0)] * 3


def test_size_column(make_docs):
    texts = random_texts(50, 8) + ["", " ", "a", " a ", "\ta\x0bb\x0c\r\nc", "a\u00a0b", None]
    for r in make_docs(list(enumerate(texts))).select("text", M.size_column(__import__("pyspark").sql.functions.col("text")).alias("n")).collect():
        assert r["n"] == len(plain_words(r["text"]))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    for _ in range(20):
        size = rng.integers(1, 5000, 400)
        pi = rng.random(400)
        out = M.flight(pi, size, rng.random(500))
        left = (out > 0) & (out < 1)
        assert left.sum() <= 2
        assert out.sum() == pytest.approx(pi.sum(), abs=1e-3) and out @ size == pytest.approx(pi @ size, rel=1e-5)
    same = M.flight(np.full(9, 0.5), np.full(9, 7), rng.random(20))
    assert ((same > 0) & (same < 1)).sum() == 1 and same.sum() == pytest.approx(4.5)


def test_equal_rows_are_spread_over_blocks(make_docs, monkeypatch):
    """A third of the rows are one row: no flight holds much more than a block,
    and the rows taken of them don't depend on how the table is cut."""
    monkeypatch.setattr(M, "BLOCK", 500)
    monkeypatch.setattr(M, "CHUNK", 64)
    held = []
    flights = M._flights
    monkeypatch.setattr(M, "_flights", lambda units, level, last: held.append(
        max([r["count"] for r in units.groupBy("source", "block").count().collect()], default=0)) or flights(units, level, last))
    docs = [(7, "same words here", "en", "a")] * 2000 + [(i, "w " * (i % 90 + 1), "en", "ab"[i % 2]) for i in range(10, 4010)]
    docs += [(None, None, "en", "a")] * 300
    rows = rows_of(make_docs(docs))
    assert len(rows) == len(docs) and max(held) <= 650
    ratios = check(rows)
    assert all(abs(r - 1) < 0.02 for r in ratios.values()), ratios
    again = rows_of(make_docs(docs[::-1]).repartition(7))
    assert sorted(again, key=repr) == sorted(rows, key=repr)


def test_rows_that_differ_by_which_column_is_null(spark):
    df = spark.createDataFrame([(1, "x", None, "s"), (1, "x", "s", None)] * 3, "doc_id bigint, text string, lang string, source string")
    out = M.mix(df)
    assert sorted((r["doc"]["lang"], r["source"]) for r in out.collect() if r["doc"]["lang"]) == [("s", None)] * 3
    assert out.count() == 6


def test_query(spark):
    from condofin.llm.queries import op8_mix
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    sizes, size = {}, {}
    for r in docs:
        size[r.doc_id] = (r.source, len(plain_words(r.text)))
        sizes[r.source] = sizes.get(r.source, 0) + size[r.doc_id][1]
    goal, taken = targets(sizes), {}
    rows = op8_mix(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(size)
    for r in rows:
        source, n = size[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[source]) and r["target"] == pytest.approx(goal[source])
        assert n == 0 and r["taken"] == 0 or r["taken"] % n == 0 and r["taken"] <= 3 * n
        taken[source] = taken.get(source, 0) + r["taken"]
    longest = {s: max(n for t, n in size.values() if t == s) for s in goal}
    assert all(abs(taken[s] - g) <= longest[s] for s, g in goal.items())
