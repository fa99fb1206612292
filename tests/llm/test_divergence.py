import random
import re
from collections import Counter

import numpy as np
import pytest

from condofin.llm import divergence as D

from .brute import FOLD

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs):
    """docs: (text, lang, source) -> set of result rows."""
    docs = [tuple(x or "" for x in d) for d in docs]
    occ, seen = {}, {}
    for text, lang, source in docs:
        terms = TERM.findall(text.translate(FOLD))
        occ.setdefault((lang, source), Counter()).update(terms)
        seen.setdefault(lang, Counter()).update(set(terms))
    rows = []
    for lang, df in seen.items():
        kept = [t for t, n in df.items() if n >= 10]
        groups = {s: c for (g, s), c in occ.items() if g == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // total for t in kept}

        of, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s, p in of.items():
            pair = [(sum((p[t] - r[t]) ** 2 // (p[t] + r[t]) for t in kept), o) for o, r in of.items() if o != s]
            term = [((p[t] - q[t]) ** 2 // (p[t] + q[t]), t) for t in kept if groups[s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                rows += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(rows)


def random_docs(n, seed):
    rng = random.Random(seed)
    vocabulary = ["w" + "".join(rng.choices("abcdé", k=4)) for _ in range(90)] + ["Ünï", "日本", "A-b", "x1y", "THE", "the"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    langs, sources = ["en"] * 6 + ["de", "fr", None, ""], ["hot"] * 5 + ["a", "b", "c", "Z", "\U0001F600", "é", None, ""]
    return [(rng.choice([" ", "\n", "; "]).join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))),
             rng.choice(langs), rng.choice(sources)) for _ in range(n)]


def rows_of(make_docs, docs, **kw):
    frame = make_docs([(i, t, lang, s) for i, (t, lang, s) in enumerate(docs)], **kw)
    return sorted(map(tuple, D.audit(frame).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(make_docs, monkeypatch, small):
    if small:  # many blocks and ranges of rows, counts handed on early
        monkeypatch.setattr(D, "BLOCK_POSTINGS", 30)
        monkeypatch.setattr(D, "CELLS", 25)
        monkeypatch.setattr(D, "HELD", 50)
        monkeypatch.setattr(D, "PART", 16)
    docs = random_docs(900, 4)
    assert rows_of(make_docs, docs, extra=True) == brute(docs)


def test_edges(make_docs, edges):
    assert rows_of(make_docs, []) == []
    docs = [(t, None if i % 3 else "en", "s%d" % (i % 4)) for i, (_, t) in enumerate(edges)]
    assert rows_of(make_docs, docs, extra=True) == brute(docs)
    # groups without terms, languages without kept terms, ties and repeated rows
    docs = [(None, "en", "a"), ("", "en", "b"), ("x y", "en", "c")] + [("same words here", "de", s) for s in "ab" * 30]
    got = rows_of(make_docs, docs)
    assert got == brute(docs)
    assert [r[4] for r in got if r[0] == "en"] == [0] * 6


def test_shares_beyond_64_bits(spark):
    n = [0, 10 ** 10, 10 ** 13 + 7]
    frame = spark.createDataFrame([(x, 3 * 10 ** 13 + 1, 12345) for x in n], "n bigint, total bigint, terms bigint")
    got = [r["p"] for r in frame.select("n", D.share(*map(__import__("pyspark").sql.functions.col, ("n", "total", "terms")))
                                        .alias("p")).orderBy("n").collect()]
    assert got == [1 + 10 ** 9 * (x + 2) // (3 * 10 ** 13 + 1 + 2 * 12345) for x in n]


def test_accumulator_equals_dense_sums():
    rng = np.random.default_rng(6)
    groups, terms = 30, 200
    zero = rng.integers(1, 50, groups)
    dense = np.where(rng.random((groups, terms)) < 0.2, rng.integers(50, 10 ** 9, (groups, terms)), 0)
    dense[0, :], dense[:, 0] = 0, 7  # a group without most terms, a term of all groups
    g, t = np.nonzero(dense)
    full = np.where(dense > 0, dense, zero[:, None])
    met = sorted(set(t))
    for first, last in ((0, 30), (5, 9)):
        for a, acc in D.accumulate(first, last, zero, t, g, dense[g, t]):
            want = [sum((int(x) - int(y)) ** 2 // (int(x) + int(y)) for x, y in zip(full[a, met], full[b, met]))
                    for b in range(a + 1, groups)]
            assert acc.tolist() == want
