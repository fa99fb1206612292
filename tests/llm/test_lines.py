import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from condofin.llm import lines as L

from .brute import line_dedup, random_texts


def found(docs):
    rows = L.removed_lines(docs).collect()
    return {r["doc"]["doc_id"]: (r["n_lines"], r["n_removed"], r["kept"]) for r in rows}


def texts(n, seed):
    """Lines of few words, so that many are near the threshold."""
    rng = random.Random(seed)
    words = ["k%d" % i for i in range(25)]
    base = [[rng.choice(words) for _ in range(rng.randrange(1, 14))] for _ in range(20)]
    out = []
    for _ in range(n):
        ls = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(base))
            if rng.random() < 0.6:
                line[rng.randrange(len(line))] = rng.choice(words)
            ls.append(" ".join(line) + rng.choice(["", " ", "\r"]))
        out.append("\n".join(ls))
    return out


def test_against_brute_force(make_docs):
    docs = list(enumerate(texts(120, 1)))
    assert found(make_docs(docs)) == line_dedup(docs)


def test_frequent_words_take_the_other_way(make_docs, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 2)
    docs = list(enumerate(texts(80, 2)))
    assert found(make_docs(docs)) == line_dedup(docs)
    docs = list(enumerate(random_texts(40, 3, longest=200)))
    assert found(make_docs(docs)) == line_dedup(docs)


@pytest.mark.parametrize("wide", [64, 8])
def test_long_lines_on_both_sides_of_the_wider_parity(make_docs, monkeypatch, wide):
    """Lines of 50 to 90 words of which some are changed: pairs at, above and
    below the threshold, also of one set that keeps both parities and one that doesn't."""
    monkeypatch.setattr(L, "WIDE", wide)
    rng = random.Random(wide)
    base = [[f"b{k}w{i}" for i in range(rng.randrange(50, 91))] for k in range(12)]
    docs = []
    for i in range(60):
        line = list(base[i % len(base)])
        for at in rng.sample(range(len(line)), rng.randrange(len(line) // 6)):
            line[at] = f"new{i}n{at}" if rng.random() < 0.5 else ""
        docs.append((i, " ".join(line)))
    got = found(make_docs(docs))
    assert got == line_dedup(docs) and 0 < sum(r[1] for r in got.values()) < 48


def test_only_classes_that_can_hold_frequent_words_are_counted(make_docs, monkeypatch):
    """Words in exactly so many lines as the limit allows, and in one more."""
    for limit in (1, 2, 3, 7, 8):
        monkeypatch.setattr(L, "FREQUENT", limit)
        docs = [(10 * n + i, f"same{n} a{n} b{n} c{n} " + " ".join(f"x{n}y{i}z{k}" for k in range(i % 2 + 1)))
                for n in (limit, limit + 1) for i in range(n)]
        assert found(make_docs(docs)) == line_dedup(docs)


def test_rarity_classes_of_all_counters(make_docs):
    """Counters with and without words, in chunks with and without words, made
    without a row for each counter."""
    docs = make_docs([(1, "a b a\tc\nd a"), (2, None), (3, ""), (4, "a\x0bb\x0ce\rf")])
    bits = 20
    table = L.rarity(docs, bits)
    words = "a b a c d a a b e f".split() + [""]
    spark = docs.sparkSession
    keys = spark.createDataFrame([(w,) for w in words], "w string").select(L._counter(F.xxhash64("w"), bits)).collect()
    met = Counter(k[0] for k in keys)
    want = {k: math.floor(2 * math.log2(n + 1)) for k, n in met.items()}
    classes = table.first()["classes"]
    assert len(classes) == 1 << bits
    assert {k: c for k, c in enumerate(classes) if c} == want
    assert f"Range (0, {1 << bits}" not in table._jdf.queryExecution().executedPlan().toString()
    assert not any(L.rarity(make_docs([]), 16).first()["classes"])


@pytest.mark.parametrize("num,den", [(4, 5), (8, 10), (2, 3), (1, 2), (9, 10)])
def test_sizes_at_the_ends_of_bands(make_docs, num, den):
    """Pairs of a line and one of its subsets, around the size that is similar enough."""
    docs, want = [], {}
    for n in range(4, 40):
        least = -(-n * num // den)
        for m in {least - 1, least, least + 1, n - 1} & set(range(1, n)):
            words = [f"{n}x{m}y{k}" for k in range(n)]
            ends = [" ".join(words), " ".join(words[n - m:])]
            for line in ends if n % 2 else ends[::-1]:
                want[len(docs)] = int(len(docs) % 2 and m * den >= n * num)
                docs.append((len(docs), line))
    got = {r["doc"]["doc_id"]: r["n_removed"] for r in L.removed_lines(make_docs(docs), (num, den)).collect()}
    assert got == want


def test_lines_of_blanks_only_stay(make_docs):
    docs = [(i, "a b c d e\n \t\n\x0b\x0c\r \n\n\u00a0\n\u2003 \u00a0") for i in range(3)]
    got = found(make_docs(docs))
    assert got == line_dedup(docs) and [r[1] for _, r in sorted(got.items())] == [0, 3, 3]


def test_blanks_of_all_kinds_separate_words(make_docs):
    """Words that only two lines have, one of them cut at other blanks."""
    docs = []
    for i in range(40):
        words = [f"only{i}x{k}" for k in range(9)]
        sep = "\t\r\x0b\x0c "[i % 5]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, sep.join([*words, "more"]) + sep)]
    got = found(make_docs(docs))
    assert got == line_dedup(docs) and sum(r[1] for r in got.values()) == 40


def test_edges(make_docs, edges):
    single = [e for e in edges if e[0] is not None and e[0] != 8] + [(None, "one two three four")]
    assert found(make_docs(single, extra=True)) == line_dedup(single)
    assert L.removed_lines(make_docs(edges)).count() == len(edges)
    assert L.removed_lines(make_docs([])).count() == 0


def test_dedup_lines_keeps_columns_and_drops_emptied_documents(make_docs):
    docs = make_docs([(1, "a b c d e\nunique words stand here"), (2, "a b c d e"), (3, "a b c d e\nother line of words"),
                      (4, None), (5, ""), (6, " \n")], extra=True)
    out = L.dedup_lines(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert rows == {1: ("a b c d e\nunique words stand here", 33), 3: ("other line of words", 19), 4: (None, None),
                    5: ("", 0), 6: (" \n", 2)}


def test_plan_has_no_python(make_docs):
    plan = L.removed_lines(make_docs([(1, "a b c d e")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("num,den", [(8, 10), (7, 10), (1, 2), (2, 2)])
def test_other_thresholds_against_brute_force(make_docs, num, den):
    words = ["a", "b", "c", "d", "e", "f"]
    lines = [" ".join(words[:n]) for n in (3, 4, 5, 6, 2, 1)] + ["x y z", "x y z w", "p q r s t", "p q r s", "a b", "x z y"]
    docs = [(i, line) for i, line in enumerate(lines)]
    want, seen = {}, []
    for i, line in docs:
        s = set(line.split())
        want[i] = int(any(den * len(s & o) >= num * len(s | o) for o in seen))
        seen.append(s)
    got = {r["doc"]["doc_id"]: r["n_removed"] for r in L.removed_lines(make_docs(docs), (num, den)).collect()}
    assert got == want


def test_threshold_is_a_fraction(make_docs):
    for bad in ((0, 1), (5, 4)):
        with pytest.raises(ValueError):
            L.removed_lines(make_docs([(1, "a")]), bad)
