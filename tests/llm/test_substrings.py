import numpy as np
import pytest

from condofin.llm import substrings as S

from .brute import random_texts, repeats


def found(docs, window):
    rows = S.remove_repeats(docs, window).collect()
    return sorted(((r["doc"]["doc_id"], r["doc"]["text"], r["n_words"], r["n_removed"], r["kept"]) for r in rows), key=repr)


@pytest.mark.parametrize("seed,window,group", [(1, 50, 1 << 20), (2, 50, 2000), (3, 3, 500), (4, 1, 3000)])
def test_against_brute_force(make_docs, monkeypatch, seed, window, group):
    monkeypatch.setattr(S, "GROUP_BYTES", group)
    monkeypatch.setattr(S, "CHUNK", 37)
    texts = random_texts(80, seed)
    docs = [(i * 7 % 80 if i % 11 else 5, t) for i, t in enumerate(texts)]
    got = found(make_docs(docs), window)
    want = sorted(((i, t, *w) for (i, t), w in zip(docs, repeats(docs, window))), key=repr)
    assert got == want


def test_edges(make_docs, edges):
    more = edges + [(12, edges[-1][1]), (13, " ".join("long%d" % i for i in range(60)))]
    got = {(g[0], g[1]): g[2:] for g in found(make_docs(more, extra=True), 50)}
    long = edges[-1][1]
    assert got[(11, long)][1] == 0 and got[(12, long)][1] == 150_000
    assert got[(13, more[-1][1])] == (60, 60, "")
    assert got[(1, None)] == (0, 0, "") and got[(2, "")] == (0, 0, "")
    assert S.remove_repeats(make_docs([])).count() == 0
    assert len(found(make_docs(more), 50)) == len(more)


def test_rolling_hash_equals_window_by_window():
    rng = np.random.default_rng(1)
    words = [b"w%d" % i for i in rng.integers(0, 9, 500)]
    rolling = S.RollingHash(4)
    a, b = rolling.of(words)
    single = [rolling.of(words[i:i + 4]) for i in range(len(words) - 3)]
    assert a.tolist() == [int(x[0]) for x, _ in single] and b.tolist() == [int(y[0]) for _, y in single]
    by_words = {}
    for i in range(len(a)):
        by_words.setdefault(tuple(words[i:i + 4]), set()).add((int(a[i]), int(b[i])))
    assert all(len(v) == 1 for v in by_words.values()) and len(set.union(*by_words.values())) == len(by_words)


def test_ids_round_trip():
    for ids in ([5], [-9, -9, 0, 70_000], [0, 1 << 40], [3, 4, 4, 5]):
        assert S._decode(S._encode(np.array(ids, dtype=np.int64))).tolist() == ids


def test_rows_of_one_id_and_text_are_not_gathered(make_docs, monkeypatch):
    """A third of the rows repeat an id and its text: one is looked at."""
    monkeypatch.setattr(S, "COPIES", 20)
    largest = []
    remove = S._remove
    monkeypatch.setattr(S, "_remove", lambda docs, *a: largest.append(
        docs.groupBy("doc.doc_id", "doc.text").count().agg({"count": "max"}).first()[0]) or remove(docs, *a))
    texts = random_texts(40, 6)
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0])] * 60 + [(9, texts[1] + " more")] * 50
    docs += [(90, texts[1] + " more")] * 30 + [(None, None)] * 40
    got = found(make_docs(docs, extra=True), 5)
    assert got == sorted(((i, t, *w) for (i, t), w in zip(docs, repeats(docs, 5))), key=repr)
    assert largest and max(largest) <= 20


def test_columns_beside_a_repeated_id_and_text_stay(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES", 3)
    df = spark.createDataFrame([(1, "a b c", i) for i in range(10)] + [(2, "a b c", 99)], "doc_id bigint, text string, n_words int")
    rows = S.remove_repeats(df, 2).collect()
    assert sorted((r["doc"]["doc_id"], r["doc"]["n_words"], r["n_removed"]) for r in rows) == [(1, i, 0) for i in range(10)] + [(2, 99, 3)]
