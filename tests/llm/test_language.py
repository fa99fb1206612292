import random
import zlib

import numpy as np
import pytest

from condofin.llm import language as G

SYLLABLES = {"en": ["th", "ing", "er", "wh", "on", "ed"], "de": ["sch", "ung", "ei", "ü", "ch", "keit"],
             "fr": ["eau", "tion", "é", "oi", "que", "le"]}


def texts(lang, n, seed, low=3, high=80):
    rng = random.Random(f"{lang}{seed}")
    return [" ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4)))
                     for _ in range(rng.randrange(low, high))) for _ in range(n)]


def corpus():
    rows, i = [], 0
    for lang in SYLLABLES:
        for t in texts(lang, 120, 1):
            rows.append((i, t, lang))
            i += 1
    return rows


def brute_counts(text):
    x = [c if c.isalpha() else " " for c in text.lower()]
    return sum(1 for n in (1, 2, 3) for i in range(len(x) - n + 1) if any(c != " " for c in x[i:i + n]))


@pytest.mark.parametrize("chunk", [1 << 16, 5])
def test_ngram_counts(monkeypatch, chunk):
    monkeypatch.setattr(G, "CHUNK", chunk)
    for t in ["a", "Ab c", "ééé 12 日本", " x ", "abc" * 20]:
        assert G.ngram_counts(t.encode()).sum() == brute_counts(t)
    for t in (None, "", "123 !?", "\u0301 -"):
        assert G.ngram_counts(None if t is None else t.encode()) is None
    whole = G.ngram_counts(b"one two three four")
    monkeypatch.setattr(G, "CHUNK", 4)
    assert (G.ngram_counts(b"one two three four") == whole).all()


def test_held_out_accuracy(make_docs):
    docs = make_docs(corpus())
    rows = G.identify(docs, G.learn(docs)).withColumn("held", G.held_out("doc.doc_id")).collect()
    held = [r for r in rows if r["held"]]
    assert {r["doc"]["doc_id"] for r in held} == {i for i, *_ in corpus() if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == r["doc"]["lang"] for r in held) >= 0.97 * len(held)
    assert not any(r["rejected"] for r in rows if len(r["doc"]["text"]) > 60)


def test_far_texts_are_rejected(make_docs):
    model = G.learn(make_docs(corpus()))
    rng = random.Random(1)
    for alphabet in ("абвгдежзийклмнопрст", "".join(chr(0x4E00 + i) for i in range(500))):
        t = " ".join("".join(rng.choice(alphabet) for _ in range(6)) for _ in range(80))
        lang, score, rejected = model.predict(t.encode())
        assert rejected and lang in SYLLABLES and 0 <= score < 0.3


def test_prediction_reads_nothing_but_the_text(make_docs):
    docs = make_docs(corpus())
    model = G.learn(docs)
    t = texts("fr", 1, 9)[0]
    other = make_docs([(2, t, "en", "x"), (None, t, None, None), (7, t, "de", "y")], extra=True)
    assert len({(r["lang_pred"], r["score"]) for r in G.identify(other, model).collect()}) == 1


def test_learning_uses_no_held_out_row(make_docs):
    rows = corpus()
    lies = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a, b = G.learn(make_docs(rows)), G.learn(make_docs(lies + [(None, "zzzz", "yy")]))
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids)


def test_edges(make_docs, edges):
    docs = make_docs([(i, t, None if k % 3 else "en") for k, (i, t) in enumerate(edges)], extra=True)
    rows = G.identify(docs, G.learn(docs)).collect()
    assert len(rows) == len(edges)
    for r in rows:
        letters = any(c.isalpha() for c in r["doc"]["text"] or "")
        assert r["lang_pred"] == ("en" if letters else "und") and 0 <= r["score"] <= 1
        assert r["rejected"] or letters
    none = make_docs([(1, "abc", None)])
    assert [r["lang_pred"] for r in G.identify(none, G.learn(none)).collect()] == ["und"]
    assert G.identify(make_docs([]), G.learn(make_docs([]))).count() == 0


def test_fit_is_bounded(make_docs):
    model = G.learn(make_docs(corpus()), fit_docs=30)
    assert model.languages and len(model.languages) <= 12
    with pytest.raises(ValueError):
        G.learn(make_docs([(i, "a b c", f"l{i}") for i in range(20)]), fit_docs=3)


def test_sample_has_each_languages_least_distinct_texts(make_docs, monkeypatch):
    """Copies count once, no language is left out, the bound holds exactly."""
    fitted, fit_centroids = [], G.fit_centroids
    monkeypatch.setattr(G, "fit_centroids", lambda v, langs: fitted.append((v, langs)) or fit_centroids(v, langs))
    few = texts("de", 2, 3)
    rows = [(t, "en") for t in texts("en", 120, 2)] + [(t, "fr") for t in texts("fr", 120, 2)]
    rows += [(t, "de") for t in few for _ in range(150)] + [(few[0], "fr")] * 40 + [("12 34", "de"), (None, "de")]
    rows += [(t, "en") for t in texts("en", 3, 5) for _ in range(100)]
    G.fit(make_docs([(i, *r) for i, r in enumerate(rows)]), 30)
    vectors, langs = fitted.pop()
    assert {x: langs.count(x) for x in langs} == {"en": 10, "fr": 10, "de": 2}
    assert len({(x, v.tobytes()) for x, v in zip(langs, vectors)}) == len(langs)
    many = make_docs([(i, f"{t} {t}", f"l{i % 40}") for i, t in enumerate(texts("en", 200, 4))])
    G.fit(many, 60)
    assert sorted(fitted.pop()[1]) == sorted(f"l{i}" for i in range(40))
    monkeypatch.setattr(G, "FIT_DOCS", 7)
    G.fit(many)
    assert sorted(fitted.pop()[1]) == sorted(f"l{i}" for i in range(40))


def brute_model(rows, model):
    """Prediction by hand: TF-IDF over all rows, cosine, nearest centroid, floors."""
    counts = [G.ngram_counts(t.encode()) for _, t, _ in rows]
    df = sum((c > 0).astype(int) for c in counts)
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    assert np.allclose(idf, model.idf, rtol=1e-5)

    def near(c):
        v = np.log1p(c) * idf
        cosines = [float(v @ z / np.linalg.norm(v)) for z in model.centroids]
        best = max(range(len(cosines)), key=lambda j: cosines[j])
        return model.languages[best], min(1.0, max(0.0, cosines[best]))
    by_class = {}
    for c in counts:
        by_class.setdefault(int(np.log2(c.sum() + 1)), []).append(near(c)[1])
    floors = []
    for k in range(max(by_class) + 1):
        group, low, high = list(by_class.get(k, [])), k, k
        while len(group) < G.CLASS_DOCS and (low > 0 or high < max(by_class)):
            low, high = (low - 1, high) if low > 0 else (low, high + 1)
            group += by_class.get(low if low < k and high == k else high, [])
        group = sorted(group)
        floors.append(G.REJECT_BELOW * group[int(G.LOW * len(group))] if group else 0.0)
    return near, floors


def test_against_brute_force(make_docs):
    rows = [r for r in corpus()] + [(1000 + i, t, "en") for i, t in enumerate(texts("en", 60, 8, 1, 3))]
    model = G.fit(make_docs(rows))
    near, floors = brute_model(rows, model)
    assert len(floors) == len(model.floor)
    assert all(abs(a - b) <= 2 / G.BINS for a, b in zip(floors, model.floor)), (floors, model.floor)
    for lang in SYLLABLES:
        for t in texts(lang, 25, 77) + texts(lang, 5, 78, 1, 2):
            lang_pred, score, rejected = model.predict(t.encode())
            want = near(G.ngram_counts(t.encode()))
            assert lang_pred == want[0] and abs(score - want[1]) < 1e-5
            assert rejected == (score < model.floor[min(G.length_class(G.ngram_counts(t.encode())), len(model.floor) - 1)])


def test_many_languages_have_a_bound(make_docs):
    """A dirty language column: the values with the most texts are learned."""
    rows = corpus() + [(5000 + i, t, f"dirt{i}") for i, t in enumerate(texts("en", 300, 6))]
    model = G.fit(make_docs(rows), languages=5)
    assert set(SYLLABLES) < set(model.languages) and set(model.languages) - set(SYLLABLES) == {"dirt0", "dirt1"}
    assert len(model.languages) <= 5 * G.CENTROIDS


def test_query(spark):
    from condofin.llm.queries import op10_language_id
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op10_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    right = 0
    for r in rows:
        text = docs[r["doc_id"]].text
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        right += r["held_out"] and r["lang_pred"] == docs[r["doc_id"]].lang
    assert right >= 0.95 * sum(r["held_out"] for r in rows)
