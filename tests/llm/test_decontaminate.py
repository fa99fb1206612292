import random

import pytest
from pyspark.sql import functions as F

from condofin.llm import decontaminate as D

from .brute import contamination, folded_words, random_texts


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def found(docs, items, **kw):
    rows = D.match_benchmark(docs, items, keep=["doc_id", "text"], **kw).collect()
    return sorted(((r["doc"]["doc_id"], r["doc"]["text"], r["n_words"], r["n_hit"], list(r["items"])) for r in rows),
                  key=repr)


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 5), (3, 2), (4, 1)])
def test_against_brute_force(spark, make_docs, seed, window):
    texts = random_texts(60, seed, vocabulary=12)
    rng = random.Random(seed)
    items = []
    for i in range(12):
        ws = folded_words(rng.choice(texts)) or ["x"]
        at = rng.randrange(len(ws))
        items.append((i % 10, ", ".join(ws[at:at + rng.choice([1, 4, 13, 30])]).upper()))
    items += [(None, "w1 w2 w4 w5"), (20, ""), (21, None), (22, "...")]
    got = found(make_docs(list(enumerate(texts))), bench(spark, items), window=window)
    want = sorted(((i, t, *w) for (i, t), w in zip(enumerate(texts), contamination(texts, items, window))), key=repr)
    assert got == want


def test_blocks_give_the_same(spark, make_docs, monkeypatch):
    texts = random_texts(40, 9, vocabulary=10)
    items = [(i, t[:200]) for i, t in enumerate(texts[:15])]
    docs = make_docs(list(enumerate(texts)))
    whole = found(docs, bench(spark, items))
    monkeypatch.setattr(D, "BLOCK_WORDS", 60)
    monkeypatch.setattr(D, "PIECE_WORDS", 30)
    assert found(docs, bench(spark, items)) == whole


def test_edges(spark, make_docs, edges):
    items = [(1, "one two three"), (2, "日本語"), (3, "long5 long6 long7 long8 long9 long10 long11 long12 long13 "
                                                    "long14 long15 long16 long17 long18")]
    got = found(make_docs(edges, extra=True), bench(spark, items))
    texts = [e[1] for e in edges]
    plain = contamination([t for t in texts if not t or len(t) < 10_000], items)
    assert [g[2:] for g in got if not g[1] or len(g[1]) < 10_000] == [
        w for _, w in sorted(zip([(e[0], e[1]) for e in edges if not e[1] or len(e[1]) < 10_000], plain), key=repr)]
    long = next(g for g in got if g[1] and len(g[1]) > 10_000)
    assert long[2] == 150_000 and long[4] == ["3"] and long[3] == 14 * len([i for i in range(150_000 - 13) if i % 997 == 5])
    assert D.match_benchmark(make_docs([]), bench(spark, items)).count() == 0
    assert {r["n_hit"] for r in D.match_benchmark(make_docs(edges), bench(spark, [])).collect()} == {0}


def test_decontaminate_cuts_spans_and_drops_documents(spark, make_docs):
    passage = " ".join("p%d" % i for i in range(13))
    clean = "Nothing\tof  it here."
    little = " ".join("x%d" % i for i in range(400)) + ". " + passage.upper() + "! " + "the end"
    docs = make_docs([(1, clean), (2, passage), (3, little), (4, None), (5, little)], extra=True)
    out = {r["doc_id"]: r for r in D.decontaminate(docs, bench(spark, [(1, passage)])).collect()}
    assert set(out) == {1, 3, 4, 5} and out[1]["text"] == clean and out[4]["text"] is None
    assert out[3]["text"] == " ".join("x%d" % i for i in range(400)) + ".  ! the end"
    assert out[3]["n_chars"] == len(out[3]["text"]) and out[1]["n_chars"] == len(clean)
    assert D.decontaminate(docs, bench(spark, [(1, passage)])).columns == docs.columns


def test_longest_match_is_tracked(spark, make_docs):
    item = " ".join("q%d" % i for i in range(40))
    docs = make_docs([(1, "a b " + " ".join("q%d" % i for i in range(5, 25)) + " c")])
    row = D.match_benchmark(docs, bench(spark, [(1, item)])).first()
    assert (row["longest"], row["n_hit"], [tuple(s) for s in row["spans"]]) == (20, 20, [(2, 22)])
    assert not D.match_benchmark(docs, bench(spark, [(1, item)])).where(F.col("n_words") != 23).count()
