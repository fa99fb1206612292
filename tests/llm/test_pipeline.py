"""The pipeline's rows against a brute-force version, stage by stage."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from condofin.llm import language as G

from .brute import contamination, line_dedup, simhash_components, targets
from .conftest import EDGES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5
    outs = []
    for _, stage in P.STAGES:
        outs.append(P.materialize(stage(spark, docs, SF)))
        if len(outs) < 5:
            assert outs[-1].columns == spark.read.parquet(f"{SF}/documents.parquet").columns
        docs = outs[-1]
    start = by_id(spark.read.parquet(f"{SF}/documents.parquet"))
    lang, lines, sim, clean, mixed = map(by_id, outs)
    model = G.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    assert lang == {i: r for i, r in start.items() if not model.predict((r["text"] or "").encode())[2]}
    want = {}
    for i, (n, gone, kept) in line_dedup([(i, r["text"]) for i, r in lang.items()]).items():
        if not gone:
            want[i] = lang[i]
        elif kept.split():
            want[i] = {**lang[i], "text": kept, "n_chars": len(kept)}
    assert lines == want
    comp = dict(zip(lines, (c for _, c in simhash_components([(i, r["text"]) for i, r in lines.items()]))))
    assert sim == {i: r for i, r in lines.items() if comp[i] == i}
    judged = dict(zip(sim, contamination([r["text"] for r in sim.values()], items)))
    assert set(clean) == {i for i, (n, hit, _) in judged.items() if not (hit and 20 * hit >= n)}
    for i, r in clean.items():
        if not judged[i][1]:
            assert r == sim[i]
        else:
            assert contamination([r["text"]], items)[0][1] < judged[i][1] and r["n_chars"] == len(r["text"])
    sizes = {}
    for r in clean.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    goal = targets(sizes)
    assert set(mixed) <= set(clean) and all(1 <= r["copies"] <= 3 for r in mixed.values())
    for i, r in mixed.items():
        assert r["target"] == pytest.approx(goal[r["source"]]) and r["taken"] == r["copies"] * r["size"]
        assert {k: r[k] for k in clean[i]} == clean[i]
    for s, g in goal.items():
        got = sum(r["taken"] for r in mixed.values() if r["source"] == s)
        most = max(len(r["text"].split()) for r in clean.values() if r["source"] == s)
        assert abs(got - g) <= most
    assert by_id(entry.queries()["pipeline"](spark, SF)) == mixed


@pytest.mark.parametrize("rows", [EDGES, []], ids=["edges", "empty"])
def test_every_stage_takes_edge_cases(spark, make_docs, rows):
    docs = make_docs(rows, extra=True)
    for name, stage in P.STAGES:
        out = P.materialize(stage(spark, docs, SF))
        if name != "mixing_to_weights":
            assert out.columns == docs.columns
        assert out.count() <= len(rows)


def test_queries_against_oracles(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        if name.startswith("op"):
            got = sorted(map(tuple, entry.queries()[name](spark, SF).collect()))
            cols = entry.queries()[name](spark, SF).columns
            want = sorted(map(tuple, con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()))
            assert got == want, name
