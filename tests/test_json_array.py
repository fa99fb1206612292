"""The splitter of large JSON arrays, against the standard parser and by hand."""

from __future__ import annotations

import gzip
import json
import os
import random
from contextlib import contextmanager

import pytest

from condofin.sources import files as S
from condofin.sources import json_array as J


@contextmanager
def ranges_of(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def write(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())
    return path


def values(df):
    rows = sorted(df.collect(), key=lambda r: (r.file, r.block, r.n))
    return [r.value.strip() for r in rows]


def documents(n, seed):
    rng = random.Random(seed)
    odd = ['a"b', "back\\slash", "br{ace}", "[x]", ",", "}", "{", "\\", '\\"', "línea\nnueva", "é ", "", "]},{"]
    return [{"Nombre del consorcio": rng.choice(odd) + str(i), "_id": {"$oid": "%x" % i, "in": [1, {"k": rng.choice(odd)}]},
             "BANCARIOS": rng.choice(odd)} for i in range(n)]


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_elements_at_any_split(spark, tmp_dir, size, indent):
    docs = documents(120 if size > 100 else 40, size)
    path = write(tmp_dir, "a.json", json.dumps(docs, indent=indent))
    with ranges_of(spark, size):
        got = J.read_json_elements(spark, path)
        assert [json.loads(v) for v in values(got)] == docs
        if size < 1000:
            assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10


def test_many_files_and_shapes(spark, tmp_dir):
    one = documents(3, 1)
    write(tmp_dir, "a.json", "﻿" + json.dumps(one))
    write(tmp_dir, "b.json", "\n".join(map(json.dumps, one)))
    write(tmp_dir, "c.json", "[ ]")
    write(tmp_dir, "d.json", '[1, "x, y", null, [2, {"z": 3}], {"a": 1}, ]')
    write(tmp_dir, "e.json", "")
    write(tmp_dir, "f.json", '{"a": 1}')
    with ranges_of(spark, 50):
        got = J.read_json_elements(spark, tmp_dir)
        assert {os.path.basename(f): [json.loads(v) for v in values(got.where(got.file == f))]
                for f in [r.file for r in got.select("file").distinct().collect()]} == {
            "a.json": one, "b.json": one, "d.json": [1, "x, y", None, [2, {"z": 3}], {"a": 1}], "f.json": [{"a": 1}]}
    packed = write(tmp_dir, "g.json.gz", gzip.compress(json.dumps(one).encode()))
    assert [json.loads(v) for v in values(J.read_json_elements(spark, packed))] == one


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_damage_stays_where_it_is(spark, tmp_dir, size):
    good = [{"Nombre del consorcio": "C%d" % i, "Mes": "mayo", "LIMPIEZA": "1,00"} for i in range(6)]
    a, b, c, d, e, f = (json.dumps(g, indent=1) for g in good)
    bad = ['{"Nombre del consorcio": "sin comilla,\n "Mes": "abril"}', '{"Mes": }', '{"x": 1} y', '{"_id": "solo"}', "7"]
    path = write(tmp_dir, "a.json", "[" + ",\n".join([a, bad[0], b, bad[1], c, bad[2], d, bad[3], e, bad[4], f]) + "]")
    with ranges_of(spark, size):
        docs = S.read_cost_documents(spark, path)
        costs = S.clean_service_costs(docs)
        assert {r.consorcio_nombre for r in costs.collect()} == {"C%d" % i for i in range(6)} | {"sin comilla,\n"} - {"sin comilla,\n"}
        gone = sorted((r.falla, r.value.strip()) for r in S.rejected_documents(docs).collect())
    # text after a closing brace is an element of its own: the brace before it is whole
    assert gone == sorted([("json", bad[0]), ("json", bad[1]), ("consorcio", '{"x": 1}'), ("json", "y"),
                           ("consorcio", bad[3]), ("json", bad[4])])
    assert docs.count() == 6 + len(gone)


def test_cut_files(spark, tmp_dir):
    """Files that end too early: what is whole is imported, the rest is a reject."""
    text = '[{"Nombre del consorcio": "A", "LIMPIEZA": "12,00"}, {"Nombre del consorcio": "B", "LIMPIEZA": "12'
    for end, names, faults in ((len(text), ["A"], 1), (text.index("}") + 1, ["A"], 0), (text.index("}"), [], 1)):
        path = write(tmp_dir, f"{end}.json", text[:end])
        docs = S.read_cost_documents(spark, path)
        assert sorted({r.consorcio_nombre for r in S.clean_service_costs(docs).collect()}) == names
        assert S.rejected_documents(docs).count() == faults


def test_missing_brace_is_one_reject(spark, tmp_dir):
    path = write(tmp_dir, "a.json", '[{"Nombre del consorcio": "A"}, {"a": 1, {"b": 2}, {"c": 3}]')
    docs = S.read_cost_documents(spark, path)
    assert [r.falla for r in S.rejected_documents(docs).collect()] == ["json"]
    assert {r.consorcio_nombre for r in S.clean_service_costs(docs).collect()} == {"A"}


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_long_elements_come_in_parts(spark, tmp_dir, monkeypatch, size):
    monkeypatch.setattr(J, "MOST", 100)
    docs = ['{"Nombre del consorcio": "A"}', '{"long": [%s]}' % ",".join(['{"k": 1}'] * 90), '{"Nombre del consorcio": "B"}']
    path = write(tmp_dir, "a.json", "[" + ",".join(docs) + "]")
    with ranges_of(spark, size):
        checked = S.read_cost_documents(spark, path)
        assert {r.consorcio_nombre for r in S.clean_service_costs(checked).collect()} == {"A", "B"}
        parts = sorted(checked.where("falla = 'largo'").collect(), key=lambda r: (r.block, r.n))
    assert len(parts) > 1 and "".join(r.value for r in parts) == docs[1]
