import random

import numpy as np
import pytest

from condofin.llm import vectors as V

from .brute import cosine, groups


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    return df.withColumnsRenamed({"label": "key"}) if extra else df


def valid(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def want(rows):
    def linked(i, j):
        a, b = rows[i][1], rows[j][1]
        return valid(a) and valid(b) and len(a) == len(b) and cosine(a, b) >= 0.9
    comp = groups(len(rows), linked)
    least = {}
    for (i, *_), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((r[0], sum(linked(k, j) for j in range(len(rows)) if j != k), least.get(comp[k]),
                    r[0] == least.get(comp[k])) for k, r in enumerate(rows)), key=repr)


def found(df):
    return sorted((tuple(r) for r in V.near_duplicates(df).collect()), key=repr)


def planted(n, dims, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            v = np.array(out[rng.integers(len(out))]) + rng.normal(0, rng.choice([0, 0.05, 0.12, 0.2]), dims)
        else:
            v = rng.normal(0, 1, dims)
        out.append(np.float32(v * rng.choice([1, 3.5])).tolist())
    return out


@pytest.mark.parametrize("dims,cell,tile", [(8, 10, 7), (16, 25, 1024), (3, 5, 4)])
def test_against_brute_force(spark, monkeypatch, dims, cell, tile):
    """Every link is found with many small cells and tiles."""
    monkeypatch.setattr(V, "CELL", cell)
    monkeypatch.setattr(V, "TILE", tile)
    rows = [(i * 3 % 151, v, 0) for i, v in enumerate(planted(150, dims, dims))]
    assert found(frame(spark, rows)) == want(rows)


def test_edges(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 2.0], None), (5, [1.0, float("nan"), 1.0], 0),
            (6, [float("inf"), 1.0, 1.0], 0), (7, a, 0), (8, a, 0), (8, a, 0), (None, a, 1), (9, [2.0, 4.0, 6.0], 0),
            (10, [1.0, 2.0], 0), (11, [1.0, 2.0, 3.0, 0.0], 0), (12, [1e-30, 2e-30, 3e-30], 0), (None, [0.0, 1.0], 0)]
    assert found(frame(spark, rows, extra=True)) == want(rows)
    assert V.near_duplicates(frame(spark, [])).count() == 0
    assert found(frame(spark, rows[:3])) == want(rows[:3])


def test_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(V, "TILE", 16)
    rng = random.Random(2)
    base = [rng.gauss(0, 1) for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.02) for x in base], 0) for i in range(200)]
    got = found(frame(spark, rows))
    assert {g[1] for g in got} == {199} and {g[2] for g in got} == {0}
