"""Exact quotients and shares, against whole-number arithmetic."""

from __future__ import annotations

import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from condofin.functions.columns import with_shares
from condofin.functions.exact import quotient, with_quotients


def rounded(a, p, q):
    """a * p / q at six places, halves away from zero, by whole numbers."""
    n, d = (x * 10 ** 6 for x in (a * p, q))
    n, d = int(a * 10 ** 6) * int(p * 10 ** 6), int(q * 10 ** 6)
    sign = -1 if (n < 0) != (d < 0) and n else 1
    n, d = abs(n), abs(d)
    return D(sign * ((2 * n + d) // (2 * d))).scaleb(-6)


def test_quotients(spark):
    rng = random.Random(7)
    rows = []
    for digits in (3, 8, 13, 19, 26):
        for _ in range(60):
            q = D(rng.randrange(1, 10 ** digits)) / 100
            p = D(rng.randrange(0, 10 ** digits)) / 100
            p = min(p, q) if rng.random() < 0.8 else p
            a = D(rng.randrange(0, 10 ** min(digits, 20))) / rng.choice([1, 100])
            if a * p / q < 10 ** 24 and int(p / q) < 10 ** 16:
                rows.append((rng.choice([1, 1, -1]) * a, rng.choice([1, 1, -1]) * p, q))
    rows += [(D(1), D(1), D(3)), (D(2), D(1), D(3)), (D("0.5"), D("0.000001"), D(1)), (D("0.499999"), D("0.000001"), D(1)),
             (D(10) ** 14, D(1), D(3)), (D(10) ** 16 - 1, D(10) ** 20 + 1, D(3) * D(10) ** 20), (D(0), D(0), D(5)),
             (D(9), D(7), D(7)), (D(10) ** 12, D(10) ** 11, D(10) ** 11)]
    df = spark.createDataFrame(rows, "a decimal(32,6), p decimal(32,6), q decimal(32,6)")
    got = df.select("a", "p", "q", quotient(F.col("a"), F.col("p"), F.col("q")).alias("x")).collect()
    assert [r.x for r in got] == [rounded(r.a, r.p, r.q) for r in got]
    staged = with_quotients(df, F.col("a"), {"x": F.col("p")}, F.col("q"))
    assert staged.columns == [*df.columns, "x"] and sorted(map(tuple, staged.collect())) == sorted(map(tuple, got))
    none = spark.createDataFrame([(D(1), D(1), D(0)), (None, D(1), D(1))], "a decimal(18,2), p decimal(18,2), q decimal(18,2)")
    assert [r[0] for r in none.select(quotient(F.col("a"), F.col("p"), F.col("q"))).collect()] == [None, None]


def test_shares_add_up(spark):
    rng = random.Random(3)
    rows = [(D(10) ** 14 + D(i) / 100, *[D(rng.randrange(0, 10 ** rng.choice([2, 9, 17]))) / 100 for _ in range(3)]) for i in range(200)]
    rows = [r for r in rows if sum(r[1:])]
    df = spark.createDataFrame(rows, "a decimal(18,2), x decimal(38,6), y decimal(38,6), z decimal(38,6)")
    names = ["s0", "s1", "s2"]
    out = with_shares(df, F.col("a"), [F.col(c) for c in "xyz"], names)
    assert out.columns == [*df.columns, *names]
    for r in out.collect():
        assert sum(r[n] for n in names) == r.a
        for c, n in zip("xyz", names):
            assert abs(r[n] - rounded(r.a, r[c], r.x + r.y + r.z)) <= D("0.000001")
