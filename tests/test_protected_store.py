"""Stored tables protected batch after batch, the view with its key, and the
tenure join of a person with very many tenures."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from condofin.functions.crypto import decrypt_text, key_column, token_key_column
from condofin.operators.tenure import _spans, tenure_as_of
from condofin.operators.windows import materialize
from condofin.plans import protect as P
from condofin.sources.tables_io import BatchConflict, log_append, log_entries

from helpers import make_tables, payment, person


def pays(ids, month):
    return [payment(i, 1, f"2025-{month:02d}-05 00:00:00", 5, account=f"{i:022d}") for i in ids]


def files(base, table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/{table}/**/*.parquet", recursive=True)}


def masks(spark, base):
    return {r.pago_id: r.cbu_cvu_origen for r in spark.read.parquet(f"{base}/pago").collect()}


def test_a_new_month_rewrites_that_month_only(spark, tmp_dir):
    key, tok, base = key_column(spark), token_key_column(spark), os.path.join(tmp_dir, "s")
    t = make_tables(spark, persona=[person(i, f"{i:022d}") for i in (1, 2, 2_000_005)],
                    pago=pays(range(10, 20), 1) + pays(range(30, 35), 2))
    P.store_for_protection(t, base)
    assert P.protect_stored(spark, base, key, tok) == {"persona": [0, 2], "pago": ["2025-01", "2025-02"]}
    before, old = masks(spark, base), files(base, "pago")
    assert [before[i][-2:] for i in sorted(before)] == ["%02d" % i for i in range(1, 16)]
    # ids below the old ones: the numbers still follow
    P.store_for_protection(make_tables(spark, persona=[person(3, "3" * 22)], pago=pays(range(1, 5), 3)), base)
    assert P.protect_stored(spark, base, key, tok) == {"persona": [0], "pago": ["2025-03"]}
    now = masks(spark, base)
    assert {i: now[i] for i in before} == before
    assert [now[i][-2:] for i in range(1, 5)] == ["16", "17", "18", "19"]
    assert {f: m for f, m in files(base, "pago").items() if "2025-03" not in f} == old
    # late rows of an old month: its other rows keep their bytes
    enc = {r.pago_id: bytes(r.cbu_cvu_origen_enc) for r in spark.read.parquet(f"{base}/pago").collect()}
    P.store_for_protection(make_tables(spark, pago=pays([25], 1)), base, ("pago",))
    assert P.protect_stored(spark, base, key, tok) == {"persona": [], "pago": ["2025-01"]}
    rows = spark.read.parquet(f"{base}/pago").withColumn("clear", decrypt_text(F.col("cbu_cvu_origen_enc"), key)).collect()
    assert {r.pago_id: bytes(r.cbu_cvu_origen_enc) for r in rows if r.pago_id != 25} == enc
    assert all(r.clear == f"{r.pago_id:022d}" for r in rows) and len(rows) == 20
    assert masks(spark, base)[25].endswith("0020")
    persons = spark.read.parquet(f"{base}/persona").collect()
    assert sorted(p.cbu_cvu[-1] for p in persons) == ["1", "2", "3", "4"] and {p.dni for p in persons} == {0}
    assert P.protect_stored(spark, base, key, tok) == {"persona": [], "pago": []}


def test_a_run_that_stops_gives_no_number_twice(spark, tmp_dir, monkeypatch):
    key, tok, base = key_column(spark), token_key_column(spark), os.path.join(tmp_dir, "s")
    P.store_for_protection(make_tables(spark, pago=pays(range(1, 4), 1)), base, ("pago",))
    monkeypatch.setattr(P, "_STORED", {"pago": P._STORED["pago"]})
    real = P.encrypt_text
    monkeypatch.setattr(P, "encrypt_text", lambda c, k: F.expr("assert_true(false, 'stopped')").cast("binary"))
    with pytest.raises(Exception, match="stopped"):
        P.protect_stored(spark, base, key, tok)
    monkeypatch.setattr(P, "encrypt_text", real)
    assert not any(v.startswith("ENC") for v in masks(spark, base).values())
    P.protect_stored(spark, base, key, tok)
    assert sorted(v[-1] for v in masks(spark, base).values()) == ["4", "5", "6"]
    assert len(log_entries(spark, f"{base}/{P.LEDGER}/pago")) == 2
    with pytest.raises(BatchConflict):
        log_append(spark, f"{base}/{P.LEDGER}/pago", "{}", 1)


def test_view_decrypts_with_the_key_it_finds(spark):
    key = bytes(range(32))
    t = make_tables(spark, persona=[person(1, "7" * 22)])
    spark.createDataFrame([(bytearray(key),)], "k binary").createOrReplaceTempView("k0")
    stored = materialize(P.encrypt_columns(t, spark.table("k0").scalar()).persona)
    P.open_views(stored, key)

    def read():
        return spark.sql(f"SELECT cbu_cvu FROM {P.PERSONS_VIEW}").first()[0]
    assert read() == "7" * 22
    P.close_key(spark)
    assert read() is None
    P.open_views(stored, bytes(32))
    assert read() is None
    P._key_view(spark, key)
    assert read() == "7" * 22
    shown = spark.sql(f"SELECT * FROM {P.PERSONS_VIEW}")._jdf.queryExecution().toString()
    assert key.hex() not in shown.lower()


def test_spans_cover_each_day_once(spark):
    rng = random.Random(2)
    pairs = [(a, b) for a, b in ((rng.randrange(1 << 21), rng.randrange(1 << 21)) for _ in range(60)) if a <= b]
    pairs += [(0, (1 << 21) - 1), (5, 5), (0, 0), ((1 << 21) - 1, (1 << 21) - 1), (4, 7), (9, 8)]
    df = spark.createDataFrame(pairs, "lo bigint, hi bigint")
    for r in df.select("lo", "hi", _spans(F.col("lo"), F.col("hi")).alias("s")).collect():
        ranges = sorted((x.place << x.level, (x.place + 1) << x.level) for x in r.s)
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) <= 42
        assert (ranges[0][0], ranges[-1][1]) == (r.lo, r.hi + 1) if r.lo <= r.hi else not ranges


def test_hot_person_is_split_by_time(spark):
    """10^5 tenures and 10^5 payments of one person: no pair is made that
    doesn't meet in time."""
    n = 100_000
    day = F.expr("date_add(date'1970-01-01', cast(id % 20000 as int))")
    tenures = spark.range(n).select(F.lit(1).cast("bigint").alias("persona_id"), F.col("id").alias("uf_id"), day.alias("fecha_desde"),
                                    F.expr("date_add(date'1970-01-01', cast(id % 20000 as int) + 1)").alias("fecha_hasta"),
                                    F.lit("PROPIETARIO").alias("tipo_titularidad"))
    events = spark.range(n).select(F.col("id").alias("pago_id"), F.lit(1).cast("bigint").alias("persona_id"),
                                   day.cast("timestamp_ntz").alias("fecha"))
    out = tenure_as_of(events, tenures, "persona_id", "fecha", keep=("uf_id",), hot=10)
    # five tenures begin on a day and last to the next
    assert out.count() == 5 * 5 * 20000 + 5 * 5 * 19999
    assert "Product" not in out._jdf.queryExecution().executedPlan().toString()


def test_split_join_equals_the_plain_one(spark):
    rng = random.Random(5)

    def day():
        return dt.date(1960, 1, 1) + dt.timedelta(days=rng.randrange(30_000))
    rows = []
    for i in range(400):
        a, b = sorted((day(), day()))
        rows.append((rng.choice([1, 1, 2, 3, 4]), i, rng.choice([a, a, a, None, dt.date(1, 1, 1)]),
                     rng.choice([b, b, None, dt.date(9999, 12, 31), a]), "PROPIETARIO"))
    tenures = spark.createDataFrame(rows, "persona_id bigint, uf_id bigint, fecha_desde date, fecha_hasta date, tipo_titularidad string")
    events = spark.createDataFrame([(i, rng.choice([1, 2, 3, 4, 9, None]),
                                     dt.datetime.combine(day(), dt.time(rng.choice([0, 13])))) for i in range(300)],
                                   "pago_id bigint, persona_id bigint, fecha timestamp_ntz")
    want = sorted(map(tuple, tenure_as_of(events, tenures, "persona_id", "fecha", keep=("uf_id",)).collect()))
    for hot in (0, 60, 1000):
        assert sorted(map(tuple, tenure_as_of(events, tenures, "persona_id", "fecha", keep=("uf_id",), hot=hot).collect())) == want


def test_only_payments_that_may_match_are_decrypted(spark):
    from pyspark.sql import Observation

    from condofin.operators.tenure import match_payments_by_account
    key, tok = key_column(spark), token_key_column(spark)
    t = P.encrypt_columns(make_tables(spark, persona=[person(1, "7" * 22), person(2, "8" * 22, borrado=True)],
                                      pago=pays(range(10, 60), 1) + [payment(1, 1, "2025-01-01 00:00:00", 5, account="7" * 22),
                                                                     payment(2, 1, "2025-01-01 00:00:00", 5, account="8" * 22)]), key, tok)
    pay, per = materialize(t.pago), materialize(t.persona)
    seen = {}
    for prune in (False, True):
        watch = Observation()
        got = match_payments_by_account(pay, per, "decrypt", key, prune=prune, watch=watch).collect()
        assert [(r.pago_id, r.persona_id) for r in got] == [(1, 1)]
        seen[prune] = watch.get["descifradas"]
    assert seen == {False: 52, True: 1}


def test_spans_of_hot_keys_are_never_broadcast(spark):
    """Spark estimates their size without the rows that explode adds."""
    t = make_tables(spark, titularidad=[(1, i, dt.date(2024, 1, i), None, "PROPIETARIO") for i in range(1, 9)])
    pays = spark.createDataFrame([(i, 1, dt.date(2024, 1, 1 + i)) for i in range(9)], "pago_id long, persona_id long, fecha date")
    out = tenure_as_of(pays, t.titularidad, "persona_id", "fecha", keep=("uf_id",), hot=1)
    assert out.count() == 8 + sum(range(1, 9))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    (split,) = [line for line in plan.splitlines() if "s__e" in line and "Join" in line]
    assert "strategy=merge" in split
