"""Distributed order operators, protection, XML and registration."""

from __future__ import annotations

import glob
import os
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from condofin.functions.crypto import key_column, token_key_column
from condofin.model import ORDINARIO
from condofin.operators.allocate import cumulative_by_day, weighted_interval_totals
from condofin.operators.windows import dense_row_number, running_total
from condofin.params import ReportParams
from condofin.plans import reports as R
from condofin.plans.ingest import RegistrationError, register_entities
from condofin.plans.protect import decrypt_view, encrypt_columns, protect_tables
from condofin.plans.xml_out import write_weekly_cash_flow_xml

from helpers import bill, charge, make_tables, payment, person, tenure, unit

P = ReportParams(None, "2024-01-01", "2025-12-31")


def test_running_total_equals_single_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(2020, 2022), rnd.randint(1, 53), b, rnd.randint(0, 10_000))
            for b in range(30) for _ in range(5)]
    rows = list({(y, w, b): (y, w, b, v) for y, w, b, v in rows}.values())
    df = spark.createDataFrame(rows, "y int, w int, b int, v long")
    ours = running_total(df, "v", ["y", "w", "b"], "acc", "mean")
    full = df.withColumn("acc", F.sum("v").over(Window.orderBy("y", "w", "b").rowsBetween(
        Window.unboundedPreceding, 0)))
    a = sorted((r.y, r.w, r.b, r.acc) for r in ours.collect())
    b = sorted((r.y, r.w, r.b, r.acc) for r in full.collect())
    assert a == b
    mean = sum(v for *_, v in rows) / len(rows)
    assert {round(r.mean, 9) for r in ours.collect()} == {round(mean, 9)}


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_row_number_matches_row_number(spark, parts):
    rnd = random.Random(parts)
    ids = rnd.sample(range(10**9), 2000) + list(range(500))  # sparse ids plus a dense run
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.rn for r in dense_row_number(df, "id", "rn", num_partitions=parts).collect()}
    want = {i: n for n, i in enumerate(sorted(ids), start=1)}
    assert got == want


def test_interval_sums_equal_brute_force(spark):
    rnd = random.Random(11)
    import datetime as dt
    base = dt.date(2024, 1, 1)
    daily = {}
    for _ in range(300):
        k, d = rnd.randint(1, 3), base + dt.timedelta(days=rnd.randint(0, 90))
        daily[(k, d)] = daily.get((k, d), 0) + rnd.randint(1, 100)
    ddf = spark.createDataFrame([(k, d, v) for (k, d), v in daily.items()], "k int, d date, v long")
    cum = cumulative_by_day(ddf, "k", "d", "v")
    spans = {k: (min(d for kk, d in daily if kk == k), max(d for kk, d in daily if kk == k)) for k in (1, 2, 3)}
    ivs = []
    for i in range(100):
        k = rnd.randint(1, 3)
        lo = spans[k][0] + dt.timedelta(days=rnd.randint(0, 40))
        hi = min(lo + dt.timedelta(days=rnd.randint(0, 60)), spans[k][1])
        if lo <= hi:
            ivs.append((i, k, lo, hi))
    ivs += [(1000 + k, k, *spans[k]) for k in (1, 2, 3)]
    total = {k: sum(v for (kk, _), v in daily.items() if kk == k) for k in (1, 2, 3)}
    idf = spark.createDataFrame([(i, k, lo, hi, *spans[k], total[k], 1) for i, k, lo, hi in ivs],
                                "i int, k int, lo date, hi date, d0 date, d1 date, all long, w int")
    got = {r.i: r.weighted_sum for r in
           weighted_interval_totals(idf, cum, "k", "d", ("lo", "hi"), ("d0", "d1", "all"), "w", ["i"]).collect()}
    want = {i: sum(v for (kk, d), v in daily.items() if kk == k and lo <= d <= hi) for i, k, lo, hi in ivs}
    assert got == want


def test_days_between_payments_hot_unit_brute_force(spark):
    """One unit holds most payments, several per day: LEAD by unit, exactly."""
    rnd = random.Random(5)
    acc = "0" * 21 + "1"
    pays = []
    import datetime as dt
    for i in range(1, 400):
        day = dt.datetime(2025, 1, 1) + dt.timedelta(days=rnd.randint(0, 30), hours=rnd.choice([0, 0, 9, 17]))
        pays.append(payment(i, 1, day.isoformat(sep=" "), 10))
    t = make_tables(spark, unidad=[unit(7)], persona=[person(1, acc)],
                    titularidad=[tenure(1, 7, "2024-01-01")], expensa=[bill()],
                    charges=[charge(1, ORDINARIO, 100)], pago=pays)
    key = lambda r: (r[0], r[1] or dt.datetime.max)
    got = sorted(((r.fecha_pago, r.fecha_pago_siguiente, r.dias_hasta_siguiente_pago)
                  for r in R.days_between_payments(t, P).collect()), key=key)
    dates = sorted(p[2] for p in pays)
    want = sorted(((d, n, (float((n.date() - d.date()).days) if n else None))
                   for d, n in zip(dates, dates[1:] + [None])), key=key)
    assert got == want


def test_encrypt_decrypt_round_trip_and_masking(spark):
    key = key_column(spark)
    acc = "0000000000000000000042"
    t = make_tables(spark, persona=[person(1, acc), person(2, "0" * 22, borrado=True)],
                    pago=[payment(1, 1, "2025-01-01 00:00:00", 1, account=acc),
                          payment(2, 1, "2025-01-01 00:00:00", 1, account=None)])
    enc = encrypt_columns(t, key)
    rows = {r.persona_id: r for r in enc.persona.collect()}
    assert rows[1].cbu_cvu_enc is not None and rows[2].cbu_cvu_enc is None
    assert acc.encode() not in bytes(rows[1].cbu_cvu_enc)
    prot = protect_tables(t, key)
    view = {r.persona_id: r for r in decrypt_view(prot.persona, key, "vw_persona").collect()}
    assert view[1].cbu_cvu == acc and view[1].dni == 30000001 and view[2].dni is None
    masked = {r.persona_id: r for r in prot.persona.collect()}
    assert masked[1].cbu_cvu.startswith("ENC-") and masked[1].email == "[CIFRADO]"
    assert spark.sql("select count(*) c from vw_persona").collect()[0].c == 2


def test_reports_on_protected_tables_equal_clear(spark, tmp_dir):
    key = key_column(spark)
    acc = "0000000000000000000042"
    t = make_tables(spark, unidad=[unit(7)], persona=[person(1, acc)],
                    titularidad=[tenure(1, 7, "2024-01-01")], expensa=[bill()],
                    charges=[charge(1, ORDINARIO, 100)],
                    pago=[payment(1, 1, "2025-03-01 00:00:00", 10, account=acc)])
    clear = R.collections_by_unit_month(t, None, 2025).collect()
    prot = protect_tables(t, key, token_key_column(spark), path=os.path.join(tmp_dir, "prot"))
    dec = R.collections_by_unit_month(prot, None, 2025, mode="decrypt", key=key).collect()
    tok = R.collections_by_unit_month(prot, None, 2025, mode="token").collect()
    assert clear == dec == tok and clear[0].Marzo == 10.0
    assert R.collections_by_unit_month(prot, None, 2025).count() == 0  # masks never match


def test_xml_document(spark, tmp_dir):
    t = make_tables(spark, consorcio=[(1, "Uno", "c", 1, None, False), (2, "Dos", "c", 1, None, False)],
                    expensa=[bill(1, 2), bill(2, 1)],
                    pago=[payment(1, 1, "2025-01-06 00:00:00", 10), payment(2, 2, "2025-01-20 00:00:00", 20),
                          payment(3, 2, "2025-01-07 00:00:00", 5)])
    out = os.path.join(tmp_dir, "w09")
    write_weekly_cash_flow_xml(t, out, P)
    files = glob.glob(os.path.join(out, "part-*"))
    assert len(files) == 1
    root = ET.parse(files[0]).getroot()
    assert root.tag == "FlujoCajaSemanal"
    rows = [(int(e.get("consorcio_id")), int(e.find("Semana").text)) for e in root.findall("Semana")]
    assert rows == [(1, 2), (1, 4), (2, 2)]
    acc = [e.find("Indicadores/AcumuladoProgresivo").text for e in root.findall("Semana")]
    assert root.findall("Semana")[0].find("Recaudacion/TotalSemana").text == "5.00"
    assert acc == ["5.00", "35.00", "15.00"]  # running order is (year, week, building)


def test_register_entities(spark):
    from decimal import Decimal as D
    t = make_tables(spark, unidad=[unit(10)])
    b = spark.createDataFrame([("Nuevo", "Calle 9", 2, D("100"))],
                              "nombre string, direccion string, cant_unidades int, cant_m2_total decimal(10,2)")
    u = spark.createDataFrame([("Nuevo", "Calle 9", "PB", "B", D("50"), D("1")),
                               ("Nuevo", "Calle 9", "PB", "A", D("40"), D("1"))],
                              "nombre string, direccion string, piso string, depto string, "
                              "cant_m2 decimal(10,2), coeficiente decimal(9,4)")
    a = spark.createDataFrame([("Nuevo", "Calle 9", "PB", "A", D("10"), "COCHERA")],
                              "nombre string, direccion string, piso string, depto string, "
                              "m2_accesorio decimal(10,2), tipo_accesorio string")
    reg = register_entities(t, b, u, a)
    assert {r.consorcio_id for r in reg.consorcio.collect()} == {1, 2}
    units = {(r.piso, r.depto): (r.uf_id, r.consorcio_id) for r in reg.unidad.collect()}
    assert units[("PB", "A")] == (11, 2) and units[("PB", "B")] == (12, 2)
    assert [(r.uf_id, r.tipo_accesorio) for r in reg.accesoria.collect()] == [(11, "COCHERA")]
    bad = spark.createDataFrame([("Otro", "X", "1", "A", D("1"), D("1"))], u.schema)
    with pytest.raises(RegistrationError):
        register_entities(t, b, bad, a)


def test_dense_row_number_with_payload_columns(spark):
    """Numbering whole rows (not just ids) stays dense and ordered."""
    rnd = random.Random(9)
    ids = rnd.sample(range(10**7), 5000)
    df = spark.createDataFrame([(i, f"v{i}", i % 7) for i in ids], "id long, v string, g int")
    out = dense_row_number(df, "id", "rn", num_partitions=8)
    got = {r.id: (r.rn, r.v) for r in out.collect()}
    want = {i: (n, f"v{i}") for n, i in enumerate(sorted(ids), start=1)}
    assert got == want


def test_tables_round_trip_through_parquet(spark, tmp_dir):
    from condofin.sources.driver_tables import load_tables
    from condofin.sources.tables_io import read_tables, write_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver data not present")
    t = load_tables(spark, sf)
    base = os.path.join(tmp_dir, "tables")
    write_tables(t, base)
    back = read_tables(spark, base)
    assert "anio" in back.pago.columns
    p = ReportParams(None, "1997-01-01", "1997-12-31")
    direct = sorted(map(tuple, R.collections_by_source(t, p).collect()))
    stored = R.collections_by_source(back, p)
    assert sorted(map(tuple, stored.collect())) == direct
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and "(anio" in plan
    assert sorted(map(tuple, R.collections_by_unit_month(back, None, 1997).collect())) == \
        sorted(map(tuple, R.collections_by_unit_month(t, None, 1997).collect()))


def test_xml_document_split_when_asked(spark, tmp_dir):
    from condofin.plans.xml_out import W09_ROOT, W09_ROW, weekly_cash_flow_struct, write_xml_document
    pays = [payment(i, 1 + i % 2, f"2025-{1 + i % 12:02d}-{1 + i % 27:02d} 00:00:00", 10) for i in range(60)]
    t = make_tables(spark, consorcio=[(1, "Uno", "c", 1, None, False), (2, "Dos", "c", 1, None, False)],
                    expensa=[bill(1, 1), bill(2, 2)], pago=pays)
    out = os.path.join(tmp_dir, "w09parts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep tiny partitions apart
    try:
        rows = weekly_cash_flow_struct(t, P)
        write_xml_document(rows, out, W09_ROOT, W09_ROW, ["_consorcio_id", "Anio", "Semana"], single_file=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(os.path.join(out, "part-*")))
    assert len(files) > 1
    keys = []
    for f in files:
        root = ET.parse(f).getroot()
        assert root.tag == W09_ROOT
        keys += [(int(e.get("consorcio_id")), int(e.find("Anio").text), int(e.find("Semana").text))
                 for e in root.findall(W09_ROW)]
    assert len(keys) == rows.count() and keys == sorted(keys)


def test_expand_counts_chunks_large_counts(spark):
    from condofin.operators.windows import expand_counts
    df = spark.createDataFrame([(1, 25_001), (2, 1), (3, 10_000)], "k int, c long")
    got = {r.k: r.n for r in expand_counts(df, "c", chunk=10_000).groupBy("k").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {1: 25_001, 2: 1, 3: 10_000}


def test_days_between_payments_many_at_one_timestamp(spark):
    acc = "0" * 21 + "1"
    pays = [payment(i, 1, "2025-03-01 10:00:00", 1) for i in range(1, 2501)]
    pays.append(payment(9999, 1, "2025-03-04 00:00:00", 1))
    t = make_tables(spark, unidad=[unit(7)], persona=[person(1, acc)],
                    titularidad=[tenure(1, 7, "2024-01-01")], expensa=[bill()],
                    charges=[charge(1, ORDINARIO, 100)], pago=pays)
    rows = R.days_between_payments(t, P).groupBy("fecha_pago", "dias_hasta_siguiente_pago").count().collect()
    got = sorted((r.fecha_pago.day, r.dias_hasta_siguiente_pago, r["count"]) for r in rows
                 if r.dias_hasta_siguiente_pago is not None)
    assert got == [(1, 0.0, 2499), (1, 3.0, 1)]
    assert R.days_between_payments(t, P).count() == 2501


KEY_SCRIPT = """
import sys
sys.path[:0] = {paths!r}
from pyspark.sql import SparkSession
from condofin.functions.crypto import KEY_CONF, TOKEN_KEY_CONF, key_column, token_key_column
from condofin.plans.protect import decrypt_view, encrypt_columns
from helpers import make_tables, payment, person
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {log!r})
         .config("spark.eventLog.compress", "false").config(KEY_CONF, {key!r})
         .config(TOKEN_KEY_CONF, {token!r}).getOrCreate())
t = make_tables(spark, persona=[person(1, "0" * 22)], pago=[payment(1, 1, "2025-01-01 00:00:00", 1)])
enc = encrypt_columns(t, key_column(spark), token_key_column(spark))
for df in (enc.persona, enc.pago, decrypt_view(enc.persona, key_column(spark))):
    df.collect()
    for mode in ("simple", "extended", "codegen", "cost", "formatted"):
        df.explain(mode)
    print(df._jdf.queryExecution().toString())
spark.stop()
"""


def test_keys_never_printed(tmp_dir):
    """Neither key, in hex or any other radix spelling, shows in any explain
    mode, the query execution's text or the event log of a plain session."""
    import base64
    import subprocess
    import sys
    key, tok = "ab12cd34" * 8, "9f8e7d6c" * 8
    log = os.path.join(tmp_dir, "events")
    os.makedirs(log)
    here = os.path.dirname(os.path.abspath(__file__))
    code = KEY_SCRIPT.format(paths=[os.path.dirname(here), here], log=log, key=key, token=tok)
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    events = "".join(open(os.path.join(d, f), errors="replace").read()
                     for d, _, fs in os.walk(log) for f in fs)
    assert "aes_encrypt" in run.stdout and "SQLExecutionStart" in events
    for secret in (key, tok):
        raw = bytes.fromhex(secret)
        for text in (secret, base64.b64encode(raw).decode()[:-4], ", ".join(str(x - 256 if x > 127 else x) for x in raw[:6])):
            assert text.lower() not in run.stdout.lower()
            assert text.lower() not in events.lower()


def test_tokens_do_not_depend_on_the_aes_key_itself(spark):
    t = make_tables(spark, persona=[person(1, "0" * 22)])
    per = encrypt_columns(t, key_column(spark), token_key_column(spark)).persona
    import hashlib
    from condofin.functions.crypto import session_key_hex
    plain = hashlib.sha256(bytes.fromhex(session_key_hex(spark)) + b"0" * 22).hexdigest()
    assert per.first()["cbu_cvu_tok"] != plain


def test_hot_account_and_tenure_joins_are_split_by_aqe(spark):
    """One account pays two thirds of all payments: AQE splits that key in
    both the account join and the tenure as-of join (thresholds lowered to
    the size of test data; the input comes from several map tasks, as
    cluster scans do)."""
    from condofin.model import live
    from condofin.operators.tenure import match_payments_by_account, tenure_as_of
    hot_acc = "0" * 21 + "7"
    pers = [person(i, hot_acc if i == 7 else f"{i:022d}") for i in range(1, 200)]
    pays = [payment(i, 1, "2025-01-01 00:00:00", 1, account=hot_acc if i % 3 else f"{i % 199 + 1:022d}")
            for i in range(1, 6000)]
    ten = [tenure(i, i, "2024-01-01") for i in range(1, 200)]
    t = make_tables(spark, persona=pers, pago=pays, titularidad=ten)
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        m = match_payments_by_account(live(t.pago.repartition(8)), t.persona)
        j = tenure_as_of(m, t.titularidad, "persona_id", "fecha", keep=("uf_id",))
        assert j.count() == len(pays)
        rows = j.collect()
        assert len(rows) == len(pays)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_bucketed_layout_removes_bill_shuffles(spark, tmp_dir):
    import re
    import uuid
    from condofin.sources.driver_tables import load_tables
    from condofin.sources.tables_io import read_bucketed_tables, write_bucketed_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver data not present")
    t = load_tables(spark, sf)
    db = "condo_" + uuid.uuid4().hex[:8]
    write_bucketed_tables(t, os.path.join(tmp_dir, "bucketed"), db, 4)
    b = read_bucketed_tables(spark, db)
    p = ReportParams(None, "1995-01-01", "2001-12-31")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force shuffle joins
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = R.collections_by_source(b, p, ordered=False)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan)
    assert keys and all(k == "consorcio_id" for k in keys)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, R.collections_by_source(t, p).collect()))
