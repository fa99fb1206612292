"""Cases in which nothing may be lost: digits, totals, categories, dates,
keys, clear data at rest, hot periods."""

from __future__ import annotations

import glob
import os
import random
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from condofin import model as M
from condofin.model import EXTRAORDINARIO, MORA, ORDINARIO
from condofin.operators.windows import running_total
from condofin.params import ReportParams
from condofin.plans import reports as R
from condofin.plans.audit import area_check, table_contents, table_overview
from condofin.plans.ingest import (RegistrationError, append_registered, commit_registered, register_entities,
                                   resolve_entities)
from condofin.plans.procedures import BY_SOURCE_XML, WEEKLY_XML, call
from condofin.plans.protect import mask_columns
from condofin.sources.tables_io import BatchConflict, read_table

from helpers import bill, charge, make_tables, payment, person, tenure, unit

P = ReportParams(None, "2024-01-01", "2025-12-31")


def wide_payments(spark, amounts, kind):
    rows = [(i, 1, f"2025-01-{1 + i % 28:02d}", a) for i, a in enumerate(amounts)]
    return spark.createDataFrame(rows, f"pago_id bigint, expensa_id bigint, dia string, importe {kind}").select(
        "pago_id", "expensa_id", F.to_timestamp_ntz("dia").alias("fecha"), "importe",
        F.lit("APLICADO").alias("estado"), F.lit("0" * 22).alias("cbu_cvu_origen"), F.lit(False).alias("borrado"))


def test_money_keeps_digits_beyond_cents(spark):
    t = make_tables(spark, expensa=[bill()]).replace(
        pago=wide_payments(spark, [D("1.0099")] * 100, "decimal(18,4)"))
    assert [r.TotalPeriodo for r in R.collections_by_source(t, P).collect()] == [100.99]
    assert sum(r.TotalSemana for r in R.weekly_cash_flow(t, P).collect()) == pytest.approx(100.99, abs=0.03)
    assert R.monthly_expense_income(t, P).first()["ingresos__exact"] == D("100.9900")


def test_totals_of_largest_amounts(spark):
    most = D("9999999999999999.99")
    t = make_tables(spark, expensa=[bill()], charges=[charge(1, ORDINARIO, most)] * 12).replace(
        pago=wide_payments(spark, [most] * 12, "decimal(18,2)"))
    assert R.collections_by_source(t, P).first()["TotalPeriodo"] == float(12 * most)
    row = R.monthly_expense_income(t, P).first()
    assert row["total_gastos__exact"] == row["ingresos__exact"] == 12 * most


def test_charges_with_four_decimals(spark):
    ch = spark.createDataFrame([(1, D("0.0049"), False)] * 3, "expensa_id bigint, importe decimal(18,4), borrado boolean")
    t = make_tables(spark, expensa=[bill()]).replace(charges=M.charges_from_parts(ordinarios=ch, mora=spark.createDataFrame(
        [], "mora_id bigint, expensa_id bigint, fecha_aplicacion date, importe decimal(18,2), borrado boolean")))
    assert R.monthly_expense_income(t, P).first()["total_gastos__exact"] == D("0.0147")


def late(spark, tenures):
    return make_tables(spark, unidad=[unit(7)], persona=[person(i, "0" * 22) for i in (1, 2)], titularidad=tenures,
                       expensa=[bill()], charges=[charge(1, MORA, 100, mora_id=1, fecha="2025-03-01")])


def test_tenure_without_a_start_date_gives_nothing(spark):
    none = (1, 7, None, None, "PROPIETARIO")
    assert R.owner_late_interest(late(spark, [none]), P).count() == 0
    both = R.owner_late_interest(late(spark, [none, tenure(2, 7, "2024-01-01")]), P).collect()
    assert [(r.persona_id, r.total_morosidad) for r in both] == [(2, 100.0)]


def test_reversed_and_empty_ranges_give_no_rows(spark):
    back = ReportParams(None, "2025-12-31", "2025-01-01")
    t = late(spark, [tenure(1, 7, "2024-01-01")])
    assert R.top_debtor_owners(t, back).count() == 0
    assert R.weekly_cash_flow(t, back).count() == R.collections_by_source(t, back).count() == 0


def test_masking_writes_no_clear_data(spark):
    t = make_tables(spark, persona=[person(i, f"99887766{i:014d}") for i in range(1, 60)],
                    pago=[payment(i, 1, "2025-01-01 00:00:00", 5, account=f"99887766{i:014d}") for i in range(1, 60)])
    out = mask_columns(t)
    assert out.persona.columns == t.persona.columns and out.pago.columns == t.pago.columns
    assert out.persona.filter("cbu_cvu like '9988%' or dni <> 0").count() == out.pago.filter("cbu_cvu_origen like '9988%'").count() == 0
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    for f in glob.glob(os.path.join(root, "**", "*.parquet"), recursive=True):
        names = spark.read.parquet(f).columns
        assert not {"cbu_cvu", "cbu_cvu_origen", "dni", "email"} & set(names) or "99887766" not in str(
            spark.read.parquet(f).limit(100).collect())


def batch(spark, buildings, units, accessories):
    return (spark.createDataFrame(buildings, "nombre string, direccion string, cant_unidades int, cant_m2_total double"),
            spark.createDataFrame(units, "nombre string, direccion string, piso string, depto string, cant_m2 double, coeficiente double"),
            spark.createDataFrame(accessories, "nombre string, direccion string, piso string, depto string, m2_accesorio double, tipo_accesorio string"))


def test_a_natural_key_is_registered_once(spark, tmp_dir):
    t = make_tables(spark, unidad=[unit(1)])
    new = ("Dos", "Calle 2", 1, 100.0)
    u = ("Dos", "Calle 2", "PB", "A", 50.0, 1.0)
    a = ("Dos", "Calle 2", "PB", "A", 4.0, "BAULERA")
    for bs, us, acc in (([("Uno", "Calle 1", 1, 5.0)], [], []), ([new, new], [], []), ([new], [u, u], []),
                        ([new], [u], [a, a]), ([], [("Uno", "Calle 1", "PB", "A", 1.0, 1.0)], [])):
        with pytest.raises(RegistrationError):
            register_entities(t, *batch(spark, bs, us, acc))
    reg = register_entities(t, *batch(spark, [new], [u], [a]))
    for name in ("consorcio", "unidad", "accesoria"):
        getattr(t, name).write.parquet(f"{tmp_dir}/{name}")
    append_registered(t, reg, tmp_dir)
    assert read_table(spark, tmp_dir, "consorcio").count() == 2
    stored = read_table(spark, tmp_dir, "unidad").orderBy("uf_id").collect()
    assert [(r.uf_id, r.consorcio_id) for r in stored] == [(1, 1), (2, 2)]
    assert read_table(spark, tmp_dir, "accesoria").collect()[0].uf_id == 2


def stored(spark, t, base):
    for name in ("consorcio", "unidad", "accesoria"):
        getattr(t, name).write.parquet(f"{base}/{name}")

    def sizes():
        return [read_table(spark, base, n).count() for n in ("consorcio", "unidad", "accesoria")]
    return sizes


NEW = [("Dos", "Calle 2", 1, 100.0)], [("Dos", "Calle 2", "PB", "A", 50.0, 1.0)], [("Dos", "Calle 2", "PB", "A", 4.0, "BAULERA")]


@pytest.mark.parametrize("broken", ["unidad", "accesoria"])
def test_a_batch_is_appended_whole_or_not_at_all(spark, tmp_dir, broken):
    t = make_tables(spark, unidad=[unit(1)])
    sizes = stored(spark, t, tmp_dir)
    new = resolve_entities(t, *batch(spark, *NEW))
    dying = getattr(new, broken).withColumn("uf_id", F.expr("assert_true(false, 'disk gone')").cast("bigint"))
    with pytest.raises(Exception, match="disk gone"):
        commit_registered(replace(new, **{broken: dying}), tmp_dir)
    assert os.listdir(os.path.join(tmp_dir, "lotes")) and sizes() == [1, 1, 0]
    assert commit_registered(new, tmp_dir) == 1
    assert sizes() == [2, 2, 1]


def test_of_two_writers_from_one_state_one_fails(spark, tmp_dir):
    t = make_tables(spark, unidad=[unit(1)])
    sizes = stored(spark, t, tmp_dir)
    one, two = resolve_entities(t, *batch(spark, *NEW)), resolve_entities(t, *batch(spark, [("Tres", "Calle 3", 1, 9.0)], [], []))
    commit_registered(one, tmp_dir, seen=0)
    with pytest.raises(BatchConflict):
        commit_registered(two, tmp_dir, seen=0)
    assert sizes() == [2, 2, 1]
    again = resolve_entities(t.replace(consorcio=read_table(spark, tmp_dir, "consorcio"), unidad=read_table(spark, tmp_dir, "unidad")),
                             *batch(spark, [("Tres", "Calle 3", 1, 9.0)], [], []))
    assert commit_registered(again, tmp_dir, seen=1) == 2
    assert sorted(r.consorcio_id for r in read_table(spark, tmp_dir, "consorcio").collect()) == [1, 2, 3]


def test_checks_name_what_is_wrong(spark):
    t = make_tables(spark, unidad=[unit(1)])
    bs, us, acc = NEW
    cases = [
        (([("Uno", "Calle 1", 1, 5.0)], [], []), "building named more than once: .*Uno"),
        (([*bs, *bs], [], []), "building named more than once: .*Dos"),
        ((bs, [("No", "hay", "PB", "A", 5.0, 1.0)], []), "building not found for .*No"),
        ((bs, [*us, *us], []), "unit named more than once: .*'consorcio_id': 2"),
        (([], [("Uno", "Calle 1", "PB", "A", 1.0, 1.0)], []), "unit named more than once: .*'consorcio_id': 1"),
        ((bs, us, [("Dos", "Calle 2", "9", "Z", 4.0, "BAULERA")]), "unit not found for .*'piso': '9'"),
        ((bs, us, [*acc, *acc]), "accessory named more than once: .*BAULERA"),
    ]
    for rows, message in cases:
        with pytest.raises(RegistrationError, match=message):
            resolve_entities(t, *batch(spark, *rows))


def test_four_buildings_whose_areas_add_up(spark):
    """Declared areas that equal units plus accessories, and one that does not."""
    plan = {1: [(50, 4), (46, 0)], 2: [(61, 0), (39, 12)], 3: [(20, 0)], 4: [(70, 4), (30, 8)], 5: [(10, 0)]}
    cons = [(b, f"B{b}", "c", len(us), D(sum(x + y for x, y in us)) + (1 if b == 5 else 0), False) for b, us in plan.items()]
    units = [unit(10 * b + i, b, m2=str(x)) for b, us in plan.items() for i, (x, _) in enumerate(us)]
    acc = [(10 * b + i, D(y), "COCHERA") for b, us in plan.items() for i, (_, y) in enumerate(us) if y]
    rows = area_check(make_tables(spark, consorcio=cons, unidad=units, accesoria=acc)).orderBy("consorcio_id").collect()
    assert [(r.consorcio_id, r.m2_declarados, r.cuadra) for r in rows] == [
        (1, 100.0, True), (2, 112.0, True), (3, 20.0, True), (4, 112.0, True), (5, 11.0, False)]


def test_overview_reads_each_table_once(spark):
    from condofin.sources.driver_tables import load_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver data not present")
    t = load_tables(spark, sf)
    plan = table_overview(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    counts = {r.tabla: r.filas for r in table_overview(t).collect()}
    assert counts == {n: df.count() for n, df in table_contents(t).items()}


def test_one_week_with_most_rows_is_spread(spark):
    """The running total's ranges follow all order keys, not the period."""
    rnd = random.Random(1)
    rows = [(2025, 7, b, rnd.randint(1, 99)) for b in range(4000)] + [(2025, w, 1, 5) for w in range(8, 40)]
    df = spark.createDataFrame(rows, "y int, w int, b int, v bigint")
    out = running_total(df, "v", ["y", "w", "b"], "acc")
    got = [r.acc for r in out.orderBy("y", "w", "b").collect()]
    total, want = 0, []
    for *_, v in sorted(rows):
        total += v
        want.append(total)
    assert got == want
    latest = max(glob.glob(os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"),
                                        "condofin-tables", "*")), key=os.path.getmtime)
    sizes = [r["count"] for r in spark.read.parquet(latest).groupBy("pid__cf").count().collect()]
    assert max(sizes) < 0.4 * len(rows)


def test_charge_aggregate_sits_above_a_semi_join(spark):
    t = make_tables(spark, expensa=[bill()], charges=[charge(1, ORDINARIO, 1), charge(1, EXTRAORDINARIO, 2)],
                    pago=[payment(1, 1, "2025-01-05 00:00:00", 10)])
    one = ReportParams(1, "2025-01-01", "2025-01-31")
    for df in (R.collections_by_source(t, one), R._drop_exact(R.monthly_expense_income(t, one))):
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        at = [i for i, line in enumerate(plan) if "Aggregate [expensa_id" in line and "s_ordinario" in line]
        assert at and "LeftSemi" in "".join(plan[at[0] + 1:at[0] + 4])


def test_scratch_tables_are_removed(spark):
    """A session of its own, as the folder belongs to the application."""
    import subprocess
    import sys
    code = """
import os, sys
sys.path.insert(0, {root!r})
from condofin.session import SCRATCH, build_session, ensure_checkpoint_dir, remove_scratch
from condofin.operators.windows import materialize
spark = build_session(master="local[1]")
assert materialize(spark.range(5)).count() == 5
folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/" + SCRATCH
assert os.listdir(folder)
assert remove_scratch(spark) and not os.path.exists(folder)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code.format(root=root)], capture_output=True, text=True, timeout=200)
    assert run.returncode == 0, run.stderr[-1500:]


def scratch_folders(spark):
    return set(glob.glob(os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "condofin-tables", "*")))


def test_a_report_leaves_no_scratch(spark):
    """Every procedure, computed and stored, deletes what it wrote."""
    from condofin.plans.procedures import BY_UNIT_MONTH, TOP_MONTHS, names, run
    from condofin.session import scratch_scope
    t = make_tables(spark, consorcio=[(1, "B", "c", 1, None, False)], unidad=[unit(1)], persona=[person(1, "1" * 22)],
                    titularidad=[tenure(1, 1, "2020-01-01")], expensa=[bill(1, 1)], charges=[charge(1, ORDINARIO, 10), charge(1, MORA, 3)],
                    pago=[payment(1, 1, "2025-01-06 00:00:00", 10, account="1" * 22)])
    before = scratch_folders(spark)
    written = []

    def store(result):
        written.append(len(scratch_folders(spark) - before))
        return [df.collect() for df in (result if isinstance(result, tuple) else (result,))]
    for name in names():
        asked = {"Anio": 2025} if name == BY_UNIT_MONTH else {"FechaDesde": "2025-01-01", "FechaHasta": "2025-12-31"}
        rows = run(name, t, store, **asked)
        assert scratch_folders(spark) == before
        with scratch_scope(spark):
            direct = call(name, t, **asked)
            assert rows == [df.collect() for df in (direct if name == TOP_MONTHS else (direct,))]
    assert sum(written) > 3


def test_scopes_nest(spark):
    from condofin.operators.windows import materialize
    from condofin.session import scratch_scope
    before = scratch_folders(spark)
    with scratch_scope(spark):
        kept = materialize(spark.range(3))
        with pytest.raises(ValueError), scratch_scope(spark):
            materialize(spark.range(4))
            raise ValueError
        assert kept.count() == 3 and len(scratch_folders(spark) - before) == 1
    assert scratch_folders(spark) == before
    free = materialize(spark.range(2))  # outside a scope tables stay
    assert len(scratch_folders(spark) - before) == 1 and free.count() == 2


def test_xml_reports_are_documents(spark):
    import xml.etree.ElementTree as ET
    t = make_tables(spark, consorcio=[(b, f"B{b}", "c", 1, None, False) for b in (1, 2)],
                    expensa=[bill(1, 2), bill(2, 1)],
                    pago=[payment(1, 1, "2025-01-06 00:00:00", 10), payment(2, 2, "2025-01-20 00:00:00", 20),
                          payment(3, 2, "2025-02-07 00:00:00", 5)])
    for name, root, key in ((WEEKLY_XML, "FlujoCajaSemanal", "Semana"), (BY_SOURCE_XML, "RecaudacionPorProcedencia", "Periodo/Mes")):
        lines = call(name, t, FechaDesde="2025-01-01", FechaHasta="2025-12-31").collect()
        doc = ET.fromstring("\n".join(r.xml for r in lines))
        rows = [(int(e.get("consorcio_id")), int(e.find(key).text)) for e in doc]
        assert doc.tag == root and [r.line for r in lines] == list(range(len(lines)))
        assert len(rows) == 3 and rows == sorted(rows)


def test_lines_tell_units_with_one_natural_key_apart(spark):
    t = make_tables(spark, unidad=[unit(1)])
    bs = [("Dos", "Calle 2", 1, 100.0)]
    us = [("Dos", "Calle 2", "PB", "A", 50.0, 1.0, 9), ("Dos", "Calle 2", "PB", "A", 60.0, 1.0, 8)]
    acc = [("Dos", "Calle 2", "PB", "A", 4.0, "BAULERA", 9), ("Uno", "Calle 1", "PB", "A", 4.0, "BAULERA", 9)]

    def lined(us, acc):
        frames = batch(spark, bs, [r[:-1] for r in us], [r[:-1] for r in acc])
        return frames[0], *(spark.createDataFrame(rows, T.StructType([*f.schema.fields, T.StructField("linea", T.LongType())]))
                            for f, rows in zip(frames[1:], (us, acc)))
    new = resolve_entities(t, *lined(us, acc), line="linea")
    assert {r.uf_id: int(r.cant_m2) for r in new.unidad.collect()} == {2: 60, 3: 50}
    # the accessory of its line's unit, and that of a stored one
    assert sorted(r.uf_id for r in new.accesoria.collect()) == [1, 3]
    with pytest.raises(RegistrationError, match="unit named more than once"):
        resolve_entities(t, *lined([*us, us[0]], acc), line="linea")
    with pytest.raises(RegistrationError, match="unit not found"):
        resolve_entities(t, *lined(us, [(*acc[0][:-1], 7)]), line="linea")


def test_a_task_of_the_payment_split_has_a_bounded_number_of_rows(spark, monkeypatch):
    from condofin.operators import concepts as C
    t = make_tables(spark, expensa=[bill(i) for i in range(40)], pago=[payment(i, i, "2025-01-05 00:00:00", 90 + i) for i in range(40)],
                    charges=[charge(i, kind, 3 + i) for i in range(40) for kind in (ORDINARIO, EXTRAORDINARIO)])

    def split():
        return C.split_payment(t, P, C.CONCEPTS)
    few = split()
    assert "RepartitionByExpression" not in few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(C, "ROWS_OF_TASK", 5)
    many = split()  # 120 rows
    dealt = [line for line in many._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in line]
    assert dealt and all(line.endswith(", 24") for line in dealt)
    assert sorted(many.collect()) == sorted(few.collect()) and many.count() == 40
