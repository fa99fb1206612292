"""Hand-computed mini cases for the traps of the reports (FIXTURES.md s.4)."""

from __future__ import annotations

import itertools

from condofin.model import CONCEPTS, EXTRAORDINARIO, MORA, ORDINARIO
from condofin.operators.concepts import concept_totals, split_payment
from condofin.params import ReportParams
from condofin.plans import reports as R
from condofin.plans.protect import mask_columns

from helpers import bill, charge, make_tables, payment, person, tenure, unit

ACC = "0" * 21 + "1"
P = ReportParams(None, "2024-01-01", "2025-12-31")


def _totals(spark, charges, concepts=CONCEPTS[:2], fanout="reference"):
    t = make_tables(spark, expensa=[bill()], charges=charges)
    r = concept_totals(t, concepts, fanout).collect()[0].asDict()
    return {k: float(v) for k, v in r.items() if k != "expensa_id"}


def _split(spark, charges, concepts=CONCEPTS[:2], fanout="reference", amount=500):
    t = make_tables(spark, expensa=[bill()], charges=charges,
                    pago=[payment(1, 1, "2025-01-10 10:00:00", amount)])
    r = split_payment(t, P, concepts, fanout).collect()[0]
    return [round(float(r[c]), 2) for c in r.asDict() if c.startswith("share_")]


FANOUT = [charge(1, ORDINARIO, 100), charge(1, ORDINARIO, 300), charge(1, EXTRAORDINARIO, 100)]


def test_fanout_reference_mode(spark):
    assert _totals(spark, FANOUT) == {"total_ordinario": 400.0, "total_extra": 200.0}
    assert _split(spark, FANOUT) == [333.33, 166.67]


def test_fanout_corrected_mode(spark):
    assert _totals(spark, FANOUT, fanout="corrected") == {"total_ordinario": 400.0, "total_extra": 100.0}
    assert _split(spark, FANOUT, fanout="corrected") == [400.0, 100.0]


def test_three_concepts_reference_mode(spark):
    rows = FANOUT + [charge(1, MORA, 50, mora_id=1), charge(1, MORA, 50, mora_id=2)]
    assert _totals(spark, rows, CONCEPTS) == {"total_ordinario": 800.0, "total_extra": 400.0,
                                              "total_mora": 200.0}


def test_no_concept_rows_all_ordinary(spark):
    assert _totals(spark, []) == {"total_ordinario": 0.0, "total_extra": 0.0}
    assert _split(spark, [], CONCEPTS) == [500.0, 0.0, 0.0]


def test_deleted_child_is_ignored(spark):
    rows = [charge(1, ORDINARIO, 100), charge(1, ORDINARIO, 300, borrado=True),
            charge(1, EXTRAORDINARIO, 100)]
    assert _totals(spark, rows) == {"total_ordinario": 100.0, "total_extra": 100.0}
    assert _split(spark, rows) == [250.0, 250.0]


def test_fanout_formula_equals_literal_join(spark):
    """Product-free totals = sums over every combination of a bill's charges."""
    import random
    rnd = random.Random(7)
    charges, bills = [], []
    for e in range(1, 40):
        bills.append(bill(e))
        for concept in CONCEPTS:
            for _ in range(rnd.randint(0, 3)):
                charges.append(charge(e, concept, rnd.randint(1, 999), borrado=rnd.random() < 0.2))
    t = make_tables(spark, expensa=bills, charges=charges)
    ours = {r.expensa_id: (float(r.total_ordinario), float(r.total_extra), float(r.total_mora))
            for r in concept_totals(t, CONCEPTS).collect()}
    want = {}
    for e in range(1, 40):
        kinds = [[c[2] for c in charges if c[0] == e and c[1] == k and not c[5]] for k in CONCEPTS]
        rows = [combo for combo in itertools.product(*[k or [None] for k in kinds])]
        want[e] = tuple(float(sum(r[i] or 0 for r in rows)) for i in range(3))
    assert ours == want


def test_split_parts_sum_to_payment(spark):
    rows = [charge(1, ORDINARIO, 333.33), charge(1, EXTRAORDINARIO, 100.01), charge(1, MORA, 7, mora_id=1)]
    parts = _split(spark, rows, CONCEPTS, amount=999.99)
    assert abs(sum(parts) - 999.99) < 0.02


def test_year_end_week_pairs_with_calendar_year(spark):
    t = make_tables(spark, expensa=[bill()],
                    pago=[payment(1, 1, "2024-01-02 09:00:00", 10), payment(2, 1, "2024-12-30 09:00:00", 5)])
    rows = R.weekly_cash_flow(t, ReportParams(None, "2024-01-01", "2024-12-31")).collect()
    assert [(r.Anio, r.Semana, r.TotalSemana) for r in rows] == [(2024, 1, 15.0)]
    iso = R.weekly_cash_flow(t, ReportParams(None, "2024-01-01", "2024-12-31"), iso_year=True).collect()
    assert sorted((r.Anio, r.Semana, r.TotalSemana) for r in iso) == [(2024, 1, 10.0), (2025, 1, 5.0)]


def test_end_day_inclusive(spark):
    t = make_tables(spark, expensa=[bill()], pago=[payment(1, 1, "2025-01-31 18:00:00", 10)])
    rows = R.collections_by_source(t, ReportParams(None, "2025-01-01", "2025-01-31")).collect()
    assert len(rows) == 1 and rows[0].TotalPeriodo == 10.0


def test_invalid_state_and_deleted_payment_excluded(spark):
    t = make_tables(spark, expensa=[bill()], pago=[
        payment(1, 1, "2025-01-05 00:00:00", 10, estado="PENDIENTE"),
        payment(2, 1, "2025-01-05 00:00:00", 20, borrado=True),
        payment(3, 1, "2025-01-05 00:00:00", 40, estado="ASOCIADO")])
    rows = R.collections_by_source(t, P).collect()
    assert [r.TotalPeriodo for r in rows] == [40.0]


def test_weekly_mean_and_running_total(spark):
    t = make_tables(spark, consorcio=[(1, "Uno", "c", 1, None, False), (2, "Dos", "c", 1, None, False)],
                    expensa=[bill(1, 1), bill(2, 2)],
                    pago=[payment(1, 1, "2025-01-06 00:00:00", 10), payment(2, 2, "2025-01-07 00:00:00", 20),
                          payment(3, 1, "2025-01-14 00:00:00", 30)])
    rows = sorted(R.weekly_cash_flow(t, P).collect(), key=lambda r: (r.Anio, r.Semana, r.consorcio_id))
    assert [r.AcumuladoProgresivo for r in rows] == [10.0, 30.0, 60.0]
    assert {r.PromedioPeriodo for r in rows} == {20.0}


def _late_tables(spark, coefs, owners=True):
    units = [unit(i + 1, coef=str(c)) for i, c in enumerate(coefs)]
    pers = [person(i + 1, f"{i + 1:022d}", apellido=f"A{i}") for i in range(len(coefs))]
    ten = [tenure(i + 1, i + 1, "2024-01-01") for i in range(len(coefs))] if owners else []
    return make_tables(spark, unidad=units, persona=pers, titularidad=ten, expensa=[bill()],
                       charges=[charge(1, MORA, 100, mora_id=1, fecha="2025-03-01")])


def test_proration_by_coefficient(spark):
    t = _late_tables(spark, [1, 3])
    rows = {r.uf_id: r.mora_prorrateada for r in R.late_interest_by_unit(t, P).collect()}
    assert rows == {1: 25.0, 2: 75.0}
    owners = {r.persona_id: r.total_morosidad for r in R.owner_late_interest(t, P).collect()}
    assert owners == {1: 25.0, 2: 75.0}


def test_proration_zero_total(spark):
    t = _late_tables(spark, [0, 0])
    rows = {r.uf_id: r.mora_prorrateada for r in R.late_interest_by_unit(t, P).collect()}
    assert rows == {1: 0.0, 2: 0.0}
    assert R.owner_late_interest(t, P).count() == 0  # HAVING > 0


def test_top_debtors_order_and_ties(spark):
    t = _late_tables(spark, [1, 1, 2, 4])
    top = R.top_debtor_owners(t, P).collect()
    assert [r.persona_id for r in top] == [4, 3, 1]  # 50, 25, then 12.5 tie broken by surname
    assert top[0].dni == str(30000004) and top[0].cbu_cvu == f"{4:022d}"


def _payer(spark, tenures, pagos):
    return make_tables(spark, unidad=[unit(7, piso="01", depto="B")], persona=[person(1, ACC)],
                       titularidad=tenures, expensa=[bill()],
                       charges=[charge(1, ORDINARIO, 100)], pago=pagos)


def test_open_tenure_matches(spark):
    t = _payer(spark, [tenure(1, 7, "2024-01-01")], [payment(1, 1, "2025-06-01 00:00:00", 10)])
    rows = R.collections_by_unit_month(t, None, 2025).collect()
    assert len(rows) == 1 and rows[0].Junio == 10.0 and rows[0].Enero is None


def test_closed_tenure_last_day_matches(spark):
    t = _payer(spark, [tenure(1, 7, "2024-01-01", "2024-06-30")],
               [payment(1, 1, "2024-06-30 00:00:00", 10), payment(2, 1, "2024-07-01 00:00:00", 99)])
    rows = R.collections_by_unit_month(t, None, 2024).collect()
    assert [(r.Junio, r.Julio) for r in rows] == [(10.0, None)]


def test_overlapping_tenures(spark):
    ten = [tenure(1, 7, "2024-01-01"), tenure(1, 7, "2024-03-01")]
    t = _payer(spark, ten, [payment(1, 1, "2025-02-03 00:00:00", 10)])
    pv = R.collections_by_unit_month(t, None, 2025).collect()
    assert pv[0].Febrero == 20.0  # the pivot counts the payment once per tenure
    gaps = R.days_between_payments(t, P).collect()
    assert len(gaps) == 1 and gaps[0].fecha_pago_siguiente is None  # DISTINCT collapses


def test_same_day_payments(spark):
    t = _payer(spark, [tenure(1, 7, "2024-01-01")],
               [payment(1, 1, "2025-02-03 08:00:00", 10), payment(2, 1, "2025-02-03 08:00:00", 10),
                payment(3, 1, "2025-02-10 00:00:00", 10)])
    gaps = sorted((r.fecha_pago.day, r.dias_hasta_siguiente_pago) for r in R.days_between_payments(t, P).collect())
    assert gaps == [(3, 0.0), (3, 7.0), (10, None)]


def test_days_between_needs_live_ordinary_charge(spark):
    t = make_tables(spark, unidad=[unit(7)], persona=[person(1, ACC)],
                    titularidad=[tenure(1, 7, "2024-01-01")], expensa=[bill(1), bill(2)],
                    charges=[charge(1, ORDINARIO, 100), charge(2, ORDINARIO, 100, borrado=True)],
                    pago=[payment(1, 1, "2025-01-01 00:00:00", 5), payment(2, 2, "2025-01-05 00:00:00", 5)])
    assert [r.fecha_pago.day for r in R.days_between_payments(t, P).collect()] == [1]


def test_masking_sequence(spark):
    t = make_tables(spark, persona=[person(5, ACC), person(9, ACC), person(7, ACC, borrado=True)],
                    pago=[payment(3, 1, "2025-01-01 00:00:00", 1, account=None)])
    m = mask_columns(t)
    got = {r.persona_id: (r.cbu_cvu, r.dni, r.email) for r in m.persona.collect()}
    assert got[5] == ("ENC-000000000000000001", 0, "[CIFRADO]")
    assert got[9] == ("ENC-000000000000000002", 0, "[CIFRADO]")
    assert got[7][0] == ACC and got[7][2] != "[CIFRADO]"  # deleted rows untouched
    assert m.pago.collect()[0].cbu_cvu_origen == "ENC-000000000000000001"  # NULL accounts masked too


def test_masked_accounts_never_match(spark):
    from condofin.operators.tenure import match_payments_by_account
    t = make_tables(spark, persona=[person(1, ACC)], pago=[payment(1, 1, "2025-01-01 00:00:00", 1)])
    m = mask_columns(t)
    assert match_payments_by_account(m.pago, m.persona, "clear").count() == 0
    assert match_payments_by_account(t.pago, t.persona, "clear").count() == 1


def test_padded_account_matches_after_rtrim(spark):
    from condofin.operators.tenure import match_payments_by_account
    t = make_tables(spark, persona=[person(1, ACC + "  ")], pago=[payment(1, 1, "2025-01-01 00:00:00", 1)])
    assert match_payments_by_account(t.pago, t.persona).count() == 1


def test_top_months(spark):
    bills = [bill(i, 1, f"2025-{i:02d}-01") for i in range(1, 8)]
    charges = [charge(i, ORDINARIO, 10 * i) for i in range(1, 8)]
    pagos = [payment(i, i, f"2025-{i:02d}-05 00:00:00", 100 - i) for i in range(1, 8)]
    t = make_tables(spark, expensa=bills, charges=charges, pago=pagos)
    exp, inc, monthly = R.top_expense_income_months(t, P)
    assert [r.Mes for r in exp.collect()] == [7, 6, 5, 4, 3]
    assert [r.Mes for r in inc.collect()] == [1, 2, 3, 4, 5]
    outer = R.monthly_expense_income(t, P, plan="outer").collect()
    merged = R.monthly_expense_income(t, P).collect()
    assert sorted(map(tuple, outer)) == sorted(map(tuple, merged))


def test_procedure_calls_by_name(spark):
    from condofin.plans import procedures as PR
    t = make_tables(spark, expensa=[bill()], charges=[charge(1, ORDINARIO, 100)],
                    pago=[payment(1, 1, "2025-01-10 00:00:00", 40)])
    weekly = PR.call("Reporte_FlujoCajaSemanal", t, ConsorcioId=1, FechaDesde="2025-01-01",
                     FechaHasta="2025-12-31").collect()
    assert [(r.Semana, r.TotalOrdinario) for r in weekly] == [(2, 40.0)]
    expense, income = PR.call("Reporte_5Meses_MayoresGastosIngresos", t, FechaDesde="2025-01-01")
    assert [r.total_gastos for r in expense.collect()] == [100.0]
    assert [r.ingresos for r in income.collect()] == [40.0]
    assert len(PR.names()) == 8
    views = t.register_views("t_")
    assert spark.sql("select count(*) c from t_ordinarios").collect()[0].c == 1 and "t_pago" in views


def test_empty_range_gives_empty_reports(spark):
    t = make_tables(spark, unidad=[unit(7)], persona=[person(1, ACC)],
                    titularidad=[tenure(1, 7, "2024-01-01")], expensa=[bill()],
                    charges=[charge(1, ORDINARIO, 100), charge(1, MORA, 5, mora_id=1, fecha="2025-01-02")],
                    pago=[payment(1, 1, "2025-01-10 00:00:00", 40)])
    empty = ReportParams(None, "2030-01-01", "2030-12-31")
    assert R.weekly_cash_flow(t, empty).count() == 0
    assert R.collections_by_source(t, empty).count() == 0
    assert R.days_between_payments(t, empty).count() == 0
    assert R.top_debtor_owners(t, empty).count() == 0
    exp, inc, _ = R.top_expense_income_months(t, empty)
    assert exp.count() == 0 and inc.count() == 0
    assert R.collections_by_unit_month(t, None, 2030).count() == 0


def test_reconcile_units_counts(spark):
    from decimal import Decimal as Dd
    from condofin.plans.audit import reconcile_units
    units = spark.createDataFrame(
        [("Uno", 1, Dd("40.0000"), Dd("50.00")), ("Uno", 2, Dd("60.0000"), Dd("45.00")),
         ("Dos", 1, Dd("99.5000"), Dd("70.00"))],
        "consorcio_nombre string, nro_uf int, coeficiente decimal(9,4), cant_m2 decimal(10,2)")
    accounts = spark.createDataFrame(
        [("Uno", 1), ("Uno", 1), ("Tres", 4)], "consorcio_nombre string, nro_uf int")
    got = {r.consorcio_nombre: tuple(r)[1:] for r in reconcile_units(units, accounts).collect()}
    assert got == {"Uno": (2, 2, 1, 0, 100.0, 95.0), "Dos": (1, 0, 1, 0, 99.5, 70.0),
                   "Tres": (0, 1, 0, 1, 0.0, 0.0)}
