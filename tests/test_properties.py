"""Properties of the operators on generated inputs (hypothesis, few examples:
each example is a Spark job)."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from condofin.functions.crypto import decrypt_text, encrypt_text, key_column
from condofin.model import CONCEPTS, EXTRAORDINARIO, MORA, ORDINARIO
from condofin.operators.concepts import split_payment
from condofin.params import ReportParams
from condofin.plans import reports as R
from condofin.plans.protect import protect_tables

from helpers import bill, charge, make_tables, payment, person, unit

P = ReportParams(None, "2024-01-01", "2025-12-31")
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
money = st.decimals(min_value=Decimal("0.01"), max_value=Decimal("99999.99"), places=2)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(CONCEPTS), money), max_size=6), money)
def test_split_parts_sum_to_payment(spark, charges, amount):
    rows = [charge(1, c, a, mora_id=i) for i, (c, a) in enumerate(charges)]
    t = make_tables(spark, expensa=[bill()], charges=rows,
                    pago=[payment(1, 1, "2025-01-10 00:00:00", amount)])
    r = split_payment(t, P, CONCEPTS).collect()[0]
    parts = r.share_ordinario + r.share_extra + r.share_mora
    assert abs(parts - amount) <= Decimal("0.000003")
    assert min(r.share_ordinario, r.share_extra, r.share_mora) >= 0


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=9), min_size=1, max_size=6), money)
def test_prorated_shares_sum_to_amount(spark, coefs, amount):
    units = [unit(i + 1, coef=str(c)) for i, c in enumerate(coefs)]
    t = make_tables(spark, unidad=units, expensa=[bill()],
                    charges=[charge(1, MORA, amount, mora_id=1, fecha="2025-02-01")])
    shares = [r.mora_prorrateada for r in R.late_interest_by_unit(t, P).collect()]
    expected = float(amount) if sum(coefs) > 0 else 0.0
    assert abs(sum(shares) - expected) < 1e-6


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=1, max_value=3),
                          st.integers(min_value=0, max_value=300), money), min_size=1, max_size=12))
def test_last_running_total_is_total(spark, pays):
    import datetime as dt
    t = make_tables(spark, consorcio=[(b, f"B{b}", "c", 1, None, False) for b in (1, 2, 3)],
                    expensa=[bill(b, b) for b in (1, 2, 3)],
                    pago=[payment(i, b, (dt.datetime(2024, 1, 1) + dt.timedelta(days=d)).isoformat(sep=" "), a)
                          for i, (b, d, a) in enumerate(pays)])
    rows = R.weekly_cash_flow(t, P).collect()
    assert rows[-1].AcumuladoProgresivo == float(round(sum(a for *_, a in pays), 2))
    acc = [r.AcumuladoProgresivo for r in rows]
    assert acc == sorted(acc)


@SETTINGS
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=10))
def test_encrypt_decrypt_identity(spark, texts):
    key = key_column(spark)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    back = df.select("i", "s", decrypt_text(encrypt_text(F.col("s"), key), key).alias("b")).collect()
    assert all(r.s == r.b for r in back)


def test_masked_columns_hold_no_clear_value(spark):
    key = key_column(spark)
    pers = [person(i, f"{i:022d}") for i in range(1, 30)]
    pays = [payment(i, 1, "2025-01-01 00:00:00", 1, account=f"{i:022d}") for i in range(1, 30)]
    t = make_tables(spark, persona=pers, pago=pays)
    prot = protect_tables(t, key)
    clear = {p[6] for p in pers} | {str(p[3]) for p in pers} | {p[4] for p in pers}
    masked = prot.persona.select(F.col("cbu_cvu"), F.col("dni").cast("string"), "email").collect()
    assert not ({v for r in masked for v in r} & clear)
    assert not ({r.cbu_cvu_origen for r in prot.pago.collect()} & clear)
