"""Time the chosen plans against the straightforward ones they replace.

1. weekly running total: two-level plan vs one ``Window.orderBy`` (single task);
2. concept totals: per-bill aggregate + multipliers vs literal sibling joins;
3. owner late interest: per-day calendar + tenure intervals vs charge x unit
   product.
Each pair is checked for equal results first.  Usage:
    python tools/plan_alternatives.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from condofin.functions.columns import money_out  # noqa: E402
from condofin.model import CONCEPTS, live  # noqa: E402
from condofin.operators.concepts import concept_totals  # noqa: E402
from condofin.params import ReportParams  # noqa: E402
from condofin.plans import reports as R  # noqa: E402
from condofin.session import build_session  # noqa: E402
from condofin.sources.driver_tables import load_tables  # noqa: E402

P = ReportParams(None, "1995-01-01", "2001-12-31")


def timed(make, n=3):
    make().write.format("noop").mode("overwrite").save()
    runs = []
    for _ in range(n):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def weekly_single_window(t):
    w = R.weekly_cash_flow(t, P, ordered=False)
    base = w.select("consorcio_id", "Anio", "Semana", "TotalSemana")
    win = Window.orderBy("Anio", "Semana", "consorcio_id").rowsBetween(Window.unboundedPreceding, 0)
    return base.withColumn("acc", F.sum("TotalSemana").over(win))


def literal_fanout(t):
    e = live(t.expensa).select("expensa_id")
    parts = [live(t.concept(c)).select("expensa_id", F.col("importe").alias(f"i_{c}")) for c in CONCEPTS]
    j = e
    for p in parts:
        j = j.join(p, "expensa_id", "left")
    return j.groupBy("expensa_id").agg(
        *[F.sum(F.coalesce(F.col(f"i_{c}"), F.lit(0))).alias(c) for c in CONCEPTS])


def late_interest_product(t):
    bills = live(t.expensa).select("expensa_id", "consorcio_id")
    mora = live(t.mora).filter((F.col("fecha_aplicacion") >= F.lit(P.date_from))
                               & (F.col("fecha_aplicacion") < F.lit(P.date_to_exclusive)))
    units = live(t.unidad).select("uf_id", "consorcio_id", "coeficiente")
    tot = units.groupBy("consorcio_id").agg(F.sum("coeficiente").alias("coef_total"))
    md = mora.join(bills, "expensa_id").join(units, "consorcio_id")
    own = t.titularidad.filter(F.col("tipo_titularidad") == "PROPIETARIO")
    mp = md.join(own, (md.uf_id == own.uf_id) & (own.fecha_desde <= md.fecha_aplicacion)
                 & (own.fecha_hasta.isNull() | (own.fecha_hasta >= md.fecha_aplicacion)))
    mp = mp.join(live(t.persona).select("persona_id"), "persona_id", "left_semi")
    agg = mp.groupBy("persona_id", "consorcio_id").agg(
        F.sum(F.col("importe") * F.col("coeficiente")).alias("num"))
    return agg.join(tot, "consorcio_id").select(
        "persona_id", "consorcio_id",
        (F.col("num").cast("double") / F.col("coef_total").cast("double")).alias("total_morosidad")) \
        .filter(F.col("total_morosidad") > 0)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    t = load_tables(spark, sf_dir)
    # equal results first
    a = {(r.consorcio_id, r.Anio, r.Semana): r.AcumuladoProgresivo
         for r in R.weekly_cash_flow(t, P, ordered=False).collect()}
    b = {(r.consorcio_id, r.Anio, r.Semana): float(round(r.acc, 2)) for r in weekly_single_window(t).collect()}
    assert a == b, "running totals differ"
    ours = {r.expensa_id: tuple(float(x) for x in r[1:]) for r in concept_totals(t, CONCEPTS).collect()}
    lit = {r.expensa_id: tuple(float(x) for x in r[1:]) for r in literal_fanout(t).collect()}
    assert ours == lit, "fan-out totals differ"
    o = {(r.persona_id, r.consorcio_id): r.total_morosidad for r in R.owner_late_interest(t, P).collect()}
    p = {(r.persona_id, r.consorcio_id): r.total_morosidad for r in late_interest_product(t).collect()}
    assert o == p, "late interest differs"
    out = {
        "sf_dir": sf_dir,
        "running_total_two_level": timed(lambda: R.weekly_cash_flow(t, P, ordered=False)),
        "running_total_single_window": timed(lambda: weekly_single_window(t)),
        "concept_totals_product_free": timed(lambda: concept_totals(t, CONCEPTS)),
        "concept_totals_literal_joins": timed(lambda: literal_fanout(t)),
        "late_interest_intervals": timed(lambda: R.owner_late_interest(t, P)),
        "late_interest_charge_x_unit": timed(lambda: late_interest_product(t)),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
