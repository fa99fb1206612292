"""The eight report jobs (W01-W08) as DataFrame plans.

Every function takes a :class:`~condofin.model.Tables` and the report's
optional parameters and returns a DataFrame; nothing is collected.  Plans that read a
shared intermediate twice (W01, W07, W08 and the two-result form of report 4)
write it when called, as a Parquet table in the checkpoint folder; the others
only declare.  Output
columns keep the reports' names.  Money leaves as 2-decimal DOUBLE rounded
from exact decimal sums (see :func:`condofin.functions.columns.money_out`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (MONTH_NAMES, in_range, in_year, money_out, month_name, sum_money,
                                 valid_state)
from ..model import CONCEPTS, EXTRAORDINARIO, ORDINARIO, Tables, live
from ..functions.crypto import decrypt_text
from ..operators.allocate import (building_coef_totals, cumulative_by_day, prorate,
                                  prorate_by_coefficient, weighted_interval_totals)
from ..operators.concepts import (charge_aggregates, of_bills, split_payment, total_columns,
                                  valid_payments)
from ..operators.tenure import match_payments_by_account, tenure_as_of
from ..operators.windows import expand_counts, materialize, running_total
from ..params import ReportParams, default_year
from ..sources.tables_io import year_filter


# --------------------------------------------------------------------- W01
def weekly_cash_flow(tables: Tables, params: ReportParams = ReportParams(),
                     fanout: str = "reference", iso_year: bool = False,
                     ordered: bool = True) -> DataFrame:
    """Per building, calendar year and ISO week: money collected.

    Ordinary / extraordinary parts come from the two-concept split; the mean
    is over result rows (building-weeks with a payment); the running total
    is global in (year, week) order with the building id as final tie-break,
    computed by the two-level plan of :func:`running_total`.
    ``iso_year=True`` pairs the ISO week with its ISO year instead of the
    calendar year (the report's default pairs week 1 of 30 Dec with the
    ending year).
    """
    sp = split_payment(tables, params, (ORDINARIO, EXTRAORDINARIO), fanout)
    year = F.expr("extract(YEAROFWEEK FROM fecha)") if iso_year else F.year("fecha")
    weekly = sp.groupBy(
        "consorcio_id", year.cast("int").alias("Anio"),
        F.weekofyear("fecha").cast("int").alias("Semana"),
    ).agg(
        F.sum("share_ordinario").alias("ord"),
        F.sum("share_extra").alias("ext"),
        sum_money("importe_total").alias("tot"),
    )
    ran = running_total(weekly, "tot", ["Anio", "Semana", "consorcio_id"],
                        out="acc", mean_out="PromedioPeriodo")
    out = ran.select(
        "consorcio_id", "Anio", "Semana",
        money_out(F.col("ord")).alias("TotalOrdinario"),
        money_out(F.col("ext")).alias("TotalExtraordinario"),
        money_out(F.col("tot")).alias("TotalSemana"),
        "PromedioPeriodo",
        money_out(F.col("acc")).alias("AcumuladoProgresivo"),
    )
    return out.orderBy("Anio", "Semana", "consorcio_id") if ordered else out


# --------------------------------------------------------------------- W03
def collections_by_source(tables: Tables, params: ReportParams = ReportParams(),
                          fanout: str = "reference", ordered: bool = True) -> DataFrame:
    """Per building, year, month: ordinary, extraordinary, late, total."""
    sp = split_payment(tables, params, CONCEPTS, fanout)
    out = sp.groupBy(
        "consorcio_id", F.year("fecha").alias("Anio"), F.month("fecha").alias("Mes"),
    ).agg(
        money_out(F.sum("share_ordinario")).alias("TotalOrdinario"),
        money_out(F.sum("share_extra")).alias("TotalExtraordinario"),
        money_out(F.sum("share_mora")).alias("TotalMora"),
        money_out(sum_money("importe_total")).alias("TotalPeriodo"),
    )
    return out.orderBy("consorcio_id", "Anio", "Mes") if ordered else out


# --------------------------------------------------------------------- W04
def _bills_in_range(tables: Tables, params: ReportParams) -> DataFrame:
    b = live(tables.expensa).filter(in_range("periodo", params.date_from, params.date_to_exclusive))
    if params.consorcio_id is not None:
        b = b.filter(F.col("consorcio_id") == params.consorcio_id)
    return b.select("expensa_id", "consorcio_id",
                    F.year("periodo").alias("Anio"), F.month("periodo").alias("Mes"))


def _paid_per_bill(tables: Tables, bills: DataFrame) -> DataFrame:
    return of_bills(valid_payments(tables), bills).groupBy("expensa_id").agg(sum_money("importe").alias("paid"))


def monthly_expense_income(tables: Tables, params: ReportParams = ReportParams(),
                           fanout: str = "reference", plan: str = "merged") -> DataFrame:
    """Per building, year and month of the bill period: expense by
    concept (three-concept totals) and income (valid payments of those bills,
    by the *bill's* period, not the payment date).

    Both sides start from the same live bills in range, so their group keys
    coincide and the reports' FULL OUTER JOIN never leaves a side unmatched.
    ``plan="merged"`` (default) therefore aggregates charges and payments to
    bill level, joins them on ``expensa_id`` (co-partitioned) and groups once;
    ``plan="outer"`` groups each side and merges them with a full outer join
    on the three keys, as the reports do.  Both give the same rows.  Besides
    the report columns, ``total_gastos__exact`` and ``ingresos__exact`` keep
    the exact decimal sums the top-month rankings order by.
    """
    bills = _bills_in_range(tables, params)
    charges = charge_aggregates(of_bills(tables.charges, bills), CONCEPTS)
    paid = _paid_per_bill(tables, bills)
    keys = ["consorcio_id", "Anio", "Mes"]
    gastos = [F.sum(c).alias(n) for c, n in zip(total_columns(CONCEPTS, fanout),
                                                  ("g_ord", "g_ext", "g_mora"))]
    if plan == "merged":
        per_bill = bills.join(charges, "expensa_id", "left").join(paid, "expensa_id", "left")
        m = per_bill.groupBy(*keys).agg(*gastos, F.sum(F.coalesce("paid", F.lit(0))).alias("ing"))
    elif plan == "outer":
        g = bills.join(charges, "expensa_id", "left").groupBy(*keys).agg(*gastos)
        i = bills.join(paid, "expensa_id", "left").groupBy(*keys).agg(
            F.sum(F.coalesce("paid", F.lit(0))).alias("ing"))
        j = g.alias("g").join(i.alias("i"), keys, "full_outer")
        m = j.select(*keys, "g_ord", "g_ext", "g_mora", "ing")
    else:
        raise ValueError("plan must be 'merged' or 'outer'")
    z = F.lit(0)
    g_ord, g_ext, g_mora = (F.coalesce(c, z) for c in ("g_ord", "g_ext", "g_mora"))
    return m.select(
        *keys,
        money_out(g_ord).alias("gastos_ordinarios"),
        money_out(g_ext).alias("gastos_extra"),
        money_out(g_mora).alias("gastos_mora"),
        money_out(g_ord + g_ext + g_mora).alias("total_gastos"),
        money_out(F.coalesce("ing", z)).alias("ingresos"),
        (g_ord + g_ext + g_mora).alias("total_gastos__exact"),
        F.coalesce("ing", z).alias("ingresos__exact"),
    )


def _drop_exact(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith("__exact")])


def top_expense_months(monthly: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` months of largest total expense (> 0).

    Order: total DESC, year, month, then building id (ties between buildings
    are arbitrary in the report).  ``orderBy().limit()`` plans a
    ``TakeOrderedAndProject``: per-partition top-n, then a merge of n rows
    per partition - never a global sort.
    """
    return _drop_exact(
        monthly.filter(F.col("total_gastos__exact") > 0)
        .orderBy(F.col("total_gastos__exact").desc(), "Anio", "Mes", "consorcio_id")
        .limit(n)
        .select("consorcio_id", "Anio", "Mes", "gastos_ordinarios", "gastos_extra",
                "gastos_mora", "total_gastos", "total_gastos__exact"))


def top_income_months(monthly: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` months of largest income (> 0); order as W05."""
    return _drop_exact(
        monthly.filter(F.col("ingresos__exact") > 0)
        .orderBy(F.col("ingresos__exact").desc(), "Anio", "Mes", "consorcio_id")
        .limit(n)
        .select("consorcio_id", "Anio", "Mes", "ingresos", "ingresos__exact"))


def top_expense_income_months(tables: Tables, params: ReportParams = ReportParams(),
                              n: int = 5, fanout: str = "reference"):
    """W05 + W06 from one materialised monthly table (two result sets).

    The monthly table (buildings x months) is written once as a Parquet table
    in the shared checkpoint folder and both top-n queries read it.
    """
    monthly = materialize(monthly_expense_income(tables, params, fanout))
    return top_expense_months(monthly, n), top_income_months(monthly, n), monthly


# --------------------------------------------------------------------- W02 / W08
def _payer_units(tables: Tables, pay: DataFrame, mode: str = "clear", key=None,
                 role: str | None = None) -> DataFrame:
    """Payments -> live payer (by account) -> tenure valid on the payment
    date -> live unit.  One row per (payment, matching tenure)."""
    matched = match_payments_by_account(pay, tables.persona, mode, key)
    held = tenure_as_of(matched, tables.titularidad, "persona_id", "fecha", role=role,
                        keep=("uf_id",))
    units = live(tables.unidad).select("uf_id", F.col("consorcio_id").alias("uf_consorcio_id"),
                                       "piso", "depto")
    return held.join(units, "uf_id")


def collections_by_unit_month(tables: Tables, consorcio_id: int | None = None,
                              year: int | None = None, mode: str = "clear", key=None) -> DataFrame:
    """One row per unit, 12 month columns of money paid by its holders.

    Payment -> person by account -> *any* tenure valid on the payment date
    (every valid tenure counts the payment once: no de-duplication) -> live
    unit; the bill only has to be live (its building is not checked against
    the unit's).  Building filter on the unit, year on the payment date.
    Months without payments are NULL; units without payments do not appear.
    """
    y = default_year(year)
    accounts = [c for c in tables.pago.columns if c.startswith("cbu_cvu_origen")]
    pay = year_filter(live(tables.pago), dt.date(y, 1, 1), dt.date(y, 12, 31)) \
        .filter(valid_state()).filter(in_year("fecha", y)) \
        .select("pago_id", "expensa_id", "fecha", "importe", *accounts)
    pay = pay.join(live(tables.expensa).select("expensa_id"), "expensa_id", "left_semi")
    rows = _payer_units(tables, pay, mode, key)
    if consorcio_id is not None:
        rows = rows.filter(F.col("uf_consorcio_id") == consorcio_id)
    src = rows.select("uf_id", "piso", "depto", month_name(F.month("fecha")).alias("MesNombre"),
                      "importe")
    pv = src.groupBy("uf_id", "piso", "depto").pivot("MesNombre", list(MONTH_NAMES)) \
            .agg(sum_money("importe"))
    return pv.select("uf_id", "piso", "depto",
                     *[money_out(F.col(m)).alias(m) for m in MONTH_NAMES]).orderBy("uf_id")


def days_between_payments(tables: Tables, params: ReportParams = ReportParams(),
                          mode: str = "clear", key=None) -> DataFrame:
    """Per unit, each payment date, the next payment date and the gap.

    Rows are DISTINCT (unit, building, floor, door, payment, date), so
    overlapping tenures of one payer collapse while two payments on one day
    stay two rows (gap 0).  The bill must be live with at least one live
    ordinary charge (semi join); building filter on the unit.

    Plan (no task holds a unit's whole history or one timestamp's copies):
    the rows are pre-aggregated to one row per (unit, timestamp) with the
    number ``n`` of distinct payments; LEAD runs over those rows inside
    (unit, day) partitions, and a per-(unit, day) table - at most one row per
    calendar day of the range for each unit - gives each day's last
    timestamp the first one of the unit's next payment day.  Each timestamp
    yields one row with the next timestamp, plus ``n - 1`` rows with gap 0
    (:func:`expand_counts`: bounded chunks, spread over tasks; only these
    duplicate rows are shuffled).  The day gap leaves
    as DOUBLE (NULL on each unit's last payment), the type a NULL-able count
    has in pandas on every engine.
    """
    pay = year_filter(live(tables.pago), params.date_from, params.date_to) \
        .filter(valid_state()) \
        .filter(in_range("fecha", params.date_from, params.date_to_exclusive))
    pay = pay.select("pago_id", "expensa_id", "fecha",
                     *[c for c in tables.pago.columns if c.startswith("cbu_cvu_origen")])
    # the payments in range name the bills whose charges matter
    with_ord = of_bills(live(tables.ordinarios), pay).select("expensa_id")
    pay = of_bills(of_bills(pay, live(tables.expensa)), with_ord)
    rows = _payer_units(tables, pay, mode, key)
    if params.consorcio_id is not None:
        rows = rows.filter(F.col("uf_consorcio_id") == params.consorcio_id)
    keys = ["uf_id", "consorcio_id", "piso", "depto", "fecha_pago"]
    distinct_rows = rows.select("uf_id", F.col("uf_consorcio_id").alias("consorcio_id"), "piso", "depto",
                                "pago_id", F.col("fecha").alias("fecha_pago")).distinct()
    # one row per (unit, timestamp): read by both LEAD levels, so computed once
    g0 = materialize(distinct_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n__"))
                     .withColumn("dia__", F.to_date("fecha_pago")))
    in_day = Window.partitionBy("uf_id", "dia__").orderBy("fecha_pago")
    g = g0.withColumn("next_in_day__", F.lead("fecha_pago").over(in_day))
    days = g.groupBy("uf_id", "dia__").agg(F.min("fecha_pago").alias("first__"))
    by_day = Window.partitionBy("uf_id").orderBy("dia__")
    days = days.select("uf_id", "dia__", F.lead("first__").over(by_day).alias("next_day__"))
    j = g.join(days, ["uf_id", "dia__"])
    last = j.select(*keys, F.coalesce("next_in_day__", "next_day__").alias("fecha_pago_siguiente"))
    # the other n - 1 payments of a timestamp are followed by one at the same time
    dups = expand_counts(g0.filter(F.col("n__") > 1)
                         .select(*keys, F.col("fecha_pago").alias("fecha_pago_siguiente"),
                                 (F.col("n__") - 1).alias("copies")), "copies")
    out = last.unionByName(dups)
    return out.select(
        "consorcio_id", "uf_id", "piso", "depto", "fecha_pago", "fecha_pago_siguiente",
        F.when(F.col("fecha_pago_siguiente").isNotNull(),
               F.datediff(F.col("fecha_pago_siguiente"), F.col("fecha_pago")))
         .cast("double").alias("dias_hasta_siguiente_pago"),
    ).orderBy("consorcio_id", "uf_id", "fecha_pago")


# --------------------------------------------------------------------- W07
def owner_late_interest(tables: Tables, params: ReportParams = ReportParams()) -> DataFrame:
    """Late interest of each (owner, building), before the top-k of W07.

    Each live late-interest charge of a live bill is shared over the live
    units of the bill's building by coefficient, and each unit's share goes
    to every PROPIETARIO tenure valid on the charge date (co-owners each take
    the full unit share; a unit without owner loses it).

    Plan without the charge x unit product: charges are summed per
    (building, day); a dense per-building calendar carries the running total;
    each owner tenure, clipped to its building's calendar, takes
    ``coef * (cum(hi) - cum(lo - 1))``; owner sums are divided once by the
    building's coefficient total.  A tenure that lasts to the building's last
    day takes the building's total and one that starts on its first day
    subtracts nothing, so the many open tenures need no row of the calendar.
    A tenure without a start date is never valid; a range whose end is before
    its start gives no rows.  Exact decimals up to that division.
    """
    bills = live(tables.expensa).select("expensa_id", "consorcio_id")
    if params.consorcio_id is not None:
        bills = bills.filter(F.col("consorcio_id") == params.consorcio_id)
    mora = live(tables.mora).filter(
        in_range("fecha_aplicacion", params.date_from, params.date_to_exclusive)) \
        .select("expensa_id", "fecha_aplicacion", "importe")
    # buildings x days: read three times below, so computed once
    daily = materialize(mora.join(bills, "expensa_id").groupBy("consorcio_id", "fecha_aplicacion")
                        .agg(sum_money("importe").alias("amount")))
    cum = cumulative_by_day(daily, "consorcio_id", "fecha_aplicacion", "amount")
    span = daily.groupBy("consorcio_id").agg(F.min("fecha_aplicacion").alias("d0"),
                                             F.max("fecha_aplicacion").alias("d1"),
                                             F.sum("amount").alias("all"))
    units = live(tables.unidad).select("uf_id", "consorcio_id", "coeficiente")
    owners = tables.titularidad.filter((F.col("tipo_titularidad") == "PROPIETARIO")
                                       & F.col("fecha_desde").isNotNull()) \
        .select("persona_id", "uf_id", "fecha_desde", "fecha_hasta")
    # live owners, carrying the names the ranking breaks ties on
    owners = owners.join(live(tables.persona).select("persona_id", "apellido", "nombre"), "persona_id")
    ten = owners.join(units, "uf_id").join(span, "consorcio_id")
    ten = ten.select("persona_id", "apellido", "nombre", "uf_id", "consorcio_id", "coeficiente",
                     "d0", "d1", "all", F.greatest("fecha_desde", "d0").alias("lo"),
                     F.least(F.coalesce("fecha_hasta", "d1"), "d1").alias("hi")) \
             .filter(F.col("lo") <= F.col("hi"))
    per_owner = weighted_interval_totals(ten, cum, "consorcio_id", "fecha_aplicacion", ("lo", "hi"),
                                         ("d0", "d1", "all"), "coeficiente",
                                         ["persona_id", "apellido", "nombre", "consorcio_id"])
    per_owner = per_owner.withColumnRenamed("weighted_sum", "num").join(
        building_coef_totals(tables.unidad), "consorcio_id")
    res = per_owner.select("persona_id", "consorcio_id",
                           prorate(F.col("num"), F.col("coef_total")).alias("total_morosidad"),
                           "apellido", "nombre")
    return res.filter(F.col("total_morosidad") > 0)


def contact_columns(persons: DataFrame, mode: str = "clear", key=None) -> DataFrame:
    """``persona_id`` with dni, email, telefono, cbu_cvu as text (decrypted
    from the ``*_enc`` columns in ``decrypt`` mode)."""
    cols = ("dni", "email", "telefono", "cbu_cvu")
    if mode == "clear":
        sel = [F.col(c).cast("string").alias(c) for c in cols]
    else:
        sel = [decrypt_text(F.col(c + "_enc"), key).alias(c) for c in cols]
    return persons.select("persona_id", *sel)


def top_debtor_owners(tables: Tables, params: ReportParams = ReportParams(), n: int = 3,
                      mode: str = "clear", key=None) -> DataFrame:
    """The ``n`` (owner, building) pairs with most prorated late interest.

    Order: total DESC, surname, name, then person and building ids.  Contact
    data are attached (and, in ``decrypt`` mode, decrypted) for the ``n``
    winners only.
    """
    ranked = owner_late_interest(tables, params).orderBy(
        F.col("total_morosidad").desc(), "apellido", "nombre", "persona_id", "consorcio_id").limit(n)
    contact = contact_columns(tables.persona, mode, key)
    return ranked.join(contact, "persona_id").select(
        "persona_id", "apellido", "nombre", "dni", "email", "telefono", "cbu_cvu",
        "consorcio_id", "total_morosidad").orderBy(
        F.col("total_morosidad").desc(), "apellido", "nombre", "persona_id", "consorcio_id")


# --------------------------------------------------------------------- W15
def late_interest_by_unit(tables: Tables, params: ReportParams = ReportParams()) -> DataFrame:
    """W15 on late interest: each live unit's coefficient share of its
    building's live late-interest charges in the range."""
    bills = live(tables.expensa).select("expensa_id", "consorcio_id")
    mora = live(tables.mora).filter(
        in_range("fecha_aplicacion", params.date_from, params.date_to_exclusive)) \
        .select("expensa_id", "importe").join(bills, "expensa_id")
    if params.consorcio_id is not None:
        mora = mora.filter(F.col("consorcio_id") == params.consorcio_id)
    return prorate_by_coefficient(mora, tables.unidad).select(
        "uf_id", "consorcio_id", F.col("share").alias("mora_prorrateada"))
