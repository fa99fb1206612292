"""W11 concept totals and W12 payment split.

Concept totals
--------------
The reports build each bill's composition by LEFT JOINing its ordinary,
extraordinary (and late-interest) charges side by side and then summing.
Sibling joins multiply rows: with ``n_j`` live rows in child ``j`` the total of
child ``i`` comes out as ``S_i * prod(max(1, n_j) for j != i)``.
``fanout="reference"`` reproduces that number, ``fanout="corrected"`` returns
the plain ``S_i``.  Neither materialises the product: the charges are
aggregated once per bill (sum and count per concept, map-side partial
aggregation, one shuffle on ``expensa_id``) and the multipliers are applied
to the aggregate.  Counts multiply, so totals widen to DECIMAL(38,6).

Payment split
-------------
A live payment in a valid state on a live bill is shared over the concepts in
proportion to the bill's totals, in shares that add up to it exactly; when the totals add up to 0 (or the bill has
no charges) everything is ordinary.  The bills that have such a payment are
found first; only their charges are aggregated (a semi-join below the
``groupBy``).  A task gets about ``ROWS_OF_TASK`` rows, however large the
tables are and however few partitions the session asks for.  Payment, bill and charge aggregate all join on
``expensa_id``.  A payment-heavy bill is a skewed join key; AQE splits it unless
the tables had to be dealt out by their number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import in_range, sum_money, valid_state, with_shares
from ..model import CONCEPTS, SHARE, WIDE_MONEY, Tables, live
from ..params import ReportParams
from ..sources.tables_io import year_filter

TOTAL_NAMES = {"ordinario": "total_ordinario", "extraordinario": "total_extra",
               "mora": "total_mora"}
SHARE_NAMES = {"ordinario": "share_ordinario", "extraordinario": "share_extra",
               "mora": "share_mora"}


#: Charges and payments that one task of the payment split has, about.
ROWS_OF_TASK = 1_000_000


def _by_bill(tables: Tables):
    """What deals a table out by bill: nothing as long as the session's own
    partitions are enough for the rows there are."""
    rows = tables.charges.select("expensa_id").unionAll(tables.pago.select("expensa_id")).count()
    n = -(-rows // ROWS_OF_TASK)
    if n <= int(tables.pago.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return lambda df: df
    return lambda df: df.repartition(n, "expensa_id")


def _check(concepts, fanout):
    if fanout not in ("reference", "corrected"):
        raise ValueError("fanout must be 'reference' or 'corrected'")
    bad = [c for c in concepts if c not in CONCEPTS]
    if bad or not concepts:
        raise ValueError(f"unknown concepts {bad}")


def of_bills(rows: DataFrame, bills: DataFrame) -> DataFrame:
    """The rows whose bill is among ``bills``: a semi-join that goes below
    whatever aggregates the rows."""
    return rows.join(bills.select("expensa_id"), "expensa_id", "left_semi")


def charge_aggregates(charges: DataFrame, concepts=CONCEPTS[:2]) -> DataFrame:
    """Per bill: sum ``s_<c>`` and live-row count ``n_<c>`` of each concept."""
    ch = live(charges).filter(F.col("concepto").isin(*concepts))
    aggs = []
    for c in concepts:
        hit = F.col("concepto") == c
        aggs.append(sum_money(F.when(hit, F.col("importe"))).alias(f"s_{c}"))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"n_{c}"))
    return ch.groupBy("expensa_id").agg(*aggs)


def total_columns(concepts, fanout: str = "reference") -> list[Column]:
    """Totals from ``s_*`` / ``n_*`` columns (NULL-safe: missing bill -> 0)."""
    _check(concepts, fanout)
    out = []
    for c in concepts:
        t = F.coalesce(F.col(f"s_{c}"), F.lit(0)).cast(WIDE_MONEY)
        if fanout == "reference":
            for other in concepts:
                if other != c:
                    t = t * F.greatest(F.coalesce(F.col(f"n_{other}"), F.lit(0)), F.lit(1))
        out.append(t.cast(WIDE_MONEY).alias(TOTAL_NAMES[c]))
    return out


def concept_totals(tables: Tables, concepts=CONCEPTS[:2], fanout: str = "reference") -> DataFrame:
    """Every live bill with one total per concept (0, never NULL)."""
    _check(concepts, fanout)
    bills = live(tables.expensa).select("expensa_id")
    agg = charge_aggregates(tables.charges, concepts)
    return bills.join(agg, "expensa_id", "left").select(
        "expensa_id", *total_columns(concepts, fanout))


def with_split(df: DataFrame, amount: str, concepts) -> DataFrame:
    """``df`` with the shares of ``amount`` per concept from its ``total_*``
    columns; they add up to it."""
    totals = [F.col(TOTAL_NAMES[c]) for c in concepts]
    base = reduce(lambda a, b: a + b, totals)
    names = [SHARE_NAMES[c] for c in concepts]
    split = with_shares(df, F.col(amount), totals, names)
    return split.withColumns({n: F.when(base > 0, F.col(n)).otherwise(
        F.col(amount).cast(SHARE) if i == 0 else F.lit(0).cast(SHARE)) for i, n in enumerate(names)})


def valid_payments(tables: Tables, params: ReportParams | None = None) -> DataFrame:
    """Live payments in a valid state, optionally inside the date range."""
    p = live(tables.pago).filter(valid_state())
    if params is not None:
        p = year_filter(p, params.date_from, params.date_to)
        p = p.filter(in_range("fecha", params.date_from, params.date_to_exclusive))
    return p


def split_payment(tables: Tables, params: ReportParams, concepts=CONCEPTS[:2],
                  fanout: str = "reference") -> DataFrame:
    """One row per valid payment of a live bill with its concept shares.

    Columns: ``consorcio_id, pago_id, fecha, importe_total, total_*, share_*``.
    The building filter applies to the *bill's* building.
    """
    _check(concepts, fanout)
    dealt = _by_bill(tables)
    pay = dealt(valid_payments(tables, params).select("pago_id", "expensa_id", "fecha", "importe"))
    bills = live(tables.expensa).select("expensa_id", "consorcio_id")
    if params.consorcio_id is not None:
        bills = bills.filter(F.col("consorcio_id") == params.consorcio_id)
    paid = dealt(bills).join(pay.select("expensa_id"), "expensa_id", "left_semi")
    charges = dealt(live(tables.charges).select("expensa_id", "concepto", "importe", "borrado"))
    agg = charge_aggregates(of_bills(charges, paid), concepts)
    joined = pay.join(paid, "expensa_id").join(agg, "expensa_id", "left")
    with_totals = joined.select(
        "consorcio_id", "pago_id", "expensa_id", "fecha",
        F.col("importe").alias("importe_total"), *total_columns(concepts, fanout))
    return with_split(with_totals, "importe_total", concepts)
