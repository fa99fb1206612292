"""W15 pro-rata by coefficient, and its interval form used by W07.

A building-level amount is shared over the building's live units in
proportion to ``coeficiente / SUM(coeficiente)`` (0 when the building's total
is not positive).  Sharing is linear, so amounts are summed *before* they
meet the units, and the one division per output row happens last, on exact
decimal sums.  The building's coefficient total is a ``groupBy`` joined back
(skew-tolerant: partial aggregation + AQE), not a window over the building.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import quotient
from ..model import live


def building_coef_totals(units: DataFrame) -> DataFrame:
    """``(consorcio_id, coef_total)``: coefficient sum of each building's live units."""
    return live(units).groupBy("consorcio_id").agg(F.sum("coeficiente").alias("coef_total"))


def unit_weights(units: DataFrame) -> DataFrame:
    """Live units with ``coeficiente`` and their building's ``coef_total``."""
    u = live(units).select("uf_id", "consorcio_id", "coeficiente")
    return u.join(building_coef_totals(units), "consorcio_id")


def prorate(numerator: F.Column, coef_total: F.Column) -> F.Column:
    """``numerator / coef_total``, exact to the eighth decimal place and then
    DOUBLE; 0 if the total is not positive.

    ``numerator`` is the exact sum of ``amount * coeficiente``.  Each unit's
    share is rounded by itself, so those of ``n`` units add up to within
    ``n`` halves of that place.
    """
    hundredfold = quotient(numerator, F.lit(100), coef_total)
    return F.when(coef_total > 0, hundredfold.cast("double") / 100).otherwise(F.lit(0.0))


def prorate_by_coefficient(amounts: DataFrame, units: DataFrame,
                           amount_col: str = "importe") -> DataFrame:
    """Total of ``amounts`` per building shared over its live units.

    ``amounts(consorcio_id, <amount_col>)`` -> ``(uf_id, consorcio_id,
    coeficiente, coef_total, share)``.  Units of buildings without amounts do
    not appear.
    """
    per_building = amounts.groupBy("consorcio_id").agg(F.sum(amount_col).alias("amount__b"))
    w = unit_weights(units).join(per_building, "consorcio_id")
    return w.select("uf_id", "consorcio_id", "coeficiente", "coef_total",
                    prorate(F.col("amount__b") * F.col("coeficiente"), F.col("coef_total"))
                    .alias("share"))


def cumulative_by_day(daily: DataFrame, key: str, day: str, amount: str) -> DataFrame:
    """Dense per-key calendar with the running total of ``amount`` up to each day.

    ``daily(key, day, amount)`` has at most one row per (key, day).  For every
    key the calendar runs from its first to its last day; the caller's date
    range bounds the calendar of one key, so both the ``sequence`` array and
    the per-key window partition have a size fixed by the parameters, not by
    the data.  Output ``(key, day, cum)``; no rows give no rows.
    """
    span = daily.groupBy(key).agg(F.min(day).alias("d0"), F.max(day).alias("d1"))
    cal = span.select(key, F.explode(F.sequence("d0", "d1")).alias(day))
    dense = cal.join(daily, [key, day], "left")
    w = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dense.select(key, day, F.sum(F.coalesce(F.col(amount), F.lit(0))).over(w).alias("cum"))


def weighted_interval_totals(intervals: DataFrame, cum: DataFrame, key: str, day: str,
                             ends: tuple[str, str], span: tuple[str, str, str], weight: str,
                             group_keys: list[str]) -> DataFrame:
    """``SUM(weight * (cum(hi) - cum(lo - 1)))`` per ``group_keys``.

    ``ends`` are the columns (lo, hi) of each interval, ``span`` the columns
    (first day, last day, total) of its key.  At the last day the running total
    is the key's total and before the first it is 0: such ends, which most
    intervals of a key may share, never meet the calendar.  The other ends are
    signed rows that join it once.  Output column ``weighted_sum`` (exact).
    """
    lo, hi = ends
    first, last, total = span
    whole = intervals.filter(F.col(hi) == F.col(last)).select(
        *group_keys, (F.col(weight) * F.col(total)).alias("part__"))
    inner = intervals.select(
        *dict.fromkeys([*group_keys, key]), F.col(weight).alias("w__"),
        F.explode(F.filter(
            F.array(F.struct(F.col(hi).alias("d"), F.lit(1).alias("sign"), (F.col(hi) != F.col(last)).alias("meets")),
                    F.struct(F.date_sub(F.col(lo), 1).alias("d"), F.lit(-1).alias("sign"),
                             (F.col(lo) != F.col(first)).alias("meets"))),
            lambda e: e["meets"])).alias("e__"))
    inner = inner.select(*dict.fromkeys([*group_keys, key]), "w__", F.col("e__.d").alias(day),
                         F.col("e__.sign").alias("sign__")).join(cum, [key, day])
    parts = whole.unionByName(inner.select(*group_keys, (F.col("w__") * F.col("cum") * F.col("sign__")).alias("part__")))
    return parts.groupBy(*group_keys).agg(F.sum("part__").alias("weighted_sum"))
