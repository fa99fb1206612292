"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SHARE, VALID_PAYMENT_STATES
from .exact import with_quotients

# Spanish month names in calendar order (pivot columns of the
# unit/month report and the month text of the service-cost file).
MONTH_NAMES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")


def in_range(c: str | Column, d_from: dt.date, d_to_exclusive: dt.date) -> Column:
    """Half-open date range with literal bounds, so Parquet gets the filter."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.lit(d_from)) & (c < F.lit(d_to_exclusive))


def in_year(c: str | Column, year: int) -> Column:
    """``YEAR(c) = year`` written as a range (sargable, pushed down)."""
    return in_range(c, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def valid_state(c: str = "estado") -> Column:
    return F.col(c).isin(*VALID_PAYMENT_STATES)


def sum_money(c: Column | str) -> Column:
    """Exact ``SUM`` of a decimal money column with all its digits.

    Spark widens a decimal sum by ten digits, so neither the scale of the input
    nor the size of a total is limited by this package.  Works inside ``when``
    filters: NULL inputs are skipped, an all-NULL group gives NULL."""
    return F.sum(c)


def money_out(c: Column) -> Column:
    """Exact decimal -> 2-decimal DOUBLE for output (same bits in the oracle)."""
    return F.round(c, 2).cast("double")


def with_shares(df: DataFrame, amount: Column, parts: list[Column], names: list[str]) -> DataFrame:
    """``df`` with ``amount`` split in proportion to ``parts`` into the columns
    ``names``: DECIMAL(38,6) shares that add up to it exactly; NULL where the
    parts add up to 0.

    Each is the difference of two exact quotients, of the parts up to it and
    before it, so none is off by more than one unit of the last place."""
    sums = [parts[0]]
    for part in parts[1:]:
        sums.append(sums[-1] + part)
    upto = [f"hasta{i}__" for i in range(len(parts))]
    # the last is the amount itself, but NULL where there is nothing to share by
    cumulated = with_quotients(df, amount, dict(zip(upto, sums)), sums[-1])
    own = {n: F.col(u) if i == 0 else (F.col(u) - F.col(upto[i - 1])).cast(SHARE) for i, (n, u) in enumerate(zip(names, upto))}
    return cumulated.withColumns(own).drop(*upto)


def month_name(month: Column) -> Column:
    """Month number -> Spanish name, one ``CASE`` (12 literal branches)."""
    expr = None
    for i, name in enumerate(MONTH_NAMES, start=1):
        expr = F.when(month == i, name) if expr is None else expr.when(month == i, name)
    return expr
