"""Report parameters and their defaults (all optional, as in the reports).

* building ``None`` means every building;
* a missing date range becomes 2000-01-01 .. 2100-12-31, so rows outside that
  span are dropped even when "no" range is asked for;
* a missing year becomes the current year.
The upper bound is inclusive of the whole day: ``c >= from AND c < to + 1 day``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Defaults of the optional report parameters.
DEFAULT_FROM = dt.date(2000, 1, 1)
DEFAULT_TO = dt.date(2100, 12, 31)


def _as_date(v):
    if v is None or isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v))


@dataclass(frozen=True)
class ReportParams:
    consorcio_id: int | None = None
    fecha_desde: dt.date | str | None = None
    fecha_hasta: dt.date | str | None = None

    @property
    def date_from(self) -> dt.date:
        return _as_date(self.fecha_desde) or DEFAULT_FROM

    @property
    def date_to(self) -> dt.date:
        return _as_date(self.fecha_hasta) or DEFAULT_TO

    @property
    def date_to_exclusive(self) -> dt.date:
        return self.date_to + dt.timedelta(days=1)


def default_year(year: int | None) -> int:
    return year if year is not None else dt.date.today().year
