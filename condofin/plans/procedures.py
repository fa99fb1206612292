"""Call the reports by their procedure names with their named parameters.

Users of the original application call eight report procedures by name with
optional ``@ConsorcioId``, ``@FechaDesde``, ``@FechaHasta`` / ``@Anio``
parameters; :func:`call` maps those calls onto the report functions and
returns DataFrames (two for the top-months report, as the procedure returns
two result sets; the lines of one document, root included, for the XML ones).
"""

from __future__ import annotations

from ..model import Tables
from ..params import ReportParams
from ..session import scratch_scope
from . import reports as R
from . import xml_out as X

# Report procedure names and their parameter names.
WEEKLY = "Reporte_FlujoCajaSemanal"
BY_UNIT_MONTH = "Reporte_RecaudacionPorUFyMes"
BY_SOURCE = "Reporte_RecaudacionPorProcedenciaPeriodo"
TOP_MONTHS = "Reporte_5Meses_MayoresGastosIngresos"
TOP_DEBTORS = "Reporte_PropietariosMayorMorosidad"
DAYS_BETWEEN = "Reporte_DiasEntrePagosOrdinariosUF"
WEEKLY_XML = "Reporte_FlujoCajaSemanal_XML"
BY_SOURCE_XML = "Reporte_RecaudacionPorProcedenciaPeriodo_XML"
PARAM_NAMES = {"ConsorcioId": "consorcio_id", "FechaDesde": "fecha_desde",
               "FechaHasta": "fecha_hasta", "Anio": "year"}


def _kw(kwargs: dict) -> dict:
    out = {}
    for k, v in kwargs.items():
        out[PARAM_NAMES.get(k.lstrip("@"), k)] = v
    return out


def call(name: str, tables: Tables, mode: str = "clear", key=None, **params):
    """Run report ``name``; parameters by procedure name or python name."""
    p = _kw(params)
    rp = ReportParams(p.get("consorcio_id"), p.get("fecha_desde"), p.get("fecha_hasta"))
    if name == WEEKLY:
        return R.weekly_cash_flow(tables, rp)
    if name == BY_UNIT_MONTH:
        return R.collections_by_unit_month(tables, p.get("consorcio_id"), p.get("year"), mode, key)
    if name == BY_SOURCE:
        return R.collections_by_source(tables, rp)
    if name == TOP_MONTHS:
        expense, income, _ = R.top_expense_income_months(tables, rp)
        return expense, income
    if name == TOP_DEBTORS:
        return R.top_debtor_owners(tables, rp, mode=mode, key=key)
    if name == DAYS_BETWEEN:
        return R.days_between_payments(tables, rp, mode, key)
    if name == WEEKLY_XML:
        return X.weekly_cash_flow_xml(tables, rp)
    if name == BY_SOURCE_XML:
        return X.collections_by_source_xml(tables, rp)
    raise KeyError(f"unknown report {name!r}")


def run(name: str, tables: Tables, store, mode: str = "clear", key=None, **params):
    """Run report ``name`` and hand its result to ``store`` (a function that
    writes or collects it); the report's intermediate tables are deleted when
    ``store`` is done.  Returns what ``store`` returns."""
    with scratch_scope(tables.pago.sparkSession):
        return store(call(name, tables, mode, key, **params))


def names() -> list[str]:
    return [WEEKLY, BY_UNIT_MONTH, BY_SOURCE, TOP_MONTHS, TOP_DEBTORS, DAYS_BETWEEN,
            WEEKLY_XML, BY_SOURCE_XML]
