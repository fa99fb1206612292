"""Build small domain tables from Python rows (all values invented)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from condofin import model as M

D = Decimal


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_tables(spark, consorcio=None, unidad=None, accesoria=None, persona=None,
                titularidad=None, expensa=None, charges=None, pago=None) -> M.Tables:
    def df(rows, schema):
        return spark.createDataFrame(rows or [], schema)

    return M.Tables(
        consorcio=df(consorcio or [(1, "Uno", "Calle 1", 12, D("600.00"), False)], M.CONSORCIO),
        unidad=df(unidad, M.UNIDAD),
        accesoria=df(accesoria, M.ACCESORIA),
        persona=df(persona, M.PERSONA),
        titularidad=df(titularidad, M.TITULARIDAD),
        expensa=df(expensa, M.EXPENSA),
        charges=df(charges, M.CHARGES),
        pago=df(pago, M.PAGO),
    )


def bill(eid=1, building=1, periodo="2025-01-01", borrado=False):
    return (eid, building, d(periodo), borrado)


def charge(eid, concept, amount, borrado=False, mora_id=None, fecha=None):
    return (eid, concept, D(str(amount)), mora_id, d(fecha) if fecha else None, borrado)


def payment(pid, eid, fecha, amount, estado="APLICADO", account="0" * 21 + "1", borrado=False):
    return (pid, eid, ts(fecha), D(str(amount)), estado, account, borrado)


def person(pid, account, borrado=False, nombre="Ana", apellido="Alfa"):
    return (pid, nombre, apellido, 30000000 + pid, f"p{pid}@mail.test", 40000000 + pid, account, borrado)


def unit(uid, building=1, piso="PB", depto="A", coef="1", m2="50", borrado=False):
    return (uid, building, piso, depto, D(m2), D(coef), borrado)


def tenure(pid, uid, desde, hasta=None, role="PROPIETARIO"):
    return (pid, uid, d(desde), d(hasta) if hasta else None, role)
