"""W22 reconcile import files, W23 area check, W25 table overview."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money_out
from ..model import EXTRAORDINARIO, MORA, ORDINARIO, Tables, live

KEYS = ["consorcio_nombre", "nro_uf"]


def reconcile_units(units: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per building name, units and account rows of the two files.

    ``units(consorcio_nombre, nro_uf, coeficiente, cant_m2)`` and
    ``accounts(consorcio_nombre, nro_uf, ...)``.  Counts the units without an
    account row and the account rows without a unit (anti-join semantics),
    and sums coefficients and areas (a building's coefficients need not add
    up to 100).  One pass over each input: both are aggregated per (building,
    unit number), joined once with a full outer join and grouped by building.
    """
    u = units.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_u"), F.sum("coeficiente").alias("coef"),
                                 F.sum("cant_m2").alias("m2"))
    a = accounts.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_a"))
    j = u.join(a, KEYS, "full_outer")
    z = F.lit(0)
    agg = j.groupBy("consorcio_nombre").agg(
        F.coalesce(F.sum("n_u"), z).alias("unidades"),
        F.coalesce(F.sum("n_a"), z).alias("cuentas"),
        F.coalesce(F.sum(F.when(F.col("n_a").isNull(), F.col("n_u"))), z).alias("unidades_sin_cuenta"),
        F.coalesce(F.sum(F.when(F.col("n_u").isNull(), F.col("n_a"))), z).alias("cuentas_sin_unidad"),
        F.sum("coef").alias("coef"), F.sum("m2").alias("m2"))
    return agg.select(
        "consorcio_nombre", "unidades", "cuentas", "unidades_sin_cuenta", "cuentas_sin_unidad",
        money_out(F.coalesce("coef", z)).alias("suma_coeficientes"),
        money_out(F.coalesce("m2", z)).alias("suma_m2"))


def area_check(tables: Tables) -> DataFrame:
    """Declared building area vs live units' area plus their accessories."""
    units = live(tables.unidad).select("uf_id", "consorcio_id", "cant_m2")
    u = units.groupBy("consorcio_id").agg(F.sum("cant_m2").alias("m2_u"))
    acc = tables.accesoria.join(units.select("uf_id", "consorcio_id"), "uf_id") \
        .groupBy("consorcio_id").agg(F.sum("m2_accesorio").alias("m2_a"))
    b = live(tables.consorcio).select("consorcio_id", "cant_m2_total")
    j = b.join(u, "consorcio_id", "left").join(acc, "consorcio_id", "left")
    z = F.lit(0)
    used = F.coalesce("m2_u", z) + F.coalesce("m2_a", z)
    return j.select(
        "consorcio_id",
        money_out(F.col("cant_m2_total")).alias("m2_declarados"),
        money_out(F.coalesce("m2_u", z)).alias("m2_unidades"),
        money_out(F.coalesce("m2_a", z)).alias("m2_accesorios"),
        money_out(F.col("cant_m2_total") - used).alias("diferencia"),
        (F.col("cant_m2_total") == used).alias("cuadra"))


def table_overview(tables: Tables) -> DataFrame:
    """Row count (and live-row count) of every domain table.

    A union of one aggregate per stored table; the three kinds of charge are
    counted in one pass over ``charges``.
    """
    def counts(df: DataFrame, when=None) -> list:
        hit = F.lit(True) if when is None else when
        alive = hit & ~F.col("borrado") if "borrado" in df.columns else hit
        return [F.count(F.when(hit, 1)).alias("filas"), F.count(F.when(alive, 1)).alias("filas_vivas")]

    parts = [df.agg(*counts(df)).select(F.lit(name).alias("tabla"), "filas", "filas_vivas")
             for name, df in [("consorcio", tables.consorcio), ("unidad_funcional", tables.unidad),
                              ("unidad_accesoria", tables.accesoria), ("persona", tables.persona),
                              ("titularidad", tables.titularidad), ("expensa", tables.expensa),
                              ("pago", tables.pago)]]
    kinds = [("ordinarios", ORDINARIO), ("extraordinarios", EXTRAORDINARIO), ("mora", MORA)]
    ch = tables.charges
    wide = ch.agg(*[F.struct(*counts(ch, F.col("concepto") == kind)).alias(name) for name, kind in kinds])
    parts.append(wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("tabla"), F.col(name)["filas"].alias("filas"),
                 F.col(name)["filas_vivas"].alias("filas_vivas")) for name, _ in kinds])).alias("r")).select("r.*"))
    return reduce(lambda x, y: x.unionByName(y), parts)


def table_contents(tables: Tables) -> dict[str, DataFrame]:
    """The rows of every domain table by its name, the kinds of charge apart."""
    return {"consorcio": tables.consorcio, "unidad_funcional": tables.unidad,
            "unidad_accesoria": tables.accesoria, "persona": tables.persona,
            "titularidad": tables.titularidad, "expensa": tables.expensa, "ordinarios": tables.ordinarios,
            "extraordinarios": tables.extraordinarios, "mora": tables.mora, "pago": tables.pago}
