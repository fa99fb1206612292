"""Domain tables as Spark schemas plus a provider that hands out DataFrames.

Ten tables of the building-administration model (building, unit, accessory,
person, tenure, bill, three charge kinds, payment).  The three charge kinds
(ordinary, extraordinary, late interest) are also exposed as one long
``charges`` table tagged by ``concepto``: a report that needs several kinds
then aggregates them in a single pass and a single shuffle on ``expensa_id``.

Soft delete: live rows have ``borrado = false``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
WIDE_MONEY = T.DecimalType(38, 6)
SHARE = T.DecimalType(38, 6)
COEF = T.DecimalType(9, 4)
AREA = T.DecimalType(10, 2)

# Concept tags of the charges table and payment states.
ORDINARIO = "ordinario"
EXTRAORDINARIO = "extraordinario"
MORA = "mora"
CONCEPTS = (ORDINARIO, EXTRAORDINARIO, MORA)
VALID_PAYMENT_STATES = ("APLICADO", "ASOCIADO")
OWNER_ROLE = "PROPIETARIO"
TENANT_ROLE = "INQUILINO"

CONSORCIO = T.StructType([
    T.StructField("consorcio_id", T.IntegerType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("direccion", T.StringType()),
    T.StructField("cant_unidades", T.IntegerType()),
    T.StructField("cant_m2_total", AREA),
    T.StructField("borrado", T.BooleanType()),
])

UNIDAD = T.StructType([
    T.StructField("uf_id", T.LongType()),
    T.StructField("consorcio_id", T.IntegerType()),
    T.StructField("piso", T.StringType()),
    T.StructField("depto", T.StringType()),
    T.StructField("cant_m2", AREA),
    T.StructField("coeficiente", COEF),
    T.StructField("borrado", T.BooleanType()),
])

ACCESORIA = T.StructType([
    T.StructField("uf_id", T.LongType()),
    T.StructField("m2_accesorio", AREA),
    T.StructField("tipo_accesorio", T.StringType()),
])

PERSONA = T.StructType([
    T.StructField("persona_id", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("apellido", T.StringType()),
    T.StructField("dni", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("telefono", T.LongType()),
    T.StructField("cbu_cvu", T.StringType()),
    T.StructField("borrado", T.BooleanType()),
])

TITULARIDAD = T.StructType([
    T.StructField("persona_id", T.LongType()),
    T.StructField("uf_id", T.LongType()),
    T.StructField("fecha_desde", T.DateType()),
    T.StructField("fecha_hasta", T.DateType()),
    T.StructField("tipo_titularidad", T.StringType()),
])

EXPENSA = T.StructType([
    T.StructField("expensa_id", T.LongType()),
    T.StructField("consorcio_id", T.IntegerType()),
    T.StructField("periodo", T.DateType()),
    T.StructField("borrado", T.BooleanType()),
])

CHARGES = T.StructType([
    T.StructField("expensa_id", T.LongType()),
    T.StructField("concepto", T.StringType()),
    T.StructField("importe", MONEY),
    T.StructField("mora_id", T.LongType()),
    T.StructField("fecha_aplicacion", T.DateType()),
    T.StructField("borrado", T.BooleanType()),
])

PAGO = T.StructType([
    T.StructField("pago_id", T.LongType()),
    T.StructField("expensa_id", T.LongType()),
    T.StructField("fecha", T.TimestampNTZType()),
    T.StructField("importe", MONEY),
    T.StructField("estado", T.StringType()),
    T.StructField("cbu_cvu_origen", T.StringType()),
    T.StructField("borrado", T.BooleanType()),
])

SCHEMAS = {
    "consorcio": CONSORCIO, "unidad": UNIDAD, "accesoria": ACCESORIA,
    "persona": PERSONA, "titularidad": TITULARIDAD, "expensa": EXPENSA,
    "charges": CHARGES, "pago": PAGO,
}


def live(df: DataFrame) -> DataFrame:
    """Rows not soft-deleted (``NOT borrado``; pushed down to the scan)."""
    return df.filter(~F.col("borrado"))


@dataclass
class Tables:
    """The domain tables of one data set.

    Every attribute is a lazy DataFrame; nothing is read until an action.
    ``persona`` and ``pago`` may additionally carry protected columns
    (``*_enc`` binary ciphertext, ``*_tok`` keyed tokens) after
    :func:`condofin.plans.protect.encrypt_columns`.
    """

    consorcio: DataFrame
    unidad: DataFrame
    accesoria: DataFrame
    persona: DataFrame
    titularidad: DataFrame
    expensa: DataFrame
    charges: DataFrame
    pago: DataFrame

    def concept(self, name: str) -> DataFrame:
        return self.charges.filter(F.col("concepto") == name)

    @property
    def ordinarios(self) -> DataFrame:
        return self.concept(ORDINARIO)

    @property
    def extraordinarios(self) -> DataFrame:
        return self.concept(EXTRAORDINARIO)

    @property
    def mora(self) -> DataFrame:
        return self.concept(MORA)

    def replace(self, **kw) -> "Tables":
        vals = {k: getattr(self, k) for k in
                ("consorcio", "unidad", "accesoria", "persona", "titularidad",
                 "expensa", "charges", "pago")}
        vals.update(kw)
        return Tables(**vals)

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in SCHEMAS}

    def register_views(self, prefix: str = "") -> list[str]:
        """Temp views of every table (plus the three charge kinds) for SQL."""
        views = dict(self.as_dict(), ordinarios=self.ordinarios,
                     extraordinarios=self.extraordinarios, mora=self.mora)
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + n for n in views]


def charges_from_parts(ordinarios: DataFrame | None = None,
                       extraordinarios: DataFrame | None = None,
                       mora: DataFrame | None = None) -> DataFrame:
    """Union the three charge tables into the long ``charges`` form.

    ``ordinarios(expensa_id, importe, borrado)``,
    ``extraordinarios(expensa_id, valor_cuota_actual, borrado)``,
    ``mora(mora_id, expensa_id, fecha_aplicacion, importe, borrado)``.
    """
    parts = []
    if ordinarios is not None:
        parts.append(ordinarios.select(
            F.col("expensa_id").cast("bigint"), F.lit(ORDINARIO).alias("concepto"),
            F.col("importe").alias("importe"),
            F.lit(None).cast("bigint").alias("mora_id"),
            F.lit(None).cast("date").alias("fecha_aplicacion"), "borrado"))
    if extraordinarios is not None:
        parts.append(extraordinarios.select(
            F.col("expensa_id").cast("bigint"), F.lit(EXTRAORDINARIO).alias("concepto"),
            F.col("valor_cuota_actual").alias("importe"),
            F.lit(None).cast("bigint").alias("mora_id"),
            F.lit(None).cast("date").alias("fecha_aplicacion"), "borrado"))
    if mora is not None:
        parts.append(mora.select(
            F.col("expensa_id").cast("bigint"), F.lit(MORA).alias("concepto"),
            F.col("importe").alias("importe"),
            F.col("mora_id").cast("bigint"),
            F.col("fecha_aplicacion").cast("date"), "borrado"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
