"""Readers of the three import files, and their cleaning rules.

The import procedure itself is not available, so the rules here are derived
from the files: explicit schemas (an account number is text, never a
number), trimming, decimal-comma and mixed-locale numbers, SI/NO flags, month
names trimmed.

Nothing is lost unseen.  A reader first gives every line or document with what
is wrong with it (``fallas``, a code per field, empty if nothing is); the clean
rows are those without faults, the rejects those with some, so that lines in =
rows out + rejects + blank lines (of separators; of white space, Spark's reader
gives no row).

Each reader has a twin that parses text already held in a DataFrame column
(``from_csv`` / ``from_json``, the same parsers as the file readers) so the
rules can run on text Spark derives from tables, at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MONTH_NAMES
from ..functions.money import parse_decimal_comma, parse_flag, parse_money
from ..model import AREA
from .json_array import read_json_elements

# Column names of the three import files.
ACCOUNT_FIELDS = ("CVU/CBU", "Nombre del consorcio", "nroUnidadFuncional", "piso", "departamento")
UNIT_FIELDS = ("Nombre del consorcio", "nroUnidadFuncional", "Piso", "departamento", "coeficiente",
               "m2_unidad_funcional", "bauleras", "cochera", "m2_baulera", "m2_cochera")
COST_CATEGORIES = ("BANCARIOS", "LIMPIEZA", "ADMINISTRACION", "SEGUROS", "GASTOS GENERALES",
                   "SERVICIOS PUBLICOS-Agua", "SERVICIOS PUBLICOS-Luz")
BUILDING_FIELD = "Nombre del consorcio"
MONTH_FIELD = "Mes"

ACCOUNT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ACCOUNT_FIELDS])
UNIT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in UNIT_FIELDS])
YEAR_FIELD = "Anio"
#: Fields of a cost document that name it; every other one is a cost category.
DOCUMENT_FIELDS = (BUILDING_FIELD, MONTH_FIELD, YEAR_FIELD, "_id")


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


#: Column that holds a line as it was read where its fields don't fit the schema.
CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    """Lines of delimited files (parsed in byte ranges by many tasks) with
    their fields as text; a line with more or fewer fields keeps its text."""
    return (spark.read.schema(_with_corrupt(schema)).option("header", True).option("sep", sep)
            .option("enforceSchema", True).option("ignoreLeadingWhiteSpace", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def _parse_delimited(lines: DataFrame, col: str, schema: T.StructType, sep: str) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` STRING" for f in _with_corrupt(schema).fields)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return _once(lines.select(F.col(col).alias("linea__")), F.from_csv("linea__", ddl, options), "r").select("r.*")


def _once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """``df`` with ``parsed`` as a column that is worked out once a row: a
    filter on its fields is not pushed below an explode, as it would be below a
    projection, with a copy of the parser for each field that it names."""
    return df.select("*", F.explode_outer(F.array(parsed)).alias(name))


def _faults(*found: tuple[str, Column]) -> Column:
    """Codes of the faults whose condition holds."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in found]),
                    lambda x: x.isNotNull())


def _unparsed(c: Column, parsed: Column) -> Column:
    """Text that is there but says nothing that the field can hold."""
    return ~_blank(c) & parsed.isNull()


def _blank_line(schema: T.StructType, sep: str) -> Column:
    """A line of separators and blanks only, however many there are."""
    fields = F.concat_ws("", *[F.col(f"`{f.name}`") for f in schema.fields])
    return F.trim(F.coalesce(F.translate(F.col(CORRUPT), sep, ""), fields)) == ""


def accepted(checked: DataFrame) -> DataFrame:
    """The rows without faults, without the columns of the check."""
    return checked.filter((F.size("fallas") == 0) & ~F.col("vacia")).drop("fallas", "vacia", "linea")


def rejects(checked: DataFrame) -> DataFrame:
    """The rows with faults: ``fallas`` (codes) and ``linea``, the fields as
    read (the line itself where its fields don't fit), and what was parsed."""
    return checked.filter((F.size("fallas") > 0) & ~F.col("vacia")).drop("vacia")


def count_faults(checked: DataFrame) -> DataFrame:
    """``falla, filas``: how many lines have each fault; lines without any
    count as ``ninguna``, blank ones as ``vacia``: one aggregate."""
    kind = F.when(F.col("vacia"), F.array(F.lit("vacia"))).when(F.size("fallas") == 0, F.array(F.lit("ninguna"))) \
        .otherwise(F.col("fallas"))
    return checked.select(F.explode(kind).alias("falla")).groupBy("falla").agg(F.count(F.lit(1)).alias("filas"))


def _line(schema: T.StructType, sep: str) -> Column:
    fields = [F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in schema.fields]
    return F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *fields))


# ------------------------------------------------------------------ W19
def check_unit_accounts(raw: DataFrame) -> DataFrame:
    """``(cbu_cvu, consorcio_nombre, nro_uf, piso, depto)`` of every line, and
    ``fallas, vacia, linea``.  Faults: ``campos`` (more or fewer fields),
    ``cuenta`` / ``consorcio`` (missing), ``nro_uf`` (no number)."""
    number = F.trim(F.col("nroUnidadFuncional"))
    account, building = F.col("`CVU/CBU`"), F.col(f"`{BUILDING_FIELD}`")
    return raw.select(
        F.trim(account).alias("cbu_cvu"), F.trim(building).alias("consorcio_nombre"),
        number.try_cast("int").alias("nro_uf"), F.trim(F.col("piso")).alias("piso"),
        F.trim(F.col("departamento")).alias("depto"),
        _faults(("campos", F.col(CORRUPT).isNotNull()), ("cuenta", _blank(account)), ("consorcio", _blank(building)),
                ("nro_uf", number.try_cast("int").isNull())).alias("fallas"),
        _blank_line(ACCOUNT_SCHEMA, "|").alias("vacia"), _line(ACCOUNT_SCHEMA, "|").alias("linea"))


def read_checked_unit_accounts(spark: SparkSession, path: str) -> DataFrame:
    return check_unit_accounts(_read_delimited(spark, path, ACCOUNT_SCHEMA, "|"))


def read_unit_accounts(spark: SparkSession, path: str) -> DataFrame:
    return accepted(read_checked_unit_accounts(spark, path))


def parse_unit_account_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return accepted(check_unit_accounts(_parse_delimited(lines, col, ACCOUNT_SCHEMA, "|")))


# ------------------------------------------------------------------ W20
def check_units(raw: DataFrame) -> DataFrame:
    """Unit rows with typed columns of every line, and ``fallas, vacia, linea``.

    Faults: ``campos``, ``consorcio`` (missing), ``nro_uf``, ``coeficiente``,
    ``m2_unidad``, ``m2_baulera``, ``m2_cochera`` (text that is no number; the
    first must be there), ``bauleras``, ``cochera`` (text that says neither yes
    nor no), and ``sin_bauleras``, ``sin_cochera`` (an area above 0 beside a
    flag that says no or nothing)."""
    building = F.col(f"`{BUILDING_FIELD}`")
    areas, flags = ("m2_unidad_funcional", "m2_baulera", "m2_cochera"), ("bauleras", "cochera")
    # parsed in a projection of its own: the faults name each value several times
    parsed = raw.withColumns(
        {"nro__": F.trim(F.col("nroUnidadFuncional")).try_cast("int"), "coef__": parse_decimal_comma(F.col("coeficiente"))}
        | {f"{c}__": parse_decimal_comma(F.col(c), AREA) for c in areas} | {f"{c}__": parse_flag(F.col(c)) for c in flags})

    def lost(field, to=None):
        return _unparsed(F.col(field), F.col(to or f"{field}__"))

    def unclaimed(flag, area):
        return (F.col(f"{area}__") > 0) & ~F.coalesce(F.col(f"{flag}__"), F.lit(False)) & ~lost(flag)

    return parsed.select(
        F.trim(building).alias("consorcio_nombre"), F.col("nro__").alias("nro_uf"),
        F.trim(F.col("Piso")).alias("piso"), F.trim(F.col("departamento")).alias("depto"),
        F.col("coef__").alias("coeficiente"), F.col("m2_unidad_funcional__").alias("cant_m2"),
        F.col("bauleras__").alias("baulera"), F.col("cochera__").alias("cochera"),
        F.col("m2_baulera__").alias("m2_baulera"), F.col("m2_cochera__").alias("m2_cochera"),
        _faults(("campos", F.col(CORRUPT).isNotNull()), ("consorcio", _blank(building)), ("nro_uf", F.col("nro__").isNull()),
                ("coeficiente", lost("coeficiente", "coef__")), ("m2_unidad", lost("m2_unidad_funcional")),
                *[(c, lost(c)) for c in flags], *[(c, lost(c)) for c in areas[1:]],
                ("sin_bauleras", unclaimed("bauleras", "m2_baulera")),
                ("sin_cochera", unclaimed("cochera", "m2_cochera"))).alias("fallas"),
        _blank_line(UNIT_SCHEMA, "\t").alias("vacia"), _line(UNIT_SCHEMA, "\t").alias("linea"))


def read_checked_units(spark: SparkSession, path: str) -> DataFrame:
    return check_units(_read_delimited(spark, path, UNIT_SCHEMA, "\t"))


def read_units(spark: SparkSession, path: str) -> DataFrame:
    return accepted(read_checked_units(spark, path))


def parse_unit_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return accepted(check_units(_parse_delimited(lines, col, UNIT_SCHEMA, "\t")))


def split_units(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unit table and accessory table (one row per storage room / parking).

    An accessory exists when its flag says yes; an area without that is a fault
    (:func:`check_units`), so no accessory goes unseen.
    """
    unit_rows = units.select("consorcio_nombre", "nro_uf", "piso", "depto", "coeficiente", "cant_m2")
    acc = units.select(
        "consorcio_nombre", "nro_uf",
        F.explode(F.array(
            F.struct(F.lit("BAULERA").alias("tipo_accesorio"), F.col("baulera").alias("tiene"),
                     F.col("m2_baulera").alias("m2_accesorio")),
            F.struct(F.lit("COCHERA").alias("tipo_accesorio"), F.col("cochera").alias("tiene"),
                     F.col("m2_cochera").alias("m2_accesorio")))).alias("a"))
    acc = acc.filter(F.col("a.tiene")).select("consorcio_nombre", "nro_uf", "a.tipo_accesorio",
                                              "a.m2_accesorio")
    return unit_rows, acc


# ------------------------------------------------------------------ W21
def _month_number(name: Column) -> Column:
    """Lower-case Spanish month name -> 1..12 (NULL when unknown)."""
    expr = None
    for i, n in enumerate(MONTH_NAMES, start=1):
        expr = F.when(name == n.lower(), i) if expr is None else expr.when(name == n.lower(), i)
    return expr


def check_cost_documents(texts: DataFrame, col: str = "value") -> DataFrame:
    """``texts`` with ``f``, the document as a map of texts, and ``falla``: what
    keeps it from being imported, else NULL.

    ``largo``: longer than the splitter joins; ``json``: no valid JSON object;
    ``consorcio``: names no building."""
    said = F.trim(F.regexp_replace(F.col(col), r"^\s+|\s+$", ""))
    long = F.col("long") if "long" in texts.columns else F.lit(False)
    whole = said.startswith("{") & said.endswith("}")
    parsed = F.when(whole, F.from_json(F.col(col), "map<string,string>"))
    return _once(texts, parsed, "f").withColumn(
        "falla", F.when(long, "largo").when(F.col("f").isNull(), "json")
        .when(_blank(F.col("f")[BUILDING_FIELD]), "consorcio"))


def clean_service_costs(docs: DataFrame) -> DataFrame:
    """Documents as maps of texts (column ``f``) -> ``(consorcio_nombre, anio, mes_nombre, mes, categoria,
    importe_texto, importe)``.

    There is no schema: every field that does not name the document is a
    category, whatever it is called, and a listed category that is missing is
    a row without an amount.  Documents with a ``falla`` are left out (they are
    the rejects of :func:`check_cost_documents`); :func:`rejected_costs` finds
    the amounts that are no numbers.
    """
    name = F.trim(F.col("f")[BUILDING_FIELD])
    listed = F.map_from_arrays(F.array(*[F.lit(c) for c in COST_CATEGORIES]),
                               F.array(*[F.col("f")[c] for c in COST_CATEGORIES]))
    other = F.map_filter("f", lambda k, v: ~k.isin(*DOCUMENT_FIELDS, *COST_CATEGORIES))
    base = docs.filter(F.col("falla").isNull()).select(
        name.alias("consorcio_nombre"), F.trim(F.col("f")[YEAR_FIELD]).try_cast("int").alias("anio"),
        F.lower(F.trim(F.col("f")[MONTH_FIELD])).alias("mes_nombre"),
        F.explode(F.map_concat(listed, other)).alias("categoria", "importe_texto"))
    return base.select("consorcio_nombre", "anio", "mes_nombre", _month_number(F.col("mes_nombre")).alias("mes"),
                       "categoria", "importe_texto", parse_money(F.col("importe_texto")).alias("importe"))


def read_cost_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document of files that each hold one JSON array, valid or not:
    ``file, block, n, value, f, falla``.  A large array is read by many tasks
    (:mod:`condofin.sources.json_array`)."""
    return check_cost_documents(read_json_elements(spark, path))


def read_service_costs(spark: SparkSession, path: str) -> DataFrame:
    """The costs of the valid documents; see :func:`read_cost_documents`, whose
    rows with a ``falla`` are the rejects."""
    return clean_service_costs(read_cost_documents(spark, path))


def parse_service_cost_documents(docs: DataFrame, col: str = "value") -> DataFrame:
    """One JSON document per row of text column ``col``."""
    return clean_service_costs(check_cost_documents(docs, col))


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Documents of :func:`read_cost_documents` that can't be imported."""
    return docs.filter(F.col("falla").isNotNull()).drop("f")


def rejected_costs(costs: DataFrame) -> DataFrame:
    """Rows whose amount has text that is no number."""
    return costs.filter(~_blank(F.col("importe_texto")) & F.col("importe").isNull())
