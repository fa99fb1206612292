"""Money normaliser and the three import-file readers on synthetic files."""

from __future__ import annotations

import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from condofin.functions.money import format_money, parse_decimal_comma, parse_flag, parse_money
from condofin.sources import files as S

CASES = [
    ("41,305.27", "41305.27"), ("58.912,63", "58912.63"), ("246,175,00", "246175.00"),
    ("0,00", "0.00"), ("1.234", "1234.00"), ("1,234", "1234.00"), ("15", "15.00"),
    (" 7.218,45 ", "7218.45"), ("$ 1,000.5", "1000.50"), ("", None), (None, None), ("abc", None),
]


def test_parse_money_shapes(spark):
    df = spark.createDataFrame([(a,) for a, _ in CASES], "t string")
    got = [r.v for r in df.select(parse_money(F.col("t")).alias("v")).collect()]
    assert got == [None if b is None else Decimal(b) for _, b in CASES]


@pytest.mark.parametrize("shape", [0, 1, 2, 3])
def test_format_then_parse_is_identity(spark, shape):
    vals = ["0.00", "0.05", "7.10", "999.99", "1000.00", "41305.27", "1234567.89"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "v decimal(18,2)")
    back = df.select(parse_money(format_money(F.col("v"), shape)).alias("b")).collect()
    assert [r.b for r in back] == [Decimal(v) for v in vals]


def test_decimal_comma_and_flags(spark):
    df = spark.createDataFrame([("4,4", "SI"), ("10", " no "), (None, "x")], "c string, f string")
    got = df.select(parse_decimal_comma(F.col("c")).alias("c"), parse_flag(F.col("f")).alias("f")).collect()
    assert [(r.c, r.f) for r in got] == [(Decimal("4.4000"), True), (Decimal("10.0000"), False), (None, None)]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_read_unit_accounts(spark, tmp_dir):
    text = ("CVU/CBU|Nombre del consorcio|nroUnidadFuncional|piso|departamento\n"
            "0000000000000000000001|Edificio Uno|1|PB|A\n"
            "0000000000000000000002|Edificio Uno|2|1|B\n"
            "0000000000000000000003|Torre Dos|1|PB|A\n\n")
    df = S.read_unit_accounts(spark, _write(os.path.join(tmp_dir, "acc.csv"), text))
    rows = df.orderBy("cbu_cvu").collect()
    assert len(rows) == 3
    assert rows[0].asDict() == {"cbu_cvu": "0000000000000000000001", "consorcio_nombre": "Edificio Uno",
                                "nro_uf": 1, "piso": "PB", "depto": "A"}
    assert dict(df.dtypes)["cbu_cvu"] == "string"


def test_read_units_and_split(spark, tmp_dir):
    head = "\t".join(S.UNIT_FIELDS)
    lines = ["Edificio Uno\t1\tPB\tA\t4,4\t45\tSI\tSI\t4\t8",
             "Edificio Uno\t2\tPB\tB\t5,6\t50\tNO\tSI\t0\t12",
             "Torre Dos\t1\t1\tA\t10\t60\tNO\tNO\t0\t0",
             "\t\t\t", "\t\t\t"]
    df = S.read_units(spark, _write(os.path.join(tmp_dir, "uf.txt"), head + "\n" + "\n".join(lines) + "\n"))
    units, acc = S.split_units(df)
    assert units.count() == 3
    assert {r.consorcio_nombre: float(r.c) for r in
            units.groupBy("consorcio_nombre").agg(F.sum("coeficiente").alias("c")).collect()} == \
        {"Edificio Uno": 10.0, "Torre Dos": 10.0}
    got = sorted((r.nro_uf, r.tipo_accesorio, float(r.m2_accesorio)) for r in acc.collect())
    assert got == [(1, "BAULERA", 4.0), (1, "COCHERA", 8.0), (2, "COCHERA", 12.0)]


def test_read_service_costs(spark, tmp_dir):
    docs = [
        {"_id": {"$oid": "x1"}, "Nombre del consorcio": "Edificio Uno", "Mes": "junio", "Anio": 2024,
         "BANCARIOS": "41,305.27", "LIMPIEZA": "88,100.00", "ADMINISTRACION": "61,050.00",
         "SEGUROS": "58.912,63", "GASTOS GENERALES": "7.218,45", "SERVICIOS PUBLICOS-Agua": "246,175,00",
         "SERVICIOS PUBLICOS-Luz": "0,00", "ASCENSORES": "500,00"},
        {"_id": {"$oid": "x2"}, "Nombre del consorcio": "Edificio Uno", "Mes": "mayo ",
         "BANCARIOS": "1.000,00", "LIMPIEZA": "2,000.00", "ADMINISTRACION": "3,00",
         "SEGUROS": "4", "GASTOS GENERALES": "no sabe", "SERVICIOS PUBLICOS-Agua": "6.000"},
        {"_id": {"$oid": "x3"}},
    ]
    path = _write(os.path.join(tmp_dir, "costs.json"), json.dumps(docs, indent=2))
    df = S.read_service_costs(spark, path)
    got = {(r.mes, r.categoria): r.importe for r in df.collect()}
    assert len(got) == df.count() == 15  # seven listed categories each, and one more that a document has
    assert got[(6, "BANCARIOS")] == Decimal("41305.27")
    assert got[(6, "SERVICIOS PUBLICOS-Agua")] == Decimal("246175.00")
    assert got[(6, "ASCENSORES")] == Decimal("500.00")
    assert got[(5, "SERVICIOS PUBLICOS-Agua")] == Decimal("6000.00")
    assert got[(5, "SERVICIOS PUBLICOS-Luz")] is None
    assert {(r.anio, r.mes_nombre) for r in df.collect()} == {(2024, "junio"), (None, "mayo")}
    assert [(r.mes, r.categoria, r.importe_texto) for r in S.rejected_costs(df).collect()] == [
        (5, "GASTOS GENERALES", "no sabe")]


def test_every_unit_line_is_accounted_for(spark, tmp_dir):
    """Lines in = rows out + rejects + blank lines, with a code for each fault."""
    head = "\t".join(S.UNIT_FIELDS)
    lines = {
        "Uno\t1\tPB\tA\t4,4\t45\tSI\tS\u00cd\t4\t8": [], "Uno\t2\tPB\tB\t5,6\t50\tn\ts\t0\t12": [],
        "Uno\t3\tPB\tC\t5,6\t50\t\tNO\t\t": [],
        "Uno\t4\tPB\tD\t5,6\t50\tquiz\u00e1s\tY\t4\t12": ["bauleras", "cochera"],
        "Uno\t5\tPB\tE\t5,6\t50\tNO\t\t4\t12": ["sin_bauleras", "sin_cochera"],
        "Uno\tseis\tPB\tF\tcinco\t5.0.0\tNO\tNO\tx\ty": ["nro_uf", "coeficiente", "m2_unidad", "m2_baulera", "m2_cochera"],
        "Uno\t7\tPB": ["campos"], "Uno\t8\tPB\tG\t1\t1\tNO\tNO\t0\t0\tde m\u00e1s": ["campos"],
        "\t9\tPB\tH\t1\t1\tNO\tNO\t0\t0": ["consorcio"],
        "\t\t\t": None, "\t \t\t\t\t\t\t\t\t\t\t\t": None,
    }
    path = _write(os.path.join(tmp_dir, "uf.txt"), head + "\n" + "\n".join(lines) + "\n")
    checked = S.read_checked_units(spark, path)
    good, bad = S.accepted(checked), S.rejects(checked)
    assert sorted(r.nro_uf for r in good.collect()) == [1, 2, 3]
    assert sorted((r.linea, r.fallas) for r in bad.collect()) == sorted((t, f) for t, f in lines.items() if f)
    counts = {r.falla: r.filas for r in S.count_faults(checked).collect()}
    # the reader passes over the two lines of white space
    assert counts == {"ninguna": 3, "bauleras": 1, "cochera": 1, "sin_bauleras": 1, "sin_cochera": 1, "nro_uf": 1,
                      "coeficiente": 1, "m2_unidad": 1, "m2_baulera": 1, "m2_cochera": 1, "campos": 2, "consorcio": 1}
    assert good.count() + bad.count() == checked.count() == len(lines) - 2
    _, acc = S.split_units(good)
    assert sorted((r.nro_uf, r.tipo_accesorio) for r in acc.collect()) == [(1, "BAULERA"), (1, "COCHERA"), (2, "COCHERA")]
    # the twin for lines that are in a table already
    twin = S.parse_unit_lines(spark.createDataFrame([(t,) for t in lines], "value string"))
    assert sorted(twin.collect()) == sorted(good.collect())


def test_every_account_line_is_accounted_for(spark, tmp_dir):
    lines = {"1|Uno|1|PB|A": [], " 2 |Uno| 2 ||": [], "|Uno|3|PB|C": ["cuenta"], "4||x|PB|D": ["consorcio", "nro_uf"],
             "5|Uno": ["campos", "nro_uf"], "6|Uno|6|PB|A|B": ["campos"], "||||": None}
    path = _write(os.path.join(tmp_dir, "acc.csv"), "|".join(S.ACCOUNT_FIELDS) + "\n" + "\n".join(lines) + "\n")
    checked = S.read_checked_unit_accounts(spark, path)
    assert sorted((r.cbu_cvu, r.nro_uf) for r in S.read_unit_accounts(spark, path).collect()) == [("1", 1), ("2", 2)]
    assert sorted((r.linea, r.fallas) for r in S.rejects(checked).collect()) == sorted((t, f) for t, f in lines.items() if f)
    assert checked.where("vacia").count() == 1 and checked.count() == len(lines)


def test_large_files_are_parsed_by_many_tasks(spark, tmp_dir):
    line = "0000000000000000000009|Torre Dos|3|2|C\n"
    path = _write(os.path.join(tmp_dir, "acc.csv"), "|".join(S.ACCOUNT_FIELDS) + "\n" + line * 3000)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = S.read_unit_accounts(spark, path)
        assert got.rdd.getNumPartitions() >= 7 and got.count() == 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_line_parsers_match_file_readers(spark, tmp_dir):
    line = "0000000000000000000009|Torre Dos|3|2|C"
    a = S.parse_unit_account_lines(spark.createDataFrame([(line,)], "value string")).collect()[0]
    assert (a.cbu_cvu, a.consorcio_nombre, a.nro_uf, a.piso, a.depto) == \
        ("0000000000000000000009", "Torre Dos", 3, "2", "C")
