"""The weekly and by-source reports as XML.

The numbers are those of W01 / W03 (same plan functions).  The XML shape:

* W09: root ``FlujoCajaSemanal``, one ``Semana`` element per row with
  attribute ``consorcio_id``, children ``Anio``, ``Semana``,
  ``Recaudacion/{Ordinario, Extraordinario, TotalSemana}`` and
  ``Indicadores/{PromedioPeriodo, AcumuladoProgresivo}``;
* W10: root ``RecaudacionPorProcedencia``, one ``Periodo`` element per row
  with attribute ``consorcio_id``, children ``Periodo/{Anio, Mes}`` and
  ``Recaudacion/{Ordinario, Extraordinario, Mora, Total}``.

Rows are ordered by building, year, week / month.  Money is DECIMAL(38,2)
and the mean DECIMAL(38,6) so the text is plain (no exponent notation).
NULL fields are omitted, as FOR XML PATH does.

Three outputs: the ``*_xml_rows`` functions return one ``to_xml`` string per
row in report order, the ``*_xml`` functions the lines of one document (root
element, then the rows) with a ``line`` number, and :func:`write_xml_document`
writes through Spark's XML data source, as one file or as ordered part files:
the caller says which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Tables
from ..operators.windows import dense_row_number
from ..params import ReportParams
from . import reports as R

# XML element names of the two documents.
W09_ROOT, W09_ROW = "FlujoCajaSemanal", "Semana"
W10_ROOT, W10_ROW = "RecaudacionPorProcedencia", "Periodo"
ATTR_PREFIX = "_"
MONEY_XML = T.DecimalType(38, 2)
MEAN_XML = T.DecimalType(38, 6)


def weekly_cash_flow_struct(tables: Tables, params: ReportParams = ReportParams(),
                            fanout: str = "reference") -> DataFrame:
    w = R.weekly_cash_flow(tables, params, fanout, ordered=False)
    m = lambda c: F.col(c).cast(MONEY_XML)
    return w.select(
        F.col("consorcio_id").alias(ATTR_PREFIX + "consorcio_id"),
        "Anio", "Semana",
        F.struct(m("TotalOrdinario").alias("Ordinario"),
                 m("TotalExtraordinario").alias("Extraordinario"),
                 m("TotalSemana").alias("TotalSemana")).alias("Recaudacion"),
        F.struct(F.col("PromedioPeriodo").cast(MEAN_XML).alias("PromedioPeriodo"),
                 m("AcumuladoProgresivo").alias("AcumuladoProgresivo")).alias("Indicadores"),
    )


def collections_by_source_struct(tables: Tables, params: ReportParams = ReportParams(),
                                 fanout: str = "reference") -> DataFrame:
    r = R.collections_by_source(tables, params, fanout, ordered=False)
    m = lambda c: F.col(c).cast(MONEY_XML)
    return r.select(
        F.col("consorcio_id").alias(ATTR_PREFIX + "consorcio_id"),
        F.struct("Anio", "Mes").alias("Periodo"),
        F.struct(m("TotalOrdinario").alias("Ordinario"),
                 m("TotalExtraordinario").alias("Extraordinario"),
                 m("TotalMora").alias("Mora"),
                 m("TotalPeriodo").alias("Total")).alias("Recaudacion"),
    )


def _rows(df: DataFrame, row_tag: str, keys: list) -> DataFrame:
    body = F.struct(*[F.col(c) for c in df.columns])
    return df.select(*keys, F.to_xml(body, {"rowTag": row_tag, "attributePrefix": ATTR_PREFIX})
                     .alias("xml"))


def weekly_cash_flow_xml_rows(tables: Tables, params: ReportParams = ReportParams()) -> DataFrame:
    """W09 per row: ``consorcio_id, Anio, Semana, xml``."""
    return _weekly_rows(tables, params).orderBy("consorcio_id", "Anio", "Semana")


def _weekly_rows(tables: Tables, params: ReportParams) -> DataFrame:
    return _rows(weekly_cash_flow_struct(tables, params), W09_ROW,
                 [F.col("_consorcio_id").alias("consorcio_id"), "Anio", F.col("Semana").alias("Semana")])


def collections_by_source_xml_rows(tables: Tables, params: ReportParams = ReportParams()) -> DataFrame:
    """W10 per row: ``consorcio_id, Anio, Mes, xml``."""
    return _source_rows(tables, params).orderBy("consorcio_id", "Anio", "Mes")


def _source_rows(tables: Tables, params: ReportParams) -> DataFrame:
    return _rows(collections_by_source_struct(tables, params), W10_ROW,
                 [F.col("_consorcio_id").alias("consorcio_id"),
                  F.col("Periodo.Anio").alias("Anio"), F.col("Periodo.Mes").alias("Mes")])


def _document(rows: DataFrame, root: str, keys: list[str]) -> DataFrame:
    """``line, xml``: the root's opening tag, the rows in the order of ``keys``
    and the closing tag.  Numbers come from the distributed row number, so no
    task holds the document; ordered by ``line`` it is one document.  The rows
    are sorted and written once; their number comes with that write."""
    spark, seen = rows.sparkSession, Observation()
    body = dense_row_number(rows, keys, "line", watch=seen, metrics=(F.count(F.lit(1)).alias("n"),)).select("line", "xml")
    ends = spark.createDataFrame([(0, f"<{root}>"), (seen.get["n"] + 1, f"</{root}>")], "line bigint, xml string")
    return body.unionByName(ends).orderBy("line")


def weekly_cash_flow_xml(tables: Tables, params: ReportParams = ReportParams()) -> DataFrame:
    """W09 as one document (see :func:`_document`)."""
    return _document(_weekly_rows(tables, params), W09_ROOT, ["consorcio_id", "Anio", "Semana"])


def collections_by_source_xml(tables: Tables, params: ReportParams = ReportParams()) -> DataFrame:
    """W10 as one document (see :func:`_document`)."""
    return _document(_source_rows(tables, params), W10_ROOT, ["consorcio_id", "Anio", "Mes"])


def write_xml_document(df: DataFrame, path: str, root_tag: str, row_tag: str,
                       order: list[str], single_file: bool = True) -> None:
    """Write the rows as XML under ``path`` in ``order``.

    ``orderBy`` range-partitions and sorts.  With ``single_file`` the result is
    one document, whatever the number of rows (one task writes it: a document
    has one root); without, ordered part files, each a document with the root
    element, written in parallel.
    """
    out = df.orderBy(*order)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").format("xml")
        .option("rootTag", root_tag).option("rowTag", row_tag)
        .option("attributePrefix", ATTR_PREFIX).save(path))


def write_weekly_cash_flow_xml(tables: Tables, path: str, params: ReportParams = ReportParams(),
                               single_file: bool = True) -> None:
    write_xml_document(weekly_cash_flow_struct(tables, params), path, W09_ROOT, W09_ROW,
                       ["_consorcio_id", "Anio", "Semana"], single_file)


def write_collections_by_source_xml(tables: Tables, path: str, params: ReportParams = ReportParams(),
                                    single_file: bool = True) -> None:
    write_xml_document(collections_by_source_struct(tables, params), path, W10_ROOT, W10_ROW,
                       ["_consorcio_id", "Periodo.Anio", "Periodo.Mes"], single_file)


def parse_xml_rows(xml_rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Read ``xml`` strings back with ``from_xml`` (round-trip checks)."""
    return xml_rows.select(F.from_xml("xml", schema, {"attributePrefix": ATTR_PREFIX}).alias("r")) \
                   .select("r.*")
