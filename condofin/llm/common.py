"""Helpers shared by the operators: words, digests, Arrow mapping, shared tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_table

__all__ = ["materialize", "read_table", "map_texts", "words", "plain_words", "comma_digest",
           "word_column", "WORD", "PLAIN_WORD", "text_bytes", "rebuild", "in_slices"]

#: The two kinds of words that the contracts name.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_WORD = r"[^\x20\x09-\x0D]+"

_LETTERS_DIGITS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c if c >= 0x80 or c in _LETTERS_DIGITS else c + 32 if 65 <= c <= 90 else 32
              for c in range(256))

#: Rows handled at a time inside an Arrow batch, so that results of one slice,
#: not of a whole batch, are held.
SLICE_ROWS = 256


_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
          "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage ends there, a lost executor costs nothing that is written,
    and the shuffle files that the job needed are given back at its end."""
    spark = df.sparkSession
    path = scratch_table(spark)
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of :data:`WORD`; null has none."""
    return text.translate(_FOLD).split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Words of :data:`PLAIN_WORD`: ``bytes.split`` cuts at space and 0x09-0x0D."""
    return text.split() if text else []


def comma_digest(values: list[str]) -> str:
    """Lowercase hex SHA-256 of the comma-joined values."""
    return hashlib.sha256(",".join(values).encode()).hexdigest()


def word_column(text: Column) -> Column:
    """:func:`words` as a column expression (for the small benchmark table)."""
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_extract_all(folded, F.lit(f"({WORD})"), F.lit(1)),
                      F.array().cast("array<string>"))


def in_slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_texts(docs: DataFrame, make: Callable[[], Callable[[bytes | None], tuple]],
              fields: str, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: a struct ``doc`` with its columns (those in
    ``keep``, else all), and ``fields`` (a DDL string) computed from the UTF-8
    bytes of ``column``.

    ``make`` runs once per task and returns the function of one text.  The
    struct keeps own columns apart from columns of ``docs`` that carry the same
    name.
    """
    own = T._parse_datatype_string(fields)
    inside = keep is None or column in keep  # then the text travels once, in the struct
    own_text = [] if inside else [F.col(column).cast("binary").alias("text")]
    packed = docs.select(F.struct(*(keep or ["*"])).alias("doc"), *own_text)
    schema = T.StructType([packed.schema["doc"], *own.fields])
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(own)
        of_text = make()
        for batch in batches:
            for part in in_slices(batch):
                texts = part.column(0).field(column).cast(pa.binary()) if inside else part.column(1)
                got = [of_text(x.as_py()) for x in texts]
                cols = [pa.array([g[i] for g in got], type=f.type) for i, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols],
                                                 names=["doc", *arrow.names])

    return packed.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand Python workers smaller Arrow batches than by
    default (10,000 rows), so that long rows don't fill a worker's memory.
    Results don't depend on it."""
    for key, most in _BATCH.items():
        spark.conf.set(key, most)


def rebuild(columns: list[str], **changed: Column) -> list[Column]:
    """The columns of ``doc`` under their own names, some of them replaced."""
    return [changed[c].alias(c) if c in changed else F.col("doc").getField(c).alias(c)
            for c in columns]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts (one narrow aggregate over the column)."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
