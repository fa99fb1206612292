"""A training-data pipeline over ``documents``: five stages in a row.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents`` (the last adds its own).  ``run``
writes every stage's result as Parquet to the shared checkpoint folder and
reads it back as the next one's input.

Every stage takes nulls in any column, empty and very long texts (read whole),
repeated ids and rows, extra columns of any name (carried along; the last
stage's own columns replace those of the same name) and tables without rows
(which give none).  What each does with them is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from condofin.llm import decontaminate, language, lines, mixing, simhash
from condofin.llm.common import materialize, read_table, rebuild


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text lies near a centroid of some language.

    Null texts and texts without a letter go; repeated rows stay or go alike;
    with nothing to learn from (no language named) all documents go."""
    found = language.identify(docs, language.learn(docs))
    return found.where(~F.col("rejected")).select(*rebuild(docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier line equals or nearly equals; documents
    left without any words go.

    Null texts and texts without words are unchanged and stay; a null id comes
    first, rows that share an id are ordered by a hash of the row; fully
    repeated rows keep or lose the same lines, so copies of a whole row are
    left to the next stage."""
    return lines.dedup_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints.

    Null and empty texts have fingerprint 0 and are one group; the smallest id
    of a group stays, null ids last, and of rows that share it the least by a
    hash of all columns; of fully repeated rows one stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents, and without benchmark passages in the others.

    Null and empty texts have no hits and stay as they are; repeated rows are
    judged alike and all stay; an empty benchmark changes nothing."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (``copies``) and their
    sizes and targets; own columns replace columns of the same name.

    Null and empty texts have size 0 and are not taken; a null source is a
    source of its own; fully repeated rows are documents of their own."""
    own = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
           "copies": F.col("copies"), "taken": mixing.taken()}
    mixed = mixing.mix(docs).where(F.col("copies") > 0)
    return mixed.select(*rebuild([c for c in docs.columns if c not in own]),
                        *[c.alias(n) for n, c in own.items()])


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("mixing_to_weights", mixing_to_weights),
]

#: SQL can express neither the centroids, nor the fingerprints, nor the mix:
#: tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
