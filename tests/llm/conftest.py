import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that operators use for own columns: as extra columns of the input they must not clash.
CLASHING = ("doc", "fp", "kept", "n_words", "n_hit", "items", "spans", "size", "copies", "pi", "block", "g", "o",
            "tie", "pos", "row", "component_id", "lang_pred", "rejected", "label", "text_", "words", "n_lines")


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of documents from (doc_id, text, lang, source) rows; extra adds clashing columns."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, schema).repartition(4)
        return df.withColumns({c: F.lit(c) for c in CLASHING}) if extra else df
    return make


EDGES = [
    (1, None), (2, ""), (3, "   \n \t"), (4, "Avec."), (5, "one two three"), (6, "one two three"),
    (None, "one two three four five six seven eight"), (None, None),
    (7, "!!! ??? ..."), (8, "\x00 zero \x1f byte"), (8, "a second row with this id"), (8, "a second row with this id"),
    (9, "日本語 テキスト ñandú Ünï"), (10, "line one here now\nline one here now\n\nline one here now extra"),
    (11, " ".join("long%d" % (i % 997) for i in range(150_000))),
]


@pytest.fixture(scope="session")
def edges():
    return list(EDGES)
