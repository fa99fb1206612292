"""Files that hold one JSON array each, read by many tasks.

The file is read as text cut at closing braces, so Spark splits it by byte
ranges like any text.  A task can't tell from its own range whether that begins
inside a string, nor how deep: so a first pass notes for every range how it
would end if it began outside or inside a string, these notes are put together
file by file (a row per range), and a second pass cuts every range into the
array's elements from its known beginning.  What an element has in two or more
ranges is joined again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.windows import materialize

#: Elements with more bytes are handed on in parts, as rejects.
MOST = 16 << 20

_BORDER = ("file string, block bigint, size bigint, bytes bigint, first binary, "
           "ends_in boolean, deeper bigint, ends_in_string boolean, deeper_string bigint")
_PIECE = "file string, block bigint, n bigint, kind string, long boolean, value binary"

# a string, up to its quote or to a line feed, which no JSON string holds: so
# a quote that is missing damages one element only
_BODY = rb'[^"\\\n]*+(?:\\[^\n][^"\\\n]*+)*+'
_CLOSED = re.compile(rb'"' + _BODY + rb'(?:"|\\?(?=\n))')
_TOKEN = re.compile(rb'"' + _BODY + rb'("|\\?(?=\n)|\\?\Z)|[\[\]{},]')
_REST = re.compile(_BODY + rb'("|\\?(?=\n)|\\?\Z)')
_OPEN, _CLOSE = b"{[", b"}]"


def _after_string(data: bytes) -> tuple[int, bool]:
    """Where the string that ``data`` begins in ends, and whether it goes on."""
    m = _REST.match(data)
    return m.end(), m.end() == len(data) and m.group(1) != b'"'


def _shift(data: bytes, in_string: bool) -> tuple[bool, int]:
    """Whether ``data`` ends inside a string, and how many levels deeper."""
    if in_string:
        at, on = _after_string(data)
        if on:
            return True, 0
        data = data[at:]
    outside = _CLOSED.sub(b"", data)
    at = outside.find(b'"')
    if at >= 0:
        outside = outside[:at]
    return at >= 0, sum(map(outside.count, (b"{", b"["))) - sum(map(outside.count, (b"}", b"]")))


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """The ranges of a task: their other columns, and their texts in order."""
    def rows():
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(columns))))
            for key, value in zip(keys, batch.column(columns)):
                yield key, value.as_py()

    for key, of_block in groupby(rows(), key=lambda r: r[0]):
        yield key, (value for _, value in of_block)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block, size), texts in _blocks(batches, 3):
        state, length, first = [(False, 0), (True, 0)], 0, b""
        for value in texts:
            length += len(value) + 1
            data = value + b"}"
            first = first or data.removeprefix(b"\xef\xbb\xbf").strip()[:1]
            state = [(s, d + more) for on, d in state for s, more in [_shift(data, on)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (file, block, size, length, first, *state[0], *state[1])],
            names=["file", "block", "size", "bytes", "first", "ends_in", "deeper", "ends_in_string", "deeper_string"])


def _compose(ranges):
    """State at the beginning of every range of a file, in their order.
    ``base`` is the depth of elements: 1 in an array, 0 where a file holds
    values one after the other; ``cut`` says that no brace follows the last text."""
    ranges = ranges.sort_values("block")
    in_string, depth, out = False, 0, []
    base = int(bytes(ranges["first"].iloc[0]) == b"[")
    cut = ranges["bytes"].sum() != ranges["size"].iloc[0]
    for r in ranges.itertuples():
        out.append((r.file, r.block, in_string, depth, base, bool(cut and r.block == ranges["block"].iloc[-1])))
        in_string, depth = (r.ends_in_string, depth + r.deeper_string) if in_string else (r.ends_in, depth + r.deeper)
    return pd.DataFrame(out, columns=["file", "block", "in_string", "depth", "base", "cut"])


class _Cutter:
    """Cuts the text of one range into elements."""

    def __init__(self, in_string: bool, depth: int, base: int):
        self.in_string, self.depth, self.base = in_string, depth, base
        self.held: list[bytes] = []
        self.size, self.long, self.bounds = 0, False, 0

    def _hold(self, data: bytes) -> Iterator[tuple[str, bool, bytes]]:
        self.held.append(data)
        self.size += len(data)
        if self.size > MOST:  # hand on what there is; the rest of the element follows
            self.long = True
            yield "part", True, b"".join(self.held)
            self.held, self.size = [], 0

    def _bound(self, data: bytes) -> tuple[str, bool, bytes]:
        out = ("inner" if self.bounds else "head", self.long, b"".join([*self.held, data]))
        self.held, self.size, self.long = [], 0, False
        self.bounds += 1
        return out

    def feed(self, data: bytes) -> Iterator[tuple[str, bool, bytes]]:
        at = 0
        if self.in_string:
            at, self.in_string = _after_string(data)
        done = 0
        for m in _TOKEN.finditer(data, at) if not self.in_string else ():
            c = data[m.start()]
            if c == 0x22:
                self.in_string = m.end() == len(data) and m.group(1) != b'"'
            elif c in _OPEN:
                if self.depth == 0 and self.base == 1 and c == 0x5B:
                    yield self._bound(data[done:m.start()])
                    done = m.end()
                self.depth += 1
            elif c in _CLOSE:
                self.depth -= 1
                if self.depth == 0 and self.base == 1 and c == 0x5D:
                    yield self._bound(data[done:m.start()])
                    done = m.end()
                elif self.depth == self.base:
                    yield self._bound(data[done:m.end()])
                    done = m.end()
            elif self.depth == self.base:
                yield self._bound(data[done:m.start()])
                done = m.end()
        yield from self._hold(data[done:])

    def end(self) -> tuple[str, bool, bytes]:
        return "tail" if self.bounds else "through", self.long, b"".join(self.held)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.string()), pa.array(cols[4], pa.bool_()), pa.array(cols[5], pa.binary())],
            names=["file", "block", "n", "kind", "long", "value"])

    def cut_up(block, texts, cutter, cut):
        held = next(texts)
        if block == 0:
            held = held.removeprefix(b"\xef\xbb\xbf")
        for value in texts:
            yield from cutter.feed(held + b"}")
            held = value
        yield from cutter.feed(held if cut else held + b"}")
        yield cutter.end()

    for (file, block, in_string, depth, base, cut), texts in _blocks(batches, 6):
        rows, size = [], 0
        for n, (kind, long, text) in enumerate(cut_up(block, texts, _Cutter(in_string, depth, base), cut)):
            if kind not in ("inner", "part") or text.strip():
                rows.append((file, block, n, kind, long, text))
                size += len(text)
            if size > MOST or len(rows) >= 1000:
                yield flush(rows)
                rows, size = [], 0
        if rows:
            yield flush(rows)


@contextmanager
def _same_splits(spark: SparkSession):
    """Both passes cut the files alike, also if executors come or go between."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read_json_elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, n, value, long``: the elements of the JSON arrays in the
    files of ``path``, as text, whether or not they are valid; ``block`` (the
    first byte of a range) and ``n`` order those of a file.

    A file may also hold values one after the other (JSON lines).  Blank
    elements (an empty array, a comma too many) are no elements.  A missing
    quote damages its own element if lines break after it, a missing brace all
    that follow in its file: they come as one element.  Elements of more than
    :data:`MOST` bytes come in parts, with ``long`` set.  Computed at the call
    and written once to the scratch folder.
    """
    with _same_splits(spark):
        texts = (spark.read.option("lineSep", "}").text(path)
                 .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value")))
        states = materialize(texts.mapInArrow(_borders, _BORDER).groupBy("file").applyInPandas(
            _compose, "file string, block bigint, in_string boolean, depth bigint, base int, cut boolean"))
        # one row per range of the files, as many as the scan has splits
        known = texts.join(F.broadcast(states), ["file", "block"], "left").select(
            "file", "block", *[F.when(F.col("depth").isNull(), F.raise_error("the files' ranges have changed"))
                               .otherwise(F.col(c)).alias(c) for c in ("in_string", "depth", "base", "cut")], "value")
        pieces = materialize(known.mapInArrow(_pieces, _PIECE))
    whole = pieces.where(F.col("kind").isin("inner", "part"))
    open_ = pieces.where(~F.col("kind").isin("inner", "part"))  # two rows of a range at most
    in_order = Window.partitionBy("file").orderBy("block", "n")
    begun = F.max(F.when(F.col("kind") == "tail", F.col("block"))).over(in_order)
    joined = (open_.withColumn("from", F.coalesce(begun, F.lit(-1).cast("bigint"))).groupBy("file", "from")
              .agg(F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("of"), F.max("long").alias("long"),
                   F.sum(F.octet_length("value")).alias("size")))
    too_long = F.col("long") | (F.col("size") > MOST)
    one = F.array(F.struct(F.col("of")[0]["block"].alias("block"), F.col("of")[0]["n"].alias("n"),
                           F.aggregate("of", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["value"])).alias("value")))
    rest = joined.select("file", too_long.alias("long"), F.explode(F.when(too_long, F.col("of")).otherwise(one)).alias("x"))
    every = whole.select("file", "block", "n", "value", "long").unionByName(
        rest.select("file", "x.block", "x.n", "x.value", "long"))
    text = F.decode("value", "UTF-8")
    return every.select("file", "block", "n", text.alias("value"), "long").where(F.col("value").rlike(r"\S"))

