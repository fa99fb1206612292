"""Mixing sources to target weights by balanced sampling (cube method).

Every document is expected ``target / size`` times, by its source's target.
The whole part is certain; the fraction is an inclusion probability, and the
cube method turns those probabilities into zeros and ones while token and
document totals stay balanced: three fractional documents at a time move along
the null-space of the two constraints until one of them is decided.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import dense_row_number, expand_counts
from .common import materialize

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Documents of one source that one flight holds.
BLOCK = 4096
#: A table of at most so many sources is broadcast; a larger one is joined.
BROADCAST_SOURCES = 100_000
#: Fractional documents of a block, from its largest to its smallest, that its flight
#: leaves alone: they and what the last flight leaves are the landing problem.
RESERVE = 14
#: Equal rows that one row of a chunk stands for.
CHUNK = 10_000
EPS = 1e-9


def size_column(text: Column) -> Column:
    """Number of words; null has none."""
    parts = F.split(text, "[\\x20\\x09-\\x0D]+")
    blank = (F.element_at(parts, 1) == "").cast("int") + \
        F.when(F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("int")).otherwise(0)
    return F.coalesce((F.size(parts) - blank).cast("bigint"), F.lit(0).cast("bigint"))


def flight(pi: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Inclusion probabilities after the flight phase over units in the given
    order; at most two (unequal) units stay fractional.  Sums of ``pi`` and of
    ``pi * size`` are kept."""
    p, s = pi.tolist(), size.tolist()
    waiting = [i for i in range(len(p) - 1, -1, -1) if EPS < p[i] < 1 - EPS]
    out = [0.0 if x <= EPS else 1.0 if x >= 1 - EPS else x for x in p]
    live: list[int] = []
    draw = iter(draws.tolist())
    while True:
        while len(live) < 3 and waiting:
            live.append(waiting.pop())
        if len(live) == 3:
            a, b, c = (s[i] for i in live)
            u = [b - c, c - a, a - b]
            if u == [0, 0, 0]:
                u = [1, -1, 0]
        elif len(live) == 2 and s[live[0]] == s[live[1]]:
            u = [1, -1]
        else:
            return np.array(out)
        ahead = min((1 - out[i]) / d if d > 0 else out[i] / -d for i, d in zip(live, u) if d)
        back = min(out[i] / d if d > 0 else (1 - out[i]) / -d for i, d in zip(live, u) if d)
        move = ahead if next(draw) * (ahead + back) < back else -back
        for i, d in zip(live, u):
            x = out[i] + move * d
            out[i] = 0.0 if x <= EPS else 1.0 if x >= 1 - EPS else x
        live = [i for i in live if 0.0 < out[i] < 1.0]


def reserve(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Marks up to :data:`RESERVE` fractional units of an order by falling size,
    at ranks that grow geometrically: sizes from the largest to the smallest."""
    open_ = np.flatnonzero((pi > EPS) & (pi < 1 - EPS))
    mark = np.zeros(len(pi), dtype=bool)
    if len(open_):
        mark[open_[np.unique(np.geomspace(1, len(open_), RESERVE).astype(int)) - 1]] = True
    return mark


def landing(pi: np.ndarray, size: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Round the few units in ``left``: the choice whose token total, and with
    less weight whose document total, is nearest to the expected one."""
    if not len(left):
        return pi
    s, p = size[left].astype(float), pi[left]
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = np.abs(choices @ s - s @ p) / max(1.0, s.mean()) + 0.1 * np.abs(choices.sum(1) - p.sum())
    out = pi.copy()
    out[left] = choices[int(off.argmin())]
    return out


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` of documents' ``source, size``.

    The total is shared by weight; a target stops at ``MAX_COPIES`` times its
    source's size and the excess goes to the others by weight until none is
    above.  The driver holds two sums a round, never the sources.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = dense_row_number(by_source.withColumn("unnamed", F.col("source").isNull()),
                              ["unnamed", "source"], out="rank").drop("unnamed")
    k = F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (k + 1).cast("int"))
    table = materialize(ranked.select("source", "source_size", weight.cast("double").alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * MAX_COPIES
    level, capped = 0.0, -1
    while total:
        full = most < F.lit(level) * F.col("weight")
        n, held, free = table.agg(F.count(F.when(full, 1)), F.sum(F.when(full, most)),
                                  F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not free:
            break
        level, capped = (total - (held or 0)) / free, n
    target = F.least(most.cast("double"), F.lit(float(level)) * F.col("weight"))
    return table.select("source", "source_size", target.alias("target"))


def _flights(units: DataFrame, level: int, last: bool) -> DataFrame:
    """One flight for each source and block; the last also lands."""
    schema = units.drop("block").schema

    def of_block(key, table):
        source, block = key[0].as_py(), key[1].as_py()
        table = table.drop_columns(["block"])
        order = table.append_column("at", pa.array(range(len(table)))).sort_by(
            [("size", "descending"), ("tie", "ascending"), ("tie2", "ascending"), ("idx", "ascending")]).column("at").to_numpy()
        pi, size = table.column("pi").to_numpy(), table.column("size").to_numpy()
        seed = [zlib.crc32(repr(source).encode()), block, level]
        draws = np.random.default_rng(seed).random(len(order) + 1)
        pi, size = pi[order], size[order]
        kept = reserve(pi, size)
        moved = pi.copy()
        moved[~kept] = flight(pi[~kept], size[~kept], draws)
        if last:
            moved = landing(moved, size, np.flatnonzero((moved > EPS) & (moved < 1 - EPS)))
        out = np.empty(len(order))
        out[order] = moved
        return table.set_column(table.column_names.index("pi"), "pi", pa.array(out))

    return units.groupBy("source", "block").applyInArrow(of_block, schema)


def _chosen(units: DataFrame) -> DataFrame:
    """``tie, tie2, copies`` of units ``source, size, tie, tie2, idx, sure, pi, rows``
    (``rows``: units of the source)."""
    def blocks(df: DataFrame) -> DataFrame:
        n = F.ceil(F.col("rows") / F.lit(BLOCK))
        return df.withColumn("block", F.pmod(F.xxhash64("tie", "idx"), n)).drop("rows")

    decided, level = [], 0
    out = materialize(_flights(blocks(units), 0, last=False))
    while True:
        open_, level = out.where((F.col("pi") > 0) & (F.col("pi") < 1)), level + 1
        decided.append(out.where((F.col("pi") <= 0) | (F.col("pi") >= 1)))
        per = open_.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
        most = per.agg(F.max("rows")).first()[0] or 0
        if most == 0:
            break
        per = per.withColumnRenamed("source", "of")
        joined = open_.join(per, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        if most <= BLOCK:
            decided.append(_flights(joined.drop("rows").withColumn("block", F.lit(0).cast("bigint")), level, last=True))
            break
        out = materialize(_flights(blocks(joined), level, last=False))
    result = decided[0]
    for more in decided[1:]:
        result = result.unionByName(more)
    return result.select("tie", "tie2", (F.col("sure") + F.col("pi").cast("int")).alias("copies"))


def _row_hashes(docs: DataFrame) -> dict[str, Column]:
    """Two hashes of all columns as text; nulls count, so that a value in
    another column is another row."""
    every = [x for c in docs.columns for x in (F.col(c).isNull(), F.col(c).cast("string"))]
    return {"tie": F.xxhash64(*every), "tie2": F.xxhash64(F.lit("second"), *every)}


def _numbered(classes: DataFrame) -> DataFrame:
    """A row per row of a class of equal rows, numbered ``idx`` from 0; large
    classes are expanded in chunks that are spread over tasks."""
    small = classes.where(F.col("n") <= CHUNK)
    n, chunk = F.col("n"), F.col("chunk")
    large = (classes.where(n > CHUNK).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / CHUNK))))
             .repartition(F.col("tie"), F.col("chunk")).withColumns({"from": chunk * CHUNK, "to": F.least(n, (chunk + 1) * CHUNK) - 1}))
    small = small.withColumns({"chunk": F.lit(0).cast("bigint"), "from": F.lit(0).cast("bigint"), "to": n - 1})
    return small.unionByName(large).withColumn("idx", F.explode(F.sequence("from", "to"))).drop("n", "chunk", "from", "to")


def mix(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc`` (struct of the columns ``keep``, else of all), ``size``,
    ``source``, ``source_size``, ``target`` and ``copies`` (0 to 3).

    Null texts have size 0, a null source is a source of its own and comes
    last; empty and very long texts count by their words.  Columns of any name
    stay apart in ``doc``.  With no words at all every target is 0 and nothing
    is taken; an empty table gives no rows.  Reruns agree: blocks, order and
    draws follow from the rows.

    Only sizes and hashes of rows take part in flights, never texts.  Fully
    repeated rows are one class with a count: its rows are units of their own,
    numbered in bounded chunks and spread over blocks, and what was decided for
    them goes back to the class as numbers of rows; so a row that a third of
    the table repeats is in no task whole.
    """
    hashed = docs.select(F.struct(*(keep or ["*"])).alias("doc"), F.col("source"), size_column(F.col("text")).alias("size"),
                         *[c.alias(n) for n, c in _row_hashes(docs).items()])
    classes = materialize(hashed.groupBy("source", "size", "tie", "tie2").agg(F.count(F.lit(1)).alias("n")))
    targets = source_targets(classes.select("source", (F.col("size") * F.col("n")).alias("size")))
    counts = materialize(classes.groupBy("source").agg(F.sum("n").alias("rows")).join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumnRenamed("source", "of"))
    per_source = F.broadcast(counts) if counts.count() <= BROADCAST_SOURCES else counts
    expected = F.when(F.col("source_size") > 0,
                      F.least(F.col("target") / F.col("source_size"), F.lit(float(MAX_COPIES)))).otherwise(0.0)
    units = (_numbered(classes).join(per_source, F.col("source").eqNullSafe(F.col("of")))
             .select("source", "size", "tie", "tie2", "idx", F.floor(expected).cast("int").alias("sure"),
                     (expected - F.floor(expected)).alias("pi"), "rows"))
    outcomes = materialize(_chosen(units).groupBy("tie", "tie2", "copies").agg(F.count(F.lit(1)).alias("k")))
    repeated = classes.where(F.col("n") > 1).select("tie", "tie2")
    key = ["tie", "tie2"]
    alone = hashed.join(outcomes.join(repeated, key, "left_anti").drop("k"), key)
    if not repeated.isEmpty():
        one_of_each = hashed.join(repeated, key, "left_semi").groupBy(*key).agg(
            *[F.first(c).alias(c) for c in ("doc", "source", "size")])
        alone = alone.unionByName(expand_counts(one_of_each.join(outcomes, key), "k"))
    return (alone.join(per_source, F.col("source").eqNullSafe(F.col("of")))
            .select("doc", "size", "source", "source_size", "target", "copies"))


def taken() -> Column:
    """Words that the mix takes of a document, repeats counted."""
    return (F.col("copies") * F.col("size")).cast("bigint")
