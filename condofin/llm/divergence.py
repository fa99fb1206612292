"""Divergence of the sources of a language from each other, and from the whole.

Terms are counted per (language, source) and smoothed to whole-number shares;
two groups differ by the triangular distance of their shares, summed over all
kept terms of the language.  Pairs come from Gustavson's row accumulation: each
group runs through its own terms, and for each term through that term's row of
the term-major index, adding to one dense accumulator of all its peers.  Terms
that only one or neither of two groups has are corrected by the shares that a
count of zero gives, so no posting pair leaves a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialize

#: Documents of its language that a kept term occurs in, at least.
LEAST_DOCS = 10
#: Ranks of terms that are told; pairs are told at all ranks.
TERM_RANKS = 10
#: Whole that shares are parts of, and what is added to every count.
SCALE, SMOOTH = 1_000_000_000, 2
#: Postings of a block of the index, about; a task holds one block.
BLOCK_POSTINGS = 1 << 16
#: Accumulator cells that one task gives back, about.
CELLS = 1 << 21
#: Counts that a task holds before it hands them on.
HELD = 200_000
#: Bytes of a long text that are split into terms at a time.
PART = 1 << 20

_FOLD = bytes(c if c >= 0x80 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def term_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a text (letters and characters beyond ASCII, A-Z lower-cased),
    those of a long one in several lists."""
    folded, at = (text or b"").translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PART)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n`` (occurrences), ``docs`` (documents); a row
    with a null term counts the documents of the group."""
    packed = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                         F.col("text").cast("binary").alias("text"))
    bound_batches(docs.sparkSession)
    schema = "lang string, source string, term string, n bigint, docs bigint"

    def flush(held) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs_of) in held.items():
            terms = list(docs_of)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()),
                 pa.array([docs_of[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2)):
                n, docs_of = held.setdefault((lang, source), (Counter(), Counter()))
                seen = {None}
                for terms in term_lists(text.as_py()):
                    n.update(terms)
                    seen.update(terms)
                docs_of.update(seen)
            if sum(len(d) for _, d in held.values()) > HELD:
                yield from flush(held)
                held = {}
        yield from flush(held)

    return packed.mapInArrow(run, schema).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact for any counts."""
    above = (n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + SMOOTH * terms).cast("decimal(20,0)")
    return 1 + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(20,0)")))


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart(p, q):
    return (p - q) ** 2 // (p + q)


def accumulate(first: int, last: int, zero: np.ndarray, term: np.ndarray, group: np.ndarray,
               p: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For groups ``first`` to ``last`` - 1 the sums of their distances to every
    later group, over the terms of one block of the index.

    ``zero`` are all groups' shares at a count of zero; ``term``, ``group`` and
    ``p`` the postings.  Sums of a block stay below 2 ** 53, so that ``bincount``
    with double weights is exact."""
    order = np.argsort(term, kind="stable")
    _, at = np.unique(term[order], return_index=True)
    index_group, index_p = group[order], p[order]
    starts, ends = at, np.r_[at[1:], len(order)]
    row_of = np.empty(len(order), np.int64)
    row_of[order] = np.repeat(np.arange(len(at)), ends - starts)
    # how often each group has each share: far fewer than its terms
    shares, times = np.unique(np.stack([group, p]), axis=1, return_counts=True)
    by_group = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[by_group], np.arange(len(zero) + 1))
    share_bounds = np.searchsorted(shares[0], np.arange(len(zero) + 1))
    for g in range(first, last):
        peers = zero[g + 1:]
        if not len(peers):
            continue
        neither = _apart(zero[g], peers)
        acc = len(at) * neither  # as if no group had any term
        # terms of g, at the peers' zero
        own = slice(share_bounds[g], share_bounds[g + 1])
        for q, m in zip(shares[1][own], times[own]):
            acc = acc + m * (_apart(q, peers) - neither)
        # terms of the peers, at the zero of g
        later = slice(share_bounds[g + 1], len(times))
        peer = shares[0][later] - g - 1
        acc = acc + _sums(peer, times[later] * (_apart(zero[g], shares[1][later]) - neither[peer]), len(peers))
        # terms that both have: through the index rows of g's terms
        mine = by_group[bounds[g]:bounds[g + 1]]
        rows = row_of[mine]
        length = ends[rows] - starts[rows]
        flat = np.repeat(starts[rows] - np.cumsum(length) + length, length) + np.arange(length.sum())
        q, h = np.repeat(p[mine], length), index_group[flat]
        after = h > g
        q, h, other = q[after], h[after] - g - 1, index_p[flat][after]
        acc = acc + _sums(h, _apart(q, other) - _apart(q, peers[h]) - _apart(zero[g], other) + neither[h], len(peers))
        yield g, acc


def _sums(at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=value, minlength=n).astype(np.int64)


def _of_block(key, postings, groups):
    first, n = groups.column("first")[0].as_py(), len(groups)
    last = min(first + groups.column("step")[0].as_py(), n)
    if len(postings):
        zero = groups.column("zero").to_numpy()[np.argsort(groups.column("gid").to_numpy())]
        term = postings.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        found = list(accumulate(first, last, zero, term, postings.column("gid").to_numpy(), postings.column("p").to_numpy()))
    else:  # no kept term here
        found = [(g, np.zeros(n - 1 - g, np.int64)) for g in range(first, last)]
    return pa.table({"lang": pa.array([key[0].as_py()] * len(found), pa.string()),
                     "gid": pa.array([g for g, _ in found], pa.int64()),
                     "sums": pa.array([acc for _, acc in found], pa.list_(pa.int64()))})


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for all pairs a < b of the groups of a language."""
    by_lang = Window.partitionBy("lang")
    numbered = materialize(groups.select(
        "lang", "source", "zero", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("bigint").alias("gid"),
        F.count(F.lit(1)).over(by_lang).alias("peers"), "postings"))
    blocks = F.greatest(F.ceil(F.col("postings") / BLOCK_POSTINGS), F.lit(1)).cast("bigint")
    step = F.greatest(F.floor(F.lit(CELLS) / F.col("peers")), F.lit(1)).cast("bigint")
    shape = numbered.select("lang", blocks.alias("blocks"), step.alias("step"), "peers").distinct()
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("peers") - 1, F.col("step"))).alias("first")
    ranges = shape.select("lang", "blocks", "step", starts)
    postings = (kept.join(numbered.select("lang", "source", "gid"), ["lang", "source"])
                .join(ranges, "lang").select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "first",
                                             "term", "gid", "p"))
    each = (numbered.select("lang", "gid", "zero").join(ranges, "lang")
            .select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
                    "first", "step", "gid", "zero"))
    each = each.toDF(*each.columns)  # columns of their own: both sides come from one table
    keys = ["lang", "block", "first"]
    bound_batches(kept.sparkSession)
    partial = postings.groupBy(*keys).cogroup(each.groupBy(*keys)).applyInArrow(
        _of_block, "lang string, gid bigint, sums array<bigint>")
    sums = (partial.select("lang", "gid", F.posexplode("sums").alias("pos", "value"))
            .groupBy("lang", "gid", (F.col("gid") + 1 + F.col("pos")).alias("other")).agg(F.sum("value").alias("value")))
    names = numbered.select("lang", "gid", "source")
    return (sums.join(names.withColumnRenamed("source", "a"), ["lang", "gid"])
            .join(names.select("lang", F.col("gid").alias("other"), F.col("source").alias("b")), ["lang", "other"])
            .select("lang", "a", "b", "value"))


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs`` (``lang``,
    ``source``, ``text``; other columns are not read, so their names don't
    matter).

    ``pair``: the distance to each other source of the language, 0 if it keeps
    no term.  ``term``: the terms that the group has more of than its language,
    the :data:`TERM_RANKS` with the largest distance.  Ranks follow from value,
    then item, so ties have one order.  Nulls are read as empty strings; empty
    texts have no terms but their group counts; texts are read whole; repeated
    rows are documents of their own; an empty table gives no rows.
    """
    counted = materialize(term_counts(docs))
    terms = counted.where(F.col("term").isNotNull())
    of_lang = materialize(terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                          .where(F.col("docs") >= LEAST_DOCS).drop("docs"))
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    met = materialize(terms.drop("docs").join(of_lang, ["lang", "term"]))
    totals = met.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    postings = met.groupBy("lang").agg(F.count(F.lit(1)).alias("postings"))
    zero = F.lit(0).cast("bigint")
    groups = materialize(
        counted.where(F.col("term").isNull()).select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(postings, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total", "postings")])
        .withColumn("zero", share(zero, F.col("total"), F.col("terms"))))
    kept = met.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    top = (kept.where(F.col("p") > F.col("q"))
           .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                   apart(F.col("p"), F.col("q")).alias("value"))
           .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TERM_RANKS))
    pairs = _pairs(kept.drop("q"), groups)
    both = (pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("of"),
                         "value")
            .select("lang", "of.source", F.lit("pair").alias("part"), "of.item", "value")
            .withColumn("rank", F.row_number().over(ranked)))
    return both.unionByName(top)
