"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words.  Words are ordered by rarity, so that only the
rarest few of a line (its prefix) need to meet another line's; candidates that
pass the length and positional filters are verified on the words themselves,
and a line goes when an earlier line is as similar as the threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, rebuild, text_bytes

#: Counters of the rarity sketch: every word of the corpus is counted in one.
#: The order it gives is the same for all lines, which is all that exactness
#: asks of it; sharing a counter only makes a word look more frequent.
#: There is about one for each COUNTER_BYTES of text, so that the order is as
#: fine for a large corpus as for a small one; 2 ** MOST_BITS bytes at most.
COUNTER_BYTES = 80
LEAST_BITS, MOST_BITS = 16, 24
#: A word in the prefixes of more than so many distinct lines is a frequent
#: one: its lines first meet only the earliest of them, and those still open
#: then meet all.
FREQUENT = 512
#: Small sides are broadcast up to these numbers of rows, and joined beyond:
#: the frequent words, and the documents with lines to verify (and bytes of the
#: places of these lines).
BROADCAST_WORDS = 500_000
BROADCAST_DOCS, BROADCAST_BYTES = 50_000, 4 << 20
ONCE = 2  # rarity class of a counter that is 1
#: Sets of more words keep the parity of half of the words as well.
WIDE = 64
THRESHOLD = (4, 5)  # Jaccard of 0.8 as a fraction

_BLANK = "[\\x20\\x09\\x0B-\\x0D]+"
_SPACE = "[\\x20\\x09-\\x0D]"


def _ceil(n: Column, num: int, den: int) -> Column:
    """ceil(n * num / den) in whole numbers."""
    return F.floor((n * num + (den - 1)) / den).cast("int")


def _parts(line: Column) -> Column:
    """Words of a line (without line feeds) and empty strings between blanks.
    Cutting at single spaces is the fast case; other blanks are rare."""
    other = line.contains("\t") | line.contains("\r") | line.contains("\x0b") | line.contains("\x0c")
    return F.when(other, F.split(line, _BLANK)).otherwise(F.split(line, " "))


def line_words(line: Column) -> Column:
    """Distinct words of a line."""
    return F.array_remove(F.array_distinct(_parts(line)), "")


def _ordered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc`` (struct), ``text`` and the order of documents ``o``, ``tie``;
    whether an id repeats.

    ``o`` is ``doc_id``, null first; ``tie`` tells rows with one id apart and
    is 0 for all when no id repeats (looked up on the ids alone)."""
    base = docs.select(F.struct("*").alias("doc"), F.col("text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")).alias("o"))
    repeated = _repeats(base)
    fields = [F.col("doc").getField(c) for c in docs.columns]
    tie = F.xxhash64(*[x for f in fields for x in (f.isNull(), f.cast("string"))]) if repeated \
        else F.lit(0).cast("bigint")
    return base.select("doc", "text", "o", tie.alias("tie")), repeated


def _repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("o").count().where("count > 1").isEmpty()


def counter_bits(docs: DataFrame) -> int:
    """Size of the rarity sketch, as a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, round(math.log2(1 + text_bytes(docs) / COUNTER_BYTES))))


def rarity(docs: DataFrame, bits: int) -> DataFrame:
    """One row with an array of 2 ** ``bits`` rarity classes, a byte each
    (twice the log of the counts of all words): of fixed size.  It is put
    together from chunks of 2 ** 16.  The words are those of the lines: a word
    whose counter is 1 stands in one line only."""
    word = F.explode(F.split("text", _SPACE)).alias("word")
    counted = docs.select(word).select(_counter(F.xxhash64("word"), bits).alias("k")).groupBy("k").agg(
        F.floor(2 * F.log2(F.count(F.lit(1)) + 1)).cast("int").alias("c"))
    # place in the chunk and class as one, to be sorted as plain numbers
    both = F.shiftleft(F.col("k").bitwiseAND(F.lit(0xFFFF)), 8).bitwiseOR(F.col("c"))
    some = counted.groupBy(F.shiftright("k", 16).alias("chunk")).agg(F.collect_list(both).alias("some"))
    every = docs.sparkSession.range(1 << (bits - 16)).select(F.col("id").cast("int").alias("chunk"))
    some = every.join(some, "chunk", "left").select(
        "chunk", F.coalesce("some", F.array().cast("array<int>")).alias("some"))
    # counters of no word are of class 0
    none = F.array_except(F.sequence(F.lit(0), F.lit(0xFFFF)), F.transform("some", lambda x: F.shiftright(x, 8)))
    whole = F.sort_array(F.concat("some", F.transform(none, lambda x: F.shiftleft(x, 8))))
    chunks = some.select("chunk", F.transform(
        whole, lambda x: x.bitwiseAND(F.lit(255)).cast("tinyint")).alias("classes"))
    return chunks.agg(F.sort_array(F.collect_list(F.struct("chunk", "classes"))).alias("all")).select(
        F.flatten(F.transform("all", lambda x: x["classes"])).alias("classes"))


def _counter(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def _sets(lines: DataFrame, classes: DataFrame, bits: int, num: int, den: int) -> DataFrame:
    """One row per distinct word set: its first line ``o, tie, pos``, its size
    ``n``, its ``prefix``, ``parity`` (64 bits, each word flips one) and, if ``n``
    is above WIDE, ``parity2`` (the same of about half of the words, else 0).

    A word's key is its rarity class above 56 bits of its hash, so that keys in
    order are words by rarity.  The classes come as a scalar subquery."""
    def key(h):
        # every counter has a class; said to be never null, so that keys are sorted as plain numbers
        known = F.coalesce(F.get(F.col("classes"), _counter(h, bits)), F.lit(0).cast("tinyint"))
        rank = F.shiftleft(known.cast("bigint"), 56)
        return rank.bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))

    hashes = F.array_remove(F.array_distinct(F.transform(_parts(F.col("line")), lambda w: F.xxhash64(w))),
                            F.xxhash64(F.lit("")))
    n = F.size("keys")

    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def flips(own):
        """Parity of the words for which ``own`` is 1, not 0."""
        return F.aggregate("keys", none, lambda bits, k: bits.bitwiseXOR(
            F.call_function("shiftleft", own(k), k.bitwiseAND(F.lit(63)).cast("int"))))
    every, half = flips(lambda k: one), flips(lambda k: F.shiftright(k, 6).bitwiseAND(F.lit(1)))

    sets = (lines.withColumn("classes", classes.scalar()).withColumn("keys", F.sort_array(F.transform(hashes, key)))
        .select(F.struct("o", "tie", "pos").alias("at"), n.alias("n"), every.alias("parity"),
                F.when(n > WIDE, half).otherwise(none).alias("parity2"),
                F.xxhash64("keys").alias("k1"), F.xxhash64(F.lit(1), F.col("keys")).alias("k2"),
                F.slice("keys", F.lit(1), n - _ceil(n, num, den) + 1).alias("prefix"))
        .groupBy("k1", "k2").agg(F.min("at").alias("at"), F.first("n").alias("n"),
                                 F.first("parity").alias("parity"),
                                 F.first("parity2").alias("parity2"), F.first("prefix").alias("prefix")))
    # filtered here, not before: a filter on the keys would compute them twice
    return sets.where(F.col("n") > 0).select("at.*", "n", "parity", "parity2", "prefix")


def removed_lines(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``doc`` (struct of the columns of ``docs``), ``n_lines``, ``n_removed``
    and ``kept`` (the text that is left), a row per document.

    Lines are the parts of ``text`` between line feeds, words their parts
    between blanks (0x20, 0x09-0x0D), unchanged.  A line is removed if a
    line that comes earlier in the order of (``doc_id``, place in the text),
    here or in another document, has a Jaccard similarity of their word sets of
    at least ``threshold`` (a fraction above 0, reduced or not); all lines are judged on the input.
    Lines without words stay.  Null texts have no lines and stay null; null ids
    come first; rows that share an id are ordered by a hash of the row, and
    the lines of fully repeated rows keep or lose alike; very long texts are cut
    into lines whole; columns of any name stay apart in ``doc``; an empty table
    gives no rows.
    """
    num, den = (x // math.gcd(*threshold) for x in threshold)
    if not 0 < num <= den:
        raise ValueError(f"threshold {threshold} is no fraction above 0 and up to 1")
    rows, repeated = _ordered(docs)
    lines = rows.select("o", "tie", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    bits = counter_bits(docs)
    sets = materialize(_sets(lines, materialize(rarity(docs, bits)), bits, num, den))
    texts = rows.select("o", "tie", "text").distinct() if repeated else rows.select("o", "tie", "text")
    # n / (n + 1) below the threshold: only equal sets are similar; a counter of 1: no other line has the word
    postings = (sets.where(F.col("n") * (den - num) >= num).withColumn("band", _band(F.col("n"), num, den))
                .select(F.posexplode("prefix").alias("i", "word"), "o", "tie", "pos", "n", "parity", "parity2", "band")
                .where(F.shiftrightunsigned("word", 56) > ONCE))
    # a word of a lower class stands in FREQUENT places at most (less 1 for the logarithm's rounding)
    least = math.floor(2 * math.log2(FREQUENT + 2)) - 1
    counts = (postings.where(F.shiftrightunsigned("word", 56) >= least)
              .groupBy("word").agg(F.count(F.lit(1)).alias("lines")))
    frequent = materialize(counts.where(F.col("lines") > FREQUENT).select("word"))
    if frequent.count() <= BROADCAST_WORDS:
        frequent = F.broadcast(frequent)
    crowded = materialize(postings.join(frequent, "word"))
    heads = (crowded.groupBy("word").agg(F.min(F.struct("o", "tie", "pos", "n", "i", "parity", "parity2")).alias("head"))
             .select("word", "head.*"))
    matched = materialize(_verified(materialize(_candidates(crowded, heads, num, den)), texts, num, den))
    rest = crowded.join(matched, ["o", "tie", "pos"], "left_anti")
    scarce = postings.join(frequent, "word", "left_anti")
    pairs = materialize(_scarce_pairs(scarce, num, den).union(_candidates(rest, crowded, num, den)).distinct())
    matched = materialize(matched.union(_verified(pairs, texts, num, den)).distinct())
    kept = (sets.select("o", "tie", "pos").join(matched, ["o", "tie", "pos"], "left_anti")
            .groupBy("o", "tie").agg(F.collect_list("pos").alias("kept_at")))
    stay = F.filter("parts", lambda line, i: F.array_contains(F.col("kept_at"), i) | ~line.rlike("[^\\x20\\x09-\\x0D]"))
    judged = (rows.select("doc", "o", "tie").join(kept.hint("shuffle_hash"), ["o", "tie"], "left")
              .withColumn("kept_at", F.coalesce("kept_at", F.array().cast("array<int>")))
              .withColumn("parts", F.split("doc.text", "\n"))
              .select("doc", F.size("parts").alias("n"), stay.alias("stay")))
    told = F.col("stay").isNotNull()
    return judged.select("doc", F.when(told, F.col("n")).otherwise(0).cast("bigint").alias("n_lines"),
                         F.when(told, F.col("n") - F.size("stay")).otherwise(0).cast("bigint").alias("n_removed"),
                         F.array_join("stay", "\n").alias("kept"))


def _candidates(later: DataFrame, earlier: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``x`` (of ``later``), ``y`` (of ``earlier``) of lines and the sum
    ``n`` of their words, ``y`` the earlier one, that share a prefix word and pass the length filter, the
    positional filter and the parity filter: the bits in which two parities
    differ are at most the words that only one of the sets has."""
    a, b = later.alias("a"), earlier.alias("b")
    nx, ny = F.col("a.n"), F.col("b.n")
    before = F.struct("b.o", "b.tie", "b.pos") < F.struct("a.o", "a.tie", "a.pos")
    return (a.join(b, (F.col("a.word") == F.col("b.word"))
                   & (nx * den >= ny * num) & (ny * den >= nx * num) & _may_be(nx, ny, num, den) & before)
            .select(F.struct("a.o", "a.tie", "a.pos").alias("x"), F.struct("b.o", "b.tie", "b.pos").alias("y"),
                    (nx + ny).alias("n"))
            .distinct())


def _may_be(nx: Column, ny: Column, num: int, den: int) -> Column:
    """Positional and parity filter: neither the words left from the shared one
    on nor those that can't be apart are fewer than the overlap needed,
    ``(nx + ny) * num / (num + den)``, compared in whole numbers."""
    n = nx + ny
    needed = n.cast("bigint") * num
    room = F.least(nx - F.col("a.i"), ny - F.col("b.i"))
    shared = F.shiftright(n - _apart(nx, ny), 1)
    return (room.cast("bigint") * (num + den) >= needed) & (shared.cast("bigint") * (num + den) >= needed)


def _apart(nx: Column, ny: Column) -> Column:
    """Bits in which the parities of sets ``a`` and ``b`` differ: of both halves
    of the words apart if both sets keep them, else of all words."""
    both, half = (F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}")) for c in ("parity", "parity2"))
    return F.when((nx > WIDE) & (ny > WIDE), F.bit_count(half) + F.bit_count(both.bitwiseXOR(half))).otherwise(F.bit_count(both))


def _band(n: Column, num: int, den: int) -> Column:
    """Sizes from 1 on in bands whose ends have the threshold's ratio."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(den / num) if num < den else 1.0)).cast("smallint")


def _scarce_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    """:func:`_candidates` of words in few lines with themselves, written once.

    Lines meet as the larger and the smaller one of a pair.  With the ``n``
    words of the larger one at least ``n * num / den`` are shared, so its prefix
    is what ``postings`` hold; of the smaller one's, at least
    ``2 * num / (num + den)`` are, which makes its prefix about half as long.  The
    length filter is part of the key: a smaller line is in the band of its size
    (its rows make the hash table, so they are no more than need be), a larger one
    looks into all bands of sizes that may be similar (two, or one).

    Both sides are one exchange by the word: bands and shorter prefixes are
    worked out behind it (an outer explode, which Catalyst does not turn into a
    filter below), and a join on (word, band) may use that partitioning.  No
    word is in more than FREQUENT lines, so a hash table's keys stay small.

    Of a word's hash 46 bits, ``w`` and ``v``, make one 64-bit join key with the
    band; words that share them only make candidates, which are verified."""
    n, word = F.col("n"), F.col("word")
    spread = postings.select(
        word.bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("w"),
        F.shiftright(word, 31).bitwiseAND(F.lit((1 << 15) - 1)).cast("smallint").alias("v"),
        *[c for c in postings.columns if c != "word"])
    # what the join asks to be no null is said for both sides, so that their exchanges are one
    spread = spread.where(" and ".join(f"{c} is not null" for c in spread.columns)).repartition("w")
    short = (n - F.col("i")).cast("bigint") * (num + den) >= n.cast("bigint") * (2 * num)
    own = F.when(short, F.array("band"))
    bands = F.sequence(_band(_ceil(n, num, den), num, den), F.col("band"))
    rest = [c for c in spread.columns if c != "band"]
    larger = spread.select(*rest, F.explode_outer(bands).alias("band"))
    smaller = spread.select(*rest, F.explode_outer(own).alias("band"))
    a, b = larger.alias("a"), smaller.hint("shuffle_hash").alias("b")
    nx, ny = F.col("a.n"), F.col("b.n")
    before = F.struct("b.o", "b.tie", "b.pos") < F.struct("a.o", "a.tie", "a.pos")
    met = a.join(b, (F.col("a.w") == F.col("b.w")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.band") == F.col("b.band"))
                 & (nx >= ny) & (ny * den >= nx * num) & _may_be(nx, ny, num, den) & ((nx > ny) | before))
    one, other = F.struct("a.o", "a.tie", "a.pos"), F.struct("b.o", "b.tie", "b.pos")
    found = met.select(F.when(before, one).otherwise(other).alias("x"), F.when(before, other).otherwise(one).alias("y"),
                       (nx + ny).alias("n"))
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark = postings.sparkSession
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return materialize(found.distinct())
    finally:
        spark.conf.set(key, was)


def _verified(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """The later lines of pairs whose words are similar enough."""
    ends = pairs.select(F.explode(F.array("x", "y")).alias("at")).distinct()
    wanted = materialize(ends.groupBy("at.o", "at.tie").agg(F.collect_list("at.pos").alias("wanted")))
    docs, places = wanted.agg(F.count(F.lit(1)), F.sum(F.size("wanted"))).first()
    small = docs <= BROADCAST_DOCS and 20 * docs + 4 * (places or 0) <= BROADCAST_BYTES
    wanted = F.broadcast(wanted) if small else wanted.hint("shuffle_hash")
    sets = (texts.join(wanted, ["o", "tie"])
            .select("o", "tie", F.split("text", "\n").alias("parts"), "wanted")
            .select("o", "tie", F.explode(F.transform("wanted", lambda p: F.struct(
                p.alias("pos"), F.element_at("parts", p + 1).alias("line")))).alias("of"))
            .select(F.struct("o", "tie", "of.pos").alias("at"), "of.line"))
    # lines travel as text, which is a third of their words as an array
    x = sets.select(F.col("at").alias("x"), F.col("line").alias("x_line"))
    y = sets.select(F.col("at").alias("y"), F.col("line").alias("y_line"))
    # both / (n - both) >= num / den, in a form that names the costly part once
    both = F.size(F.array_remove(F.array_intersect(_parts(F.col("x_line")), _parts(F.col("y_line"))), ""))
    return (pairs.join(x, "x").join(y, "y").where(both * (num + den) >= F.col("n") * num)
            .select("x.*").distinct())


def dedup_lines(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``docs`` without their repeated lines (:func:`removed_lines`, which says
    what happens to nulls, ties and repeated rows), in the same columns.

    Documents that lose every line with words go; ``n_chars`` follows where
    present.  Documents that lose nothing are unchanged, null and empty texts
    among them.  An empty table gives no rows.
    """
    out = removed_lines(docs, threshold)
    left = (F.col("n_removed") == 0) | F.col("kept").rlike("[^\\x20\\x09-\\x0D]")
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc").getField("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(kind)).otherwise(
            F.col("doc").getField("n_chars"))
    return out.where(left).select(*rebuild(docs.columns, **changed))
