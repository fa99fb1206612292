"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items become one automaton; the words of every document
stream through it while the longest matching length is tracked.  Where that
length reaches a window, the window's words are hit.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_texts, materialize, rebuild, word_column, words

#: Item words in one automaton.  More items go to further automata, one pass of
#: the documents each; so what a task holds is bounded whatever the item count.
BLOCK_WORDS = 200_000
#: Longer items are cut into pieces that overlap by a window less one word.
PIECE_WORDS = 1_000

MATCHES = ("n_words bigint, n_hit bigint, longest bigint, items array<string>, "
           "spans array<struct<start: int, end: int>>")


@dataclass
class SuffixAutomaton:
    """Generalised suffix automaton over word numbers (1 and up)."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])

    def add(self, item: list[int]) -> None:
        last = 0
        for c in item:
            last = self._extend(last, c)

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, c: int) -> int:
        """The state that ends the longest string of ``p`` plus ``c`` exactly."""
        q = self.step[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int) -> int:
        if c in self.step[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        self.link[new] = self._split(p, c) if p >= 0 else 0
        return new

    def holder(self, state: int, length: int) -> int:
        """The state of the suffix of ``length`` words of ``state``'s strings."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


class Matcher:
    """Windows of one block of items, ready to stream documents."""

    GRAM = 4

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int):
        self.window, self.names = window, sorted({n for n, _ in items if n is not None})
        number = {n: i for i, n in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        coded = [(number.get(n, -1), [self.vocabulary.setdefault(w.encode(), len(self.vocabulary) + 1)
                                      for w in ws]) for n, ws in items if ws]
        self.sam = sam = SuffixAutomaton()
        for _, item in coded:
            sam.add(item)
        self.full: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for who, item in coded:
            state = 0
            for i, c in enumerate(item):
                state = sam.step[state][c]
                if i + 1 >= window:
                    self.full.setdefault(sam.holder(state, window), set()).add(who)
            if len(item) < window:
                self.short.setdefault(state, []).append((len(item), who))
        least = min([window, *(len(item) for _, item in coded)])
        self.gram = min(self.GRAM, least)
        self.run = least - self.gram + 1
        bits = max(16, int(np.ceil(np.log2(16 * (1 + sum(len(item) for _, item in coded))))))
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, dtype=bool)
        for _, item in coded:
            self.known[self._codes(np.array(item, dtype=np.uint64))] = True

    def _codes(self, ids: np.ndarray) -> np.ndarray:
        n = len(ids) - self.gram + 1
        total = np.zeros(n, dtype=np.uint64)
        for k in range(self.gram):
            total = (total ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return ((total * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift).astype(np.int64)

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of the document outside of which no window can lie: there,
        fewer words in a row than the shortest window have item n-grams."""
        if len(ids) < self.gram:
            return []
        there = np.concatenate(([False], self.known[self._codes(ids)], [False]))
        edges = np.flatnonzero(there[1:] != there[:-1]).reshape(-1, 2)
        return [(a, b + self.gram - 1) for a, b in edges[edges[:, 1] - edges[:, 0] >= self.run].tolist()]

    def match(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Merged word spans that are hit, items (numbers) met, longest match."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in ws), dtype=np.uint64, count=len(ws))
        spans: list[tuple[int, int]] = []
        met: set[int] = set()
        longest = 0
        step, link, length, window = self.sam.step, self.sam.link, self.sam.length, self.window

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        for a, b in self.stretches(ids):
            state = matched = 0
            for i, c in enumerate(ids[a:b].tolist(), start=a + 1):
                while state and c not in step[state]:
                    state = link[state]
                    matched = length[state]
                if c not in step[state]:
                    matched = 0
                    continue
                state = step[state][c]
                matched += 1
                if matched >= window:
                    met |= self.full.get(self.sam.holder(state, window), set())
                    hit(i - window, i)
                    longest = max(longest, matched)
                if self.short:
                    up = state
                    while up > 0:
                        for n, who in self.short.get(up, ()):
                            if n <= matched:
                                met.add(who)
                                hit(i - n, i)
                                longest = max(longest, n)
                        up = link[up]
        return spans, met, longest


def _blocks(benchmark: DataFrame, window: int) -> list[list[tuple[str | None, list[str]]]]:
    """Items as (id, words) in blocks of at most :data:`BLOCK_WORDS` words.

    Only one block's words are on the driver at a time (generator); repeated
    rows count once.
    """
    step = PIECE_WORDS - window + 1
    if step < 1:
        raise ValueError(f"window must be at most {PIECE_WORDS} words")
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"),
                              word_column(F.col("text")).alias("words"))
             .where(F.size("words") > 0))
    last = F.greatest(F.size("words") - F.lit(window), F.lit(0))
    pieces = materialize(
        items.select("item", "words", F.explode(F.sequence(F.lit(0), last, F.lit(step))).alias("at"))
        .select("item", F.slice("words", F.col("at") + 1, F.lit(PIECE_WORDS)).alias("words"))
        .distinct())
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // BLOCK_WORDS)
    while n > 1:
        block = F.pmod(F.xxhash64("item", "words"), F.lit(n))
        if pieces.groupBy(block).agg(F.sum(F.size("words")).alias("n")).agg(F.max("n")).first()[0] <= BLOCK_WORDS:
            break
        n += max(1, n // 2)
    for k in range(n):
        rows = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k).collect()
        yield [(r["item"], list(r["words"])) for r in sorted(rows, key=lambda r: (r["item"] or "", r["words"]))]


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13,
                    keep: list[str] | None = None) -> DataFrame:
    """Per document: ``doc`` (struct of the columns ``keep``, else of all) and :data:`MATCHES`.

    A window is ``window`` consecutive item words; an item of fewer, but not
    none, is one window.  ``spans`` are the merged word ranges that any window
    covers, ``items`` the distinct ids of items with a window in the document,
    as strings in code-point order, ``longest`` the longest match.

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; repeated benchmark rows count once, an item whose id is null hits
    words but is not listed; repeated documents are judged alike, a row each;
    very long texts are matched whole; columns of any name stay apart in
    ``doc``; an empty table gives no rows.
    """
    spark = docs.sparkSession
    found, blocks = None, _blocks(benchmark, window)
    items = next(blocks, None)
    while items is not None:
        make, items = _make(spark.sparkContext.broadcast(pickle.dumps(Matcher(items, window)))), next(blocks, None)
        if found is None:
            # texts come back from the workers only if another block needs them
            found = map_texts(docs, make, MATCHES, keep=keep if items is None else None)
            whole = keep is None or items is not None
        else:
            so_far = materialize(found).withColumn("text", F.col("doc.text"))
            found = map_texts(so_far, make, MATCHES, keep=["doc", *_OWN]).select(
                F.col("doc.doc").alias("doc"), *_merged())
    if found is None:
        found, whole = map_texts(docs, lambda: lambda text: (len(words(text)), 0, 0, [], []), MATCHES, keep=keep), keep is None
    if keep and whole:
        found = found.withColumn("doc", F.struct(*[F.col("doc").getField(c).alias(c) for c in keep]))
    return found


_OWN = ["n_words", "n_hit", "longest", "items", "spans"]


def _make(shared) -> Callable[[], Callable[[bytes | None], tuple]]:
    def make():
        matcher = pickle.loads(shared.value)

        def of_text(text):
            ws = words(text)
            spans, met, longest = matcher.match(ws)
            return (len(ws), sum(b - a for a, b in spans), longest,
                    sorted(matcher.names[i] for i in met if i >= 0),
                    [{"start": a, "end": b} for a, b in spans])
        return of_text
    return make


def _merged() -> list:
    """Own columns of two blocks as one: spans united, items united."""
    old = {c: F.col("doc").getField(c) for c in _OWN}
    both = F.array_sort(F.concat(old["spans"], F.col("spans")))
    united = F.aggregate(
        both, F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1),
                     F.array(F.struct(F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
                                      F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))
    hit = F.aggregate(united, F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]))
    return [F.col("n_words"), hit.alias("n_hit"), F.greatest(old["longest"], F.col("longest")).alias("longest"),
            F.array_sort(F.array_union(old["items"], F.col("items"))).alias("items"), united.alias("spans")]


def contaminated(coverage_divisor: int = 20):
    """Hit words make up at least one in ``coverage_divisor`` of all words."""
    return (F.col("n_hit") > 0) & (coverage_divisor * F.col("n_hit") >= F.col("n_words"))


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words in ``spans``; a space stands for each span."""
    places = [m.span() for m in re.finditer(WORD.encode(), text.translate(_LOWER))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b" ".join([*out, text[at:]]).decode("utf-8", "replace")


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13,
                  coverage_divisor: int = 20) -> DataFrame:
    """Documents without benchmark passages, in the columns of ``docs``.

    Documents whose hit words reach the coverage limit go; from the others the
    hit spans are cut out of ``text`` and ``n_chars`` follows where present.
    Documents without hits are unchanged, null and empty texts among them;
    repeated rows are judged alike and stay or go together; an empty table
    gives no rows, an empty benchmark changes nothing (:func:`match_benchmark`).
    """
    cols = docs.columns
    matched = match_benchmark(docs, benchmark, window).where(~contaminated(coverage_divisor))
    own = matched.select("doc", "spans", F.col("doc").getField("text").alias("text"))
    cut = _cut(own)
    changed = {"text": F.col("cut")}
    if "n_chars" in cols:
        n = F.col("doc").getField("n_chars")
        changed["n_chars"] = F.when(F.size("spans") > 0,
                                    F.length("cut").cast(docs.schema["n_chars"].dataType)).otherwise(n)
    return cut.select(*rebuild(cols, **changed))


def _cut(df: DataFrame) -> DataFrame:
    """Adds ``cut``: the text without its spans."""
    from pyspark.sql import types as T
    schema = T.StructType([df.schema["doc"], df.schema["spans"], T.StructField("cut", T.StringType())])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = batch.column(2).to_pylist()
            spans = batch.column(1).to_pylist()
            cut = [remove_spans(t.encode(), [(s["start"], s["end"]) for s in ss]) if ss else t
                   for t, ss in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cut, type=pa.string())],
                names=["doc", "spans", "cut"])

    return df.mapInArrow(run, schema)
