"""Substring dedup: repeated windows of words, found by Rabin-Karp hashes.

Every window of every document is hashed; equal hashes of all documents meet
in one bucket, which names the windows that a document with a smaller id also
has; repeated windows merge into maximal intervals of removed words.  Spark
deals hashes to buckets; inside a bucket a sorted array, not a row each, finds
the smallest id of every hash, as a packed message is a few bytes a window
and a row many.

Documents are dealt to groups.  A group sends each hash to its bucket once,
with the smallest id that has it, so a passage in very many documents arrives
as often as there are groups; and a bucket answers a group with one bit per
hash, in the order the group sent them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, plain_words, text_bytes

WINDOW = 50
#: Text bytes of a group of documents and windows of a bucket, on average: what
#: one task holds.  A larger cluster with larger workers may raise both, which
#: makes fewer and longer messages between groups and buckets.
GROUP_BYTES = 8 << 20
BUCKET_WINDOWS = 1 << 20
LEAST_BUCKETS = 64
#: Rows of one id and text that are handled one by one; of more, one stands for all.
COPIES = 256
WORD_BYTES = 6  # of an average word with its blank, for the number of buckets
CHUNK = 1 << 16
CACHED_WORDS = 300_000

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that they have inverses


class _Values(dict):
    """64-bit value of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


class RollingHash:
    """Two independent 64-bit Rabin-Karp hashes of every window of words.

    Sums of word values times inverse powers of the base are running sums, so a
    window is a difference of two of them, scaled back by a power."""

    def __init__(self, window: int):
        self.window = window
        self.values = _Values()
        n = CHUNK + window
        self.powers = []
        for base in _BASES:
            both = []
            for factor in (base, pow(base, -1, 1 << 64)):
                powers = np.full(n + 1, factor, dtype=np.uint64)
                powers[0] = 1
                both.append(np.cumprod(powers))
            self.powers.append(both)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        w = self.window
        n = len(words) - w + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        out = (np.empty(n, np.uint64), np.empty(n, np.uint64))
        get = self.values.__getitem__
        for at in range(0, n, CHUNK):
            m = min(CHUNK, n - at)
            v = np.fromiter(map(get, words[at:at + m + w - 1]), dtype=np.uint64, count=m + w - 1)
            for k, (up, down) in enumerate(self.powers):
                sums = np.zeros(len(v) + 1, dtype=np.uint64)
                np.cumsum((v if k == 0 else _mix(v)) * down[:len(v)], out=sums[1:])
                out[k][at:at + m] = _mix((sums[w:] - sums[:-w]) * up[w - 1:w - 1 + m])
        return out


class _Group:
    """Windows of the documents of one group, in the order of (id, text)."""

    def __init__(self, docs: pa.ChunkedArray, window: int, buckets: int):
        column = docs.combine_chunks() if isinstance(docs, pa.ChunkedArray) else docs
        self.rows = column
        self.ids = column.field("doc_id").to_pylist()
        self.texts = column.field("text").cast(pa.large_binary())
        self.order = sorted(range(len(self.ids)), key=lambda i: (
            self.ids[i] is None, self.ids[i] or 0, self.texts[i].as_py() or b""))
        rolling = RollingHash(window)
        self.n_words, h1, h2, ids, self.windows = {}, [], [], [], []
        for i in self.order:
            ws = plain_words(self.texts[i].as_py())
            self.n_words[i] = len(ws)
            if self.ids[i] is None or len(ws) < window:
                continue
            a, b = rolling.of(ws)
            h1.append(a)
            h2.append(b)
            ids.append(np.full(len(a), self.ids[i], dtype=np.int64))
            self.windows.append((i, len(a)))
        none = np.empty(0, np.uint64)
        self.h1, self.h2 = np.concatenate([none, *h1]), np.concatenate([none, *h2])
        self.doc_ids = np.concatenate([np.empty(0, np.int64), *ids])
        # the first of equal windows is sent for all of them
        _, first, same = np.unique(self.h1, return_index=True, return_inverse=True)
        self.first = first[same] if len(first) else first
        odd = self.h2 != self.h2[self.first]
        self.first[odd] = np.flatnonzero(odd)
        self.sent = np.flatnonzero(self.first == np.arange(len(self.first)))
        bucket = (((self.h2[self.sent] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
        by_bucket = np.argsort(bucket, kind="stable")
        self.sent, bucket = self.sent[by_bucket], bucket[by_bucket]
        numbers, starts = np.unique(bucket, return_index=True)
        self.parts = {int(b): (s, e) for b, s, e in zip(numbers, starts, [*starts[1:], len(bucket)])}


def _encode(ids: np.ndarray) -> bytes:
    """Ascending ids as the first and the steps, in as few bytes as they need."""
    steps = np.diff(ids, prepend=ids[:1])
    kind = "<u2" if steps.max(initial=0) < 1 << 16 else "<i8"
    return np.int64(ids[0]).tobytes() + kind.encode() + steps.astype(kind).tobytes()


def _decode(data: bytes) -> np.ndarray:
    first, kind = np.frombuffer(data[:8], "<i8")[0], data[8:11].decode()
    return first + np.cumsum(np.frombuffer(data, kind, offset=11).astype(np.int64))


def _messages(window: int, buckets: int):
    def of_group(key, table):
        group = _Group(table.column("doc"), window, buckets)
        at, hashes, ids = [], [], []
        for b, (s, e) in group.parts.items():
            sent = group.sent[s:e]
            at.append(b)
            hashes.append(group.h1[sent].tobytes())
            ids.append(_encode(group.doc_ids[sent]))
        return pa.table({"bucket": pa.array(at, pa.int32()), "g": pa.array([key[0].as_py()] * len(at), pa.int64()),
                         "hashes": pa.array(hashes, pa.binary()), "ids": pa.array(ids, pa.binary())})
    return of_group


def _answers(key, table):
    """One bit per hash and group: a smaller id has the hash."""
    hashes = [np.frombuffer(x, "<u8") for x in table.column("hashes").to_pylist()]
    ids = np.concatenate([_decode(x) for x in table.column("ids").to_pylist()])
    h = np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    least = np.empty(len(h), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], starts), np.diff([*starts, len(h)]))
    repeated = ids > least
    g, bits, at = [], [], 0
    for who, own in zip(table.column("g").to_pylist(), hashes):
        part = repeated[at:at + len(own)]
        at += len(own)
        if part.any():
            g.append(who)
            bits.append(np.packbits(part).tobytes())
    return pa.table({"g": pa.array(g, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(g), pa.int32()),
                     "bits": pa.array(bits, pa.binary())})


def _apply(window: int, buckets: int):
    def of_group(docs, marks):
        group = _Group(docs.column("doc"), window, buckets)
        told = np.zeros(len(group.h1), dtype=bool)
        for b, bits in zip(marks.column("bucket").to_pylist(), marks.column("bits").to_pylist()):
            s, e = group.parts[b]
            told[group.sent[s:e]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=e - s).astype(bool)
        repeated = told[group.first] | (group.doc_ids > group.doc_ids[group.first]) if len(told) else told
        out: dict[int, tuple[int, str]] = {}
        at = 0
        for i, n in group.windows:
            part = repeated[at:at + n]
            at += n
            if part.any():
                edge = np.zeros(n + window, dtype=np.int32)
                np.add.at(edge, np.flatnonzero(part), 1)
                np.subtract.at(edge, np.flatnonzero(part) + window, 1)
                gone = np.cumsum(edge)[:n + window - 1] > 0
                ws = plain_words(group.texts[i].as_py())
                out[i] = int(gone.sum()), b" ".join(w for w, x in zip(ws, gone.tolist()) if not x).decode("utf-8", "replace")
        rows = range(len(group.ids))
        kept = [out[i][1] if i in out else b" ".join(plain_words(group.texts[i].as_py())).decode("utf-8", "replace")
                for i in rows]
        return pa.table({"doc": group.rows, "n_words": pa.array([group.n_words[i] for i in rows], pa.int64()),
                         "n_removed": pa.array([out.get(i, (0,))[0] for i in rows], pa.int64()),
                         "kept": pa.array(kept, pa.string())})
    return of_group


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc`` (struct of the columns of ``docs``), ``n_words``, ``n_removed``
    and ``kept`` (the words left, joined by one space), a row per document.

    A word is removed if a window of ``window`` consecutive words of its
    document covers it whose words also stand in a document with a smaller
    ``doc_id``; all windows are judged on the input.  Null and empty texts have
    no words; an id that is null is smaller than none and none is smaller than
    it, so its document keeps all; rows that share an id don't remove from each
    other; very long texts are hashed in chunks; columns of any name stay apart
    in ``doc``; an empty table gives no rows.

    Where more than :data:`COPIES` rows share id and text, one of them is looked
    at and the others take its result by a join, so that no group holds them.

    Windows are equal when a 64-bit hash and the bucket of a second one are:
    with as many buckets as there are spans of :data:`BUCKET_WINDOWS` windows,
    the expected number of false matches among N windows is N / 2**45.
    """
    own = {"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit("second"), "doc_id", "text")}
    rows = docs.select(F.struct("*").alias("doc"), *[c.alias(n) for n, c in own.items()])
    many = materialize(docs.groupBy(*[c.alias(n) for n, c in own.items()]).agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > COPIES).select(*own))
    if many.isEmpty():
        return _remove(rows.select("doc"), text_bytes(docs), window)
    one = rows.join(many, [*own], "left_semi").groupBy(*own).agg(F.first("doc").alias("doc")).select("doc")
    found = materialize(_remove(rows.join(many, [*own], "left_anti").select("doc").unionByName(one), text_bytes(docs), window))
    key = {"k1": F.xxhash64("doc.doc_id", "doc.text"), "k2": F.xxhash64(F.lit("second"), "doc.doc_id", "doc.text")}
    found = found.withColumns(key)
    results = [c for c in found.columns if c not in ("doc", *own)]
    copies = rows.join(many, [*own], "left_semi").join(found.select(*own, *results), [*own])
    return found.join(many, [*own], "left_anti").select("doc", *results).unionByName(copies.select("doc", *results))


def _remove(docs: DataFrame, total: int, window: int) -> DataFrame:
    """:func:`remove_repeats` of rows ``doc`` with ``total`` bytes of text, no
    id and text of which is in very many rows."""
    groups = max(1, -(-total // GROUP_BYTES))
    buckets = max(LEAST_BUCKETS, -(-total // (WORD_BYTES * BUCKET_WINDOWS)))
    spread = docs.select(F.pmod(F.xxhash64("doc.doc_id", "doc.text"), F.lit(groups)).cast("bigint").alias("g"),
                         "doc").repartition("g")
    marks = (spread.groupBy("g").applyInArrow(_messages(window, buckets),
                                              "bucket int, g bigint, hashes binary, ids binary")
             .groupBy("bucket").applyInArrow(_answers, "g bigint, bucket int, bits binary"))
    schema = T.StructType([spread.schema["doc"], *T._parse_datatype_string(
        "n_words bigint, n_removed bigint, kept string").fields])
    return spread.groupBy("g").cogroup(marks.groupBy("g")).applyInArrow(_apply(window, buckets), schema)
