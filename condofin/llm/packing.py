"""Packing documents into training sequences by Karmarkar-Karp differencing.

A document's token ids are cut before anything is packed: whole windows, each a
sequence of its own, and what remains in pieces of at most :data:`PIECE` ids.
So checksums and ids come from the one pass that tokenizes, and packing moves
only pieces.  Pieces are dealt to blocks by a hash of their number; in a block
the largest differencing method makes windows of near-equal size, and the
number of windows rises until none is above its capacity.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, materialize

#: Ids of a sequence, and of a piece of a document's remainder at most.
WINDOW = 1024
PIECE = 256
#: Pieces of a block, about: what one task packs at a time.
BLOCK = 4096
#: The id that ends every document.
END = 0
#: Texts are tokenized in parts of about so many characters.
PART = 1 << 16

# Fixed value: the vocabulary's pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=\S)(?=[ \t-\r])")
# the pattern's look-ahead goes back over a run of blanks step by step
_LONG_BLANK = re.compile(r"\s{1000}")


class Encoder:
    """Ids of texts under a byte-level vocabulary file of ``tokenizers``.

    They are those of ``Tokenizer.encode(text, add_special_tokens=False)`` with
    the special token's string taken as ordinary text.  ``tiktoken``, given the
    file's own tokens as ranks, finds the same ids about four times faster; the
    file's tokenizer itself is asked for parts with very long runs of blanks,
    which the other does not take.
    """

    def __init__(self, vocabulary: bytes):
        import tiktoken
        self._json = vocabulary
        self._exact = None
        byte_of = {c: b for b, c in _byte_letters().items()}
        model = json.loads(vocabulary)
        special = {t["content"] for t in model.get("added_tokens", ())}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["model"]["vocab"].items()
                 if token not in special}
        self._fast = tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        for part in parts(text):
            out += self._slow(part) if _LONG_BLANK.search(part) else self._fast.encode_ordinary(part)
        return out

    def _slow(self, part: str) -> list[int]:
        if self._exact is None:
            from tokenizers import Tokenizer
            self._exact = Tokenizer.from_str(self._json.decode())
            self._exact.encode_special_tokens = True
        return self._exact.encode(part, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes) -> Encoder:
    return Encoder(vocabulary)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes for themselves, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` cut into parts of about ``size`` characters, only before blanks
    that follow other characters: no pre-token reaches over such a place."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def cuts(n: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: whole windows, then what
    remains in pieces of at most ``piece``."""
    whole = n - n % window
    return ([(at, window) for at in range(0, whole, window)]
            + [(at, min(piece, n - at)) for at in range(whole, n, piece)])


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """At most ``k`` groups of the indices of ``sizes``, with near-equal sums.

    Every size starts as a partial partition with itself in one of ``k`` places.
    The two partitions with the largest imbalance (largest less smallest place)
    merge, the larger places of one on the smaller of the other, until one is
    left.  A partition holds only its places in use, ascending, less what all
    ``k`` have in common; so most merges insert one place.
    """
    if not sizes:
        return []
    partial = {i: [(size, i)] for i, size in enumerate(sizes)}
    queue = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(queue)
    joined: list[tuple[int, int]] = []  # place len(sizes) + j holds these two

    while len(queue) > 1:
        first, second = heapq.heappop(queue)[1], heapq.heappop(queue)[1]
        big, small = partial.pop(first), partial.pop(second)
        if len(big) < len(small):
            big, small = small, big
        free = k - len(big)
        large = small[::-1]
        alone, on_top = large[:free], large[free:]
        if not on_top and len(alone) == 1:
            insort(big, alone[0])
            merged = big
        else:
            merged = big[len(on_top):] + alone
            for (x, p), (y, q) in zip(big, on_top):
                merged.append((x + y, len(sizes) + len(joined)))
                joined.append((p, q))
            merged.sort()
        if len(merged) == k and merged[0][0]:
            least = merged[0][0]
            merged = [(x - least, p) for x, p in merged]
        partial[first] = merged
        heapq.heappush(queue, ((merged[0][0] if len(merged) == k else 0) - merged[-1][0], first))

    groups = []
    for _, place in partial[queue[0][1]]:
        group, stack = [], [place]
        while stack:
            p = stack.pop()
            if p < len(sizes):
                group.append(p)
            else:
                stack += joined[p - len(sizes)]
        groups.append(sorted(group))
    return groups


def windows(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Groups of the indices of ``sizes`` (each at most ``window``) with sums of
    at most ``window``: as few as their total needs, and more by what overflows
    for as long as a group is above."""
    k = -(-sum(sizes) // window)
    while True:
        groups = differencing(sizes, k)
        over = sum(max(0, sum(sizes[i] for i in g) - window) for g in groups)
        if not over:
            return groups
        k += -(-over // window)


def padding(length: int, window: int = WINDOW) -> int:
    """Ids that a sequence of ``length`` lacks: none at a power of two."""
    return 0 if length & (length - 1) == 0 else window - length


def _pack_block(key, table):
    block = key[0].as_py()
    order = np.argsort(table.column("piece").to_numpy(), kind="stable")
    lengths = table.column("length").to_numpy()[order]
    sequence, offset = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    for w, group in enumerate(windows(lengths.tolist())):
        sequence[order[group]] = 2 * ((block << 20) + w)
        offset[order[group]] = np.cumsum(lengths[group]) - lengths[group]
    return (table.drop_columns(["block", "piece"])
            .append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)))


def pack(docs: DataFrame, vocabulary: str, ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """A row per piece: ``doc`` (struct of the columns ``keep``, else of all but
    ``text``), ``start``, ``length``, ``ids_crc32`` (of its ids as little-endian
    32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset``; with
    ``ids`` also the ids.

    A document is the ids of its ``text`` by the file ``vocabulary`` (on the
    driver; its bytes go to the executors), then :data:`END`; null and empty
    texts are that id alone.  Texts are tokenized whole, very long ones part by
    part.  Repeated rows are documents of their own; ids of documents may be
    null or repeat; an empty table gives no rows; columns that share a name
    with an own one stay apart in ``doc``.  Each block of about
    :data:`BLOCK` pieces leaves less than one window empty where differencing
    finds equal sums, so padding falls with the input up to there.
    """
    try:
        with open(vocabulary, "rb") as f:
            shared = docs.sparkSession.sparkContext.broadcast(f.read())
    except FileNotFoundError as missing:
        raise FileNotFoundError(f"parameter vocabulary: no file {vocabulary} on the driver") from missing
    columns = keep if keep is not None else [c for c in docs.columns if c != "text"]
    own = "start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")

    def make():
        of = encoder(shared.value)

        def of_text(data):
            found = of.ids(data.decode("utf-8", "replace")) if data else []
            found.append(END)
            every = np.array(found, dtype="<u4")
            pieces = []
            for at, length in cuts(len(every)):
                cut = every[at:at + length]
                piece = {"start": at, "length": length, "ids_crc32": zlib.crc32(cut.tobytes())}
                pieces.append(piece | {"ids": cut.tolist()} if ids else piece)
            return len(every), pieces
        return of_text

    # an empty struct can't travel: then the place of the text is held by a constant
    packed = map_texts(docs, make, f"doc_tokens bigint, pieces array<struct<{own}>>", keep=columns or ["text"])
    if not columns:
        packed = packed.withColumn("doc", F.struct(F.lit(None).cast("int").alias("none")))
    pieces = materialize(packed.select("doc", "doc_tokens", F.explode("pieces").alias("p"))
                         .select("doc", "p.*", "doc_tokens", F.monotonically_increasing_id().alias("piece")))
    whole, short = (pieces.where(F.col("length") == WINDOW), pieces.where(F.col("length") < WINDOW))
    blocks = -(-short.count() // BLOCK) or 1
    dealt = short.withColumn("block", F.pmod(F.xxhash64("piece"), F.lit(blocks).cast("bigint")))
    fields = [f for f in pieces.schema.fields if f.name != "piece"]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    full = whole.withColumns({"sequence_id": 2 * F.col("piece") + 1, "offset": F.lit(0).cast("bigint")})
    return dealt.groupBy("block").applyInArrow(_pack_block, schema).unionByName(full.drop("piece"))
