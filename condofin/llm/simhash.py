"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Distinct fingerprints are laid out in cells by the population counts of their
four 16-bit quarters.  Two fingerprints within a radius differ in those counts
by no more than the radius in sum, so only tiles of such cells meet; inside a
pair of tiles numpy's exclusive-or and bit counts decide exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, map_texts, materialize
from .graph import components

#: Fingerprints in a tile at most; a larger cell is dealt over several tiles.
TILE = 4096
#: Rows of a tile compared at a time (rows x TILE words of 8 bytes are held).
STRIP = 128
SEED = 42  # fixed value: seed of the shingle hash
CHUNK = 1 << 14


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles'
    XXH64.  Shorter texts are one shingle; texts without words give 0."""
    import xxhash
    ws = text.lower().split() if text else []
    if not ws:
        return 0
    joined = b" ".join(ws)
    length = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    n = max(1, len(ws) - shingle + 1)
    span = min(shingle, len(ws)) - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        a = starts[at:min(n, at + CHUNK)].tolist()
        b = ends[at + span:min(n, at + CHUNK) + span].tolist()
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``doc`` (struct of the columns ``keep``, else of all) and ``fp`` (64 bits as a signed long)."""
    return map_texts(docs, lambda: lambda text: (_signed(fingerprint(text, shingle)),), "fp bigint", keep=keep)


def _quarters(fp) -> list:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(4)]


def neighbour_offsets(radius: int) -> list[tuple[int, int, int, int]]:
    """Differences of quarter counts that a link within ``radius`` can have,
    one of each opposite pair, without no difference at all."""
    every = itertools.product(range(-radius, radius + 1), repeat=4)
    return [d for d in every if 0 < sum(map(abs, d)) <= radius and d > (0, 0, 0, 0)]


def _linked(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius, each fingerprint of ``a`` with its first and
    last partner in a strip and chains between partners: as many links as tile
    members, which join the same groups as all pairs would."""
    left, right = [], []
    root = np.arange(len(b))  # partners that some row of a has already joined
    for at in range(0, len(a), STRIP):
        near = np.bitwise_count(a[at:at + STRIP, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(len(b))[None, :] > np.arange(at, min(len(a), at + STRIP))[:, None]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            partners = np.flatnonzero(near[i])
            _, first = np.unique(root[partners], return_index=True)
            heads = partners[first]
            left.append(np.full(len(heads), a[at + i], dtype=np.int64))
            right.append(b[heads].astype(np.int64))
            if len(heads) > 1:  # these partners' groups are one from here on
                root[np.isin(root, root[heads])] = root[heads[0]]
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for a, b, same in zip(*(batch.column(i) for i in range(3))):
                x = np.frombuffer(a.as_buffer(), dtype="<i8")
                y = np.frombuffer(b.as_buffer(), dtype="<i8")
                u, v = _linked(x, y, radius, same.as_py())
                if len(u):
                    left.append(u)
                    right.append(v)
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints ordered by cell to tiles of one cell."""
    cell, held = None, []

    def tile():
        return pa.RecordBatch.from_arrays(
            [pa.array([cell], pa.int32()), pa.array([len(held)], pa.int32()),
             pa.array([int(held[0])], pa.int64()),
             pa.array([np.array(held, dtype="<i8").tobytes()], pa.binary())],
            names=["cell", "n", "tile", "fps"])

    for batch in batches:
        for c, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (c != cell or len(held) >= TILE):
                yield tile()
                held = []
            cell = c
            held.append(fp)
    if held:
        yield tile()


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``a, b`` that join all fingerprints (column ``fp``, distinct)
    within ``radius`` bits of each other, directly or over a chain of others in
    their tiles; no pair beyond the radius is an edge.

    Tiles are cut from a range partitioning by cell, so a crowded cell spreads
    over tasks.  A tile is sent to the neighbouring cells once, whatever their
    number of tiles: what is shuffled grows with the fingerprints, not with
    the pairs.
    """
    spark = distinct.sparkSession
    bound_batches(spark)
    q = _quarters(F.col("fp"))
    base = 17 + 2 * radius  # room for neighbours outside 0..16
    weights = [base ** k for k in (3, 2, 1, 0)]
    cell = sum((c + radius) * w for c, w in zip(q, weights))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = materialize(
        distinct.select(cell.cast("int").alias("cell"), "fp")
        .repartitionByRange(n, "cell", "fp").sortWithinPartitions("cell", "fp")
        .mapInArrow(_pack, "cell int, n int, tile bigint, fps binary"))
    home = tiles.select("cell", F.col("tile").alias("home"), F.col("fps").alias("home_fps"))
    away = [sum(d * w for d, w in zip(o, weights)) for o in neighbour_offsets(radius)]
    visits = tiles.select(
        F.explode(F.array(*[F.struct((F.col("cell") + F.lit(d)).alias("cell"), F.lit(d == 0).alias("own"))
                            for d in [0, *away]])).alias("to"), "tile", "fps")
    pairs = (visits.select(F.col("to.cell").alias("cell"), "to.own", "tile", "fps").join(home, "cell")
             .where(~F.col("own") | (F.col("tile") <= F.col("home"))))
    return (pairs.select("fps", "home_fps", (F.col("own") & (F.col("tile") == F.col("home"))).alias("same"))
            .mapInArrow(_compare(radius), "a bigint, b bigint"))


def _grouped(docs: DataFrame, shingle: int, radius: int, keep: list[str] | None) -> DataFrame:
    """Rows of :func:`near_duplicates` with ``label``, the smallest fingerprint of their group."""
    prints = materialize(fingerprints(docs, shingle, keep))
    classes = materialize(prints.groupBy("fp").agg(F.min(F.col("doc").getField("doc_id")).alias("least")))
    found = components(links(classes.select("fp"), radius))
    label = F.coalesce("label", "fp")
    group = classes.join(found, classes["fp"] == found["node"], "left").select("fp", "least", label.alias("label"))
    # written, so that the join below is plain and a large group in it can be split
    least = materialize(group.groupBy("label").agg(F.min("least").alias("component_id")))
    component = materialize(group.join(least, "label").select("fp", "label", "component_id"))
    return prints.join(component, "fp").select("doc", "fp", "label", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2,
                    keep: list[str] | None = None) -> DataFrame:
    """``doc`` (struct of the columns ``keep``, which have ``doc_id``, else of all), ``fp`` and
    ``component_id``: the smallest ``doc_id`` reachable over links of at most
    ``radius`` differing bits.

    Null and empty texts have fingerprint 0 and link like any other; texts with
    fewer words than a shingle are one shingle; repeated rows and repeated ids
    share a fingerprint's class, a row each; null ids never are the smallest
    unless a whole group has none (then ``component_id`` is null); very long
    texts are hashed whole, in chunks; columns of any name stay apart in
    ``doc``; an empty table gives no rows.
    """
    return _grouped(docs, shingle, radius, keep).select("doc", "fp", "component_id")


def _row_hash(docs: DataFrame):
    """Of all columns as text; nulls count, so that a value in another column is another row."""
    return F.xxhash64(*[x for c in docs.columns for x in (F.col(c).isNull(), F.col(c).cast("string"))])


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one document of each group of fingerprints: the one with
    the smallest ``doc_id``, null ids last (of rows that share it, the least by
    a hash of all columns).  Groups are told apart by their fingerprints, so
    those without any id, or with an id that another group has too, keep one
    document each."""
    ids = docs.select("doc_id", _row_hash(docs).alias("row"), "text")
    found = _grouped(ids, shingle, radius, ["doc_id", "row"]).select("doc.*", "label")
    first = (found.groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("keep"))
             .select(F.col("keep.doc_id").alias("kept_id"), F.col("keep.row").alias("kept_row")))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("kept_id"),
                       _row_hash(docs).alias("kept_row"))
    kept = rows.join(first, rows["kept_id"].eqNullSafe(first["kept_id"])
                     & (rows["kept_row"] == first["kept_row"]), "left_semi")
    if not found.groupBy("doc_id", "row").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["kept_id", "kept_row"])
    return kept.select("doc.*")
