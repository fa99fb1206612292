"""Embedding near-duplicates: spherical k-means cells and blocked cosines.

Vectors are assigned to cells by spherical k-means and compared in blocks
inside their cells.  A vector near the border of its cell also visits every
cell beyond the border that a linked vector could lie in, so no link is lost;
one representative per group is kept.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize
from .graph import components

THRESHOLD = 0.9
#: Vectors that k-means is fitted on at most, as bytes (about), and its rounds.
FIT_BYTES = 16 << 20
ROUNDS = 8
#: Distinct vectors to a cell on average; vectors in a tile at most.
CELL = 4096
TILE = 1024
#: Centroids that a batch or tile is held against at a time.
CELLS = 4096


def unit(vector) -> np.ndarray | None:
    """Unit vector in double precision; None for vectors that link with nothing:
    null, empty, zero, or with null or non-finite components."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.array(vector, dtype=np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return v / np.linalg.norm(v)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, a digest of the components, dimensions and unit vector."""
    for batch in batches:
        keys, dims, units = [], [], []
        for x in batch.column(1).to_pylist():
            v = unit(x)
            keys.append(None if v is None else hashlib.blake2b(
                np.array(x, dtype="<f8").tobytes(), digest_size=16).digest())
            dims.append(None if v is None else len(v))
            units.append(None if v is None else v.astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
            names=["vec_id", "key", "dims", "unit"])


def spherical_kmeans(units: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids; the first ones are spread over the given order."""
    centre = units[np.linspace(0, len(units) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        at = np.concatenate([(part @ centre.T).argmax(1) for part in np.array_split(units, -(-len(units) // 4096))])
        sums = np.zeros_like(centre)
        np.add.at(sums, at, units)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centre)
    return centre


def fit_cells(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids by number of dimensions, from a bounded sample by key hash."""
    model = {}
    for dims, n in classes.groupBy("dims").count().collect():
        k = max(1, -(-n // CELL))
        sample = min(n, max(1, FIT_BYTES // (8 * dims)))
        own = classes.where((F.col("dims") == dims) & (
            F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / n)))))
        rows = own.select("key", "unit").collect()
        units = np.array([np.frombuffer(r["unit"], "<f8") for r in sorted(rows, key=lambda r: bytes(r["key"]))])
        model[dims] = spherical_kmeans(units, min(k, len(units))) if len(units) else np.zeros((0, dims))
    return model


def _nearest(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each vector, in blocks of both."""
    best, at = np.full(len(units), -np.inf), np.zeros(len(units), dtype=np.int32)
    for start in range(0, len(centre), CELLS):
        near = units @ centre[start:start + CELLS].T
        own = near.argmax(1)
        value = near[np.arange(len(units)), own]
        better = value > best
        best[better], at[better] = value[better], own[better] + start
    return at


def _assign(shared):
    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            every, data = batch.column(2).to_numpy(), batch.column(3).to_pylist()
            cells = np.zeros(len(every), dtype=np.int32)
            for dims in np.unique(every).tolist():
                rows = np.flatnonzero(every == dims)
                if len(model[dims]):
                    units = np.frombuffer(b"".join(data[i] for i in rows), "<f8").reshape(-1, dims)
                    cells[rows] = _nearest(units, model[dims])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int32()), *(batch.column(i) for i in range(batch.num_columns))],
                names=["cell", *batch.schema.names])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors ordered by dimensions and cell to tiles of one cell."""
    where, keys, times, units = None, [], [], []

    def tile():
        return pa.RecordBatch.from_arrays(
            [pa.array([where[0]], pa.int32()), pa.array([where[1]], pa.int32()), pa.array([keys[0]], pa.binary()),
             pa.array([b"".join(keys)], pa.binary()), pa.array([np.array(times, "<i8").tobytes()], pa.binary()),
             pa.array([b"".join(units)], pa.binary())],
            names=["dims", "cell", "tile", "keys", "times", "units"])

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("dims", "cell", "key", "times", "unit"))):
            if keys and (row[:2] != where or len(keys) >= TILE):
                yield tile()
                keys, times, units = [], [], []
            where = row[:2]
            keys.append(row[2])
            times.append(row[3])
            units.append(row[4])
    if keys:
        yield tile()


def _visits(shared, threshold: float):
    """What each tile sends to cells with higher numbers: the vectors that may
    have a partner there.  A partner lies beyond the plane between the two
    centroids, so a vector farther from that plane than the angle has none."""
    reach = math.sqrt(1 - threshold * threshold) if threshold > 0 else math.inf

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            for dims, cell, keys, times, units in zip(*(batch.column(n).to_pylist()
                                                        for n in ("dims", "cell", "keys", "times", "units"))):
                centre = model[dims]
                x = np.frombuffer(units, "<f8").reshape(-1, dims)
                out = defaultdict(list)
                for start in range(cell + 1, len(centre), CELLS):
                    others = centre[start:start + CELLS]
                    apart = np.linalg.norm(others - centre[cell], axis=1)
                    goes = (x @ centre[cell])[:, None] - x @ others.T <= reach * apart + 1e-9
                    for to in np.flatnonzero(goes.any(0)).tolist():
                        go = np.flatnonzero(goes[:, to])
                        out["cell"].append(start + to)
                        out["keys"].append(np.frombuffer(keys, "V16")[go].tobytes())
                        out["times"].append(np.frombuffer(times, "<i8")[go].tobytes())
                        out["units"].append(x[go].tobytes())
                if out:
                    n = len(out["cell"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dims] * n, pa.int32()), pa.array(out["cell"], pa.int32()),
                         pa.array([None] * n, pa.binary()), *(pa.array(out[c], pa.binary())
                                                             for c in ("keys", "times", "units"))],
                        names=["dims", "cell", "tile", "keys", "times", "units"])
    return run


def _compare(threshold: float):
    """Link counts of both sides of each pair of tiles, and edges that join the
    linked vectors: a vector is joined to one partner of every group of
    partners that is not yet one."""
    def run(batches):
        for batch in batches:
            for dims, same, *rest in zip(*(batch.column(n).to_pylist() for n in (
                    "dims", "same", "keys", "times", "units", "home_keys", "home_times", "home_units"))):
                ka, kb = np.frombuffer(rest[0], "V16"), np.frombuffer(rest[3], "V16")
                ta, tb = np.frombuffer(rest[1], "<i8"), np.frombuffer(rest[4], "<i8")
                a = np.frombuffer(rest[2], "<f8").reshape(-1, dims)
                b = np.frombuffer(rest[5], "<f8").reshape(-1, dims)
                hit = a @ b.T >= threshold
                if same:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                counts = [(ka, hit @ tb)] if same else [(ka, hit @ tb), (kb, ta @ hit)]
                root, left, right = np.arange(len(b)), [], []
                for i in np.flatnonzero(hit.any(axis=1)).tolist():
                    partners = np.flatnonzero(hit[i])
                    _, first = np.unique(root[partners], return_index=True)
                    heads = partners[first]
                    left += [bytes(ka[i])] * len(heads)
                    right += [bytes(kb[j]) for j in heads.tolist()]
                    if len(heads) > 1:
                        root[np.isin(root, root[heads])] = root[heads[0]]
                keys = [bytes(k) for ks, ns in counts for k, n in zip(ks, ns.tolist()) if n]
                links = [n for _, ns in counts for n in ns.tolist() if n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys + left, pa.binary()), pa.array(links + [None] * len(left), pa.int64()),
                     pa.array([None] * len(keys) + right, pa.binary())], names=["key", "links", "other"])
    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors with a cosine of at least
    ``threshold``), ``component_id`` (smallest ``vec_id`` reachable) and
    ``kept`` (``vec_id`` is the ``component_id``), a row per row of ``vec_id,
    embedding``.

    Cosines are in double precision.  Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing, and vectors of different
    length do not link with each other.  Equal vectors are compared once and
    counted as often as they occur; a null id is never the smallest unless a
    group has no other; rows sharing an id are vectors of their own; an empty
    table gives no rows.  The result is exact whatever the centroids are.
    """
    spark = embeddings.sparkSession
    bound_batches(spark)
    read = materialize(embeddings.select("vec_id", "embedding").mapInArrow(
        _read, "vec_id bigint, key binary, dims int, unit binary"))
    valid = read.where(F.col("key").isNotNull())
    classes = materialize(valid.groupBy("key", "dims", "unit").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("times")))
    shared = spark.sparkContext.broadcast(pickle.dumps(fit_cells(classes)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tile = "dims int, cell int, tile binary, keys binary, times binary, units binary"
    tiles = materialize(
        classes.select("key", "times", "dims", "unit")
        .mapInArrow(_assign(shared), "cell int, key binary, times bigint, dims int, unit binary")
        .repartitionByRange(n, "dims", "cell", "key").sortWithinPartitions("dims", "cell", "key")
        .mapInArrow(_pack, tile))
    visitors = tiles.union(tiles.mapInArrow(_visits(shared, threshold), tile))
    home = tiles.select("dims", "cell", F.col("tile").alias("home"), F.col("keys").alias("home_keys"),
                        F.col("times").alias("home_times"), F.col("units").alias("home_units"))
    # tiles of one cell meet once; what comes from another cell has no tile and meets all
    pairs = (visitors.join(home, ["dims", "cell"]).where(F.col("tile").isNull() | (F.col("tile") <= F.col("home")))
             .withColumn("same", F.coalesce(F.col("tile") == F.col("home"), F.lit(False))))
    found = materialize(pairs.mapInArrow(_compare(threshold), "key binary, links bigint, other binary"))
    links = found.where(F.col("links").isNotNull()).groupBy("key").agg(F.sum("links").alias("links"))
    group = components(found.where(F.col("other").isNotNull()).select(F.col("key").alias("a"), F.col("other").alias("b")))
    labelled = (classes.select("key", "least", "times").join(links, "key", "left")
                .join(group, F.col("key") == F.col("node"), "left")
                .select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                        F.coalesce("label", "key").alias("label")))
    # written, so that the join below is plain and a large group in it can be split
    least = materialize(labelled.groupBy("label").agg(F.min("least").alias("component_id")))
    by_key = labelled.join(least, "label").select("key", "n_links", "component_id")
    out = read.select("vec_id", "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
