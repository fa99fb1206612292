"""Merkle manifest of a dataset, with proofs by octopus multiproofs.

Every row is a leaf.  The leaves of a group, in order, are hashed in runs of
eight until one node is left, its subroot; the subroots, in order, are hashed
the same way up to the root.  Proofs are made for a partition of leaves at a
time: it names the least set of nodes that its own leaves can't give, fetches
each once, derives what its leaves share, and expands every leaf's own proof.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import dense_row_number
from .common import bound_batches, materialize

#: Nodes of a run.
FAN = 8
#: Leaves of a partition, about: those that share one multiproof.
LEAVES = 4096
#: The columns of a leaf, in their order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the subroots; groups are trees 1, 2, ... in their order.
TOP = 0

FIELDS = "leaf binary, subroot binary, proof_sha256 binary, folded_root binary"
PROOF = "proof array<struct<place: int, siblings: array<string>>>"


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the columns: each ``-`` if null, else bytes, ``:``, value."""
    def part(c):
        value = c.cast("string")
        return F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return F.unhex(F.sha2(F.concat(*map(part, columns.values())), 256))


def _runs(level: DataFrame) -> DataFrame:
    """The level above: a node for each run of :data:`FAN` of ``level``."""
    run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
    return (level.where("size > 1").groupBy("tree", "size", F.expr(f"idx div {FAN}").alias("up")).agg(run.alias("run"))
            .select("tree", F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size"), F.col("up").alias("idx"),
                    F.unhex(F.sha2(F.array_join(F.transform("run", lambda n: F.lower(F.hex(n["digest"]))), ""), 256))
                    .alias("digest")))


def _levels(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Levels of trees of at most ``most`` leaves, from the leaves up."""
    levels = [leaves.select("tree", "size", "idx", "digest")]
    while most > 1:
        levels.append(materialize(_runs(levels[-1])))
        most = -(-most // FAN)
    return levels


def _union(levels: list[DataFrame]) -> DataFrame:
    tagged = [df.withColumn("level", F.lit(i)) for i, df in enumerate(levels)]
    out = tagged[0]
    for more in tagged[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Manifest:
    """``leaves`` (``doc``, ``tree``, ``size`` of the tree, ``idx`` in it,
    ``digest``, ``shown`` and ``at``, the place in the order of all rows),
    ``nodes`` (``tree, level, idx, size`` of the level, ``digest``; level 0 are
    the leaves), ``groups`` (``tree, value, size``, ``subroot``), the number of
    ``trees`` and the ``root`` (None without rows)."""
    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    trees: int
    root: bytes | None


def build(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "lang", order: str = "doc_id",
          shown: dict[str, Column] | None = None, keep: list[str] | None = None) -> Manifest:
    """Manifest of ``docs``: a leaf per row over ``columns``, a tree per value of
    ``group``, leaves by ``order``.

    ``shown`` replaces columns by expressions: the digest of what they give is
    kept beside the leaf's, to be verified against the manifest.  Nulls come
    first in both orders and have leaves like other values, texts may be empty
    or very long (a leaf is one digest); rows that share an id are ordered by
    their digest, fully repeated rows are leaves of their own whose places are
    interchangeable.  Other columns stay apart in ``doc`` (those of ``keep``,
    else all but the texts hashed), whatever their names.  No rows, no root.
    """
    of = {c: F.col(c) for c in columns}
    changed = leaf_digest(of | (shown or {})) if shown else F.lit(None).cast("binary")
    held = keep if keep is not None else [c for c in docs.columns if c != "text"]
    doc = F.struct(*held) if held else F.struct(F.lit(None).cast("int").alias("none"))
    # hashed once and written: texts go no further, and a row's number is fixed
    hashed = materialize(docs.select(doc.alias("doc"), F.col(group).alias("group"), F.col(order).alias("key"),
                                     leaf_digest(of).alias("digest"), changed.alias("shown"),
                                     F.monotonically_increasing_id().alias("row")))
    placed = dense_row_number(hashed, ["group", "key", "digest", "row"], out="at").drop("key", "row")
    by_group = placed.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    groups = materialize(dense_row_number(by_group, "first", out="tree"))
    trees, most = groups.agg(F.count(F.lit(1)), F.max("size")).first()
    leaves = materialize(placed.join(groups.withColumnRenamed("group", "value"), F.col("group").eqNullSafe(F.col("value")))
                         .select("doc", "tree", "size", (F.col("at") - F.col("first")).alias("idx"), "digest", "shown",
                                 (F.col("at") - 1).alias("at")))
    below = _levels(leaves, most or 0)
    subroots = materialize(_union(below).where("size = 1").select("tree", "digest"))
    top = _levels(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(trees).cast("bigint").alias("size"),
                                  (F.col("tree") - 1).alias("idx"), "digest"), trees)
    root = top[-1].where("size = 1").select("digest").first()
    return Manifest(leaves, _union(below).unionByName(_union(top)),
                    groups.join(subroots, "tree").select("tree", F.col("group").alias("value"), "size",
                                                         F.col("digest").alias("subroot")),
                    trees, bytes(root[0]) if root else None)


def missing(wanted: np.ndarray, size: int) -> list[np.ndarray]:
    """For each level of a tree of ``size`` leaves, below its root, the places
    that the leaves ``wanted`` (sorted) need and can't give: the fewest nodes
    that let all of them be led up to the root."""
    out, have = [], np.asarray(wanted, dtype=np.int64)
    while size > 1:
        up = np.unique(have // FAN)
        runs = (up[:, None] * FAN + np.arange(FAN)).ravel()
        out.append(np.setdiff1d(runs[runs < size], have, assume_unique=True))
        have, size = up, -(-size // FAN)
    return out


def _trees_of(table: pa.Table) -> list[tuple[int, int, np.ndarray]]:
    """Tree, its size and the rows of ``table`` in it, in order of the leaves."""
    tree, idx = table.column("tree").to_numpy(), table.column("idx").to_numpy()
    order, size = np.lexsort((idx, tree)), table.column("size").to_numpy()
    cut = np.flatnonzero(np.diff(tree[order])) + 1
    return [(int(tree[rows[0]]), int(size[rows[0]]), rows) for rows in np.split(order, cut)]


def _requests(trees: int):
    def of_part(key, table):
        asked: list[tuple[int, int, np.ndarray]] = []
        found = _trees_of(table)
        idx = table.column("idx").to_numpy()
        for tree, size, rows in found:
            asked += [(tree, level, at) for level, at in enumerate(missing(idx[rows], size))]
        asked += [(TOP, level, at) for level, at in
                  enumerate(missing(np.array([t - 1 for t, _, _ in found]), trees))]
        lengths = [len(at) for _, _, at in asked]
        return pa.table({
            "part": pa.array(np.full(sum(lengths), key[0].as_py())),
            "tree": pa.array(np.repeat([t for t, _, _ in asked], lengths).astype(np.int64)),
            "level": pa.array(np.repeat([v for _, v, _ in asked], lengths).astype(np.int32)),
            "idx": pa.array(np.concatenate([at for _, _, at in asked]).astype(np.int64) if asked else
                            np.empty(0, np.int64))})
    return of_part


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Tree:
    """Nodes of one tree that a partition knows, level by level from the
    wanted leaves and the fetched nodes."""

    def __init__(self, size: int, leaves: dict[int, str], fetched: dict[int, dict[int, str]]):
        self.levels = [leaves | fetched.get(0, {})]
        #: Per level, of each place that lies above a wanted leaf, what stands before and after it in its run.
        self.beside: list[dict[int, tuple[list[str], list[str]]]] = []
        above, level = sorted(leaves), 0
        while size > 1:
            known, beside, nodes = self.levels[-1], {}, {}
            for up in sorted({i // FAN for i in above}):
                first = up * FAN
                run = [known[i] for i in range(first, min(first + FAN, size))]
                nodes[up] = _sha("".join(run))
                beside.update({first + j: (run[:j], run[j + 1:]) for j in range(len(run))})
            above, size, level = sorted(nodes), -(-size // FAN), level + 1
            self.beside.append(beside)
            self.levels.append(nodes | fetched.get(level, {}))
        self.root = self.levels[-1][0]

    def path(self, i: int) -> list[tuple[list[str], list[str]]]:
        out = []
        for beside in self.beside:
            out.append(beside[i])
            i //= FAN
        return out


def fold(leaf: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that ``leaf`` and the nodes beside its path lead to."""
    for before, after in path:
        leaf = _sha("".join([*before, leaf, *after]))
    return leaf


def _expand(root: str, trees: int, proofs: bool):
    def of_part(key, table, fetched):
        got: dict[int, dict[int, dict[int, str]]] = {}
        for tree, level, idx, digest in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx", "digest"))):
            got.setdefault(tree, {}).setdefault(level, {})[idx] = digest.hex()
        idx = table.column("idx").to_numpy()
        leaf = [d.hex() for d in table.column("digest").to_pylist()]
        shown = [d and d.hex() for d in table.column("shown").to_pylist()]
        rows_of = _trees_of(table)
        below = {tree: _Tree(size, {int(idx[r]): leaf[r] for r in rows}, got.get(tree, {})) for tree, size, rows in rows_of}
        top = _Tree(trees, {t - 1: b.root for t, b in below.items()}, got.get(TOP, {}))
        if rows_of and top.root != root:
            raise ValueError("the nodes fetched for a partition don't lead to the manifest's root")
        out: dict[str, list] = {"subroot": [b""] * len(leaf), "proof_sha256": [b""] * len(leaf),
                                "folded_root": [b""] * len(leaf), "proof": [None] * len(leaf)}
        for tree, _, rows in rows_of:
            own, upper = below[tree], top.path(tree - 1)
            for r in rows:
                path = own.path(int(idx[r])) + upper
                beside = [[*before, *after] for before, after in path]
                out["subroot"][r] = bytes.fromhex(own.root)
                out["proof_sha256"][r] = hashlib.sha256("".join(map("".join, beside)).encode()).digest()
                out["folded_root"][r] = bytes.fromhex(fold(shown[r] or leaf[r], path))
                if proofs:
                    out["proof"][r] = [{"place": len(before), "siblings": s} for (before, _), s in zip(path, beside)]
        cols = {"doc": table.column("doc"), "leaf": table.column("digest")}
        cols |= {c: pa.array(out[c], pa.binary()) for c in ("subroot", "proof_sha256", "folded_root")}
        if proofs:
            cols["proof"] = pa.array(out["proof"], pa.list_(pa.struct(
                [("place", pa.int32()), ("siblings", pa.list_(pa.string()))])))
        return pa.table(cols)
    return of_part


def prove(manifest: Manifest, wanted: Column | None = None, proofs: bool = False) -> DataFrame:
    """A row per leaf (of those where ``wanted``, over the columns of
    ``Manifest.leaves``): ``doc``, ``leaf``, ``subroot``, ``proof_sha256`` (of
    the siblings, level by level, left to right) and ``folded_root``, what the
    shown digest, else the leaf's own, and the siblings lead to; with
    ``proofs`` also the ``proof``, per level the leaf's place among its siblings
    and these.  A proof holds if ``folded_root`` is the manifest's root."""
    leaves = manifest.leaves if wanted is None else manifest.leaves.where(wanted)
    leaves = leaves.withColumn("part", F.expr(f"at div {LEAVES}"))
    bound_batches(leaves.sparkSession)
    asked = leaves.select("part", "tree", "size", "idx").groupBy("part").applyInArrow(
        _requests(manifest.trees), "part bigint, tree bigint, level int, idx bigint")
    fetched = materialize(asked.join(manifest.nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"]))
    own = T._parse_datatype_string(FIELDS + (", " + PROOF if proofs else ""))
    schema = T.StructType([leaves.schema["doc"], *own.fields])
    root = manifest.root.hex() if manifest.root else ""
    return leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(
        _expand(root, manifest.trees, proofs), schema)
