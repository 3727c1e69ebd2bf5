"""Merkle manifest of a dataset with nested-interval labels.

Every row is a leaf with a rank in its group's tree; every node is labelled with the
interval of leaf ranks that it covers. Ancestors of a leaf are the nodes whose intervals
contain its rank; the sibling of a node is what its parent's interval covers besides it.

Nodes are kept in bands of ``BAND`` levels. All nodes of a band below one node of the
band's top stand in one bucket: at most ``2 ** BAND`` members at the bottom and as many
inner nodes, so a bucket is small however large the tree is.

1. Ranks: rows are dealt out by range and numbered in each part; a running sum over the
   parts (a few numbers a part) gives the offsets. No task holds a group.
2. Upwards, band by band: the members of a bucket are hashed up to its top node; the
   nodes are written with their intervals, and the tops are the next band's members.
3. Downwards, band by band: the members of a bucket meet the bucket's nodes
   (containment join on the bucket) and get their ancestors and siblings; the path above
   the top comes with the top, so it is never copied more than once a bucket.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinship.session import write_table
from llm._spark import ship

BAND = 10
#: fixed values: the fields of a leaf, in order; every 7th checksum marks a tampered row
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 7

_LEFT, _RIGHT, _ALONE = 0, 1, 2  # where the sibling of a node stands


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def levels(n: int) -> int:
    """Levels above the leaves of a tree with ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and itself; null is ``-``."""
    shown = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in shown]), 256))


def ranked_leaves(rows: DataFrame) -> DataFrame:
    """``rows``: (lang, doc_id, leaf, ...). Adds ``idx``, the rank within ``lang`` by id (null
    first), then digest, from 0; ``n``, the rows of ``lang``; ``tree``, the rank of ``lang`` (null
    first). Rows with one id and digest are equal and split by arrival."""
    extra = [c for c in rows.columns if c != "lang"]
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), "leaf", "_salt").sortWithinPartitions(
        F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), "leaf", "_salt").select("lang", *extra)

    def number(batches):
        part = TaskContext.get().partitionId()
        before, n = object(), 0
        for b in batches:
            out = []
            for lang in b.column(0).to_pylist():
                n = n + 1 if lang == before else 0
                before = lang
                out.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(out), pa.int64()), pa.array(out, pa.int64())],
                                             [*b.schema.names, "part", "nr"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    parts = write_table(dealt.mapInArrow(number, f"{kinds}, part long, nr long"), "merkle-leaves")
    per_part = parts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("rows"))
    trees = per_part.groupBy("lang").agg(F.sum("rows").alias("n")).withColumn(
        "tree", F.row_number().over(Window.orderBy(F.asc_nulls_first("lang"))).cast("long") - 1)  # a row per group
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("lang", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("off"))
    t = trees.select(F.col("lang").alias("_lang"), "n", "tree")
    offsets = offsets.join(t, F.col("lang").eqNullSafe(F.col("_lang"))).select("_lang", F.col("part").alias("_part"), "off", "n", "tree")
    offsets = write_table(offsets, "merkle-offsets")
    same = (parts["part"] == offsets["_part"]) & parts["lang"].eqNullSafe(offsets["_lang"])
    return parts.join(offsets, same).select("lang", *extra, "tree", (F.col("nr") + F.col("off")).alias("idx"), "n")


_NODE = "tree long, bucket long, level int, lo long, hi long, digest binary, n long, top boolean"


def _hash_bucket(band: int):
    """Hashes the members of one bucket up to its top."""

    def work(key, group):
        tree, bucket = (k.as_py() for k in key)
        order = group.column("idx").to_pylist()
        digests = [d for _, d in sorted(zip(order, group.column("digest").to_pylist()))]
        n = group.column("n")[0].as_py()
        base = band * BAND
        high = min(BAND, max(levels(n) - base, 0))
        first, out = bucket << BAND, []
        for level in range(base, base + high):
            if level > base:
                out += [(level, i, d, False) for i, d in enumerate(digests, first)]
            digests = [_digest(*digests[i:i + 2]) for i in range(0, len(digests), 2)]
            first >>= 1
        out.append((base + high, first, digests[0], True))
        return pa.table({
            "tree": pa.array([tree] * len(out), pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int64()),
            "level": pa.array([x[0] for x in out], pa.int32()), "lo": pa.array([x[1] << x[0] for x in out], pa.int64()),
            "hi": pa.array([min((x[1] + 1) << x[0], n) for x in out], pa.int64()),
            "digest": pa.array([x[2] for x in out], pa.binary()), "n": pa.array([n] * len(out), pa.int64()),
            "top": pa.array([x[3] for x in out], pa.bool_())})

    return work


def _bucketed(members: DataFrame) -> DataFrame:
    return members.withColumn("bucket", F.shiftright("idx", BAND))


def _ends_in(band: int) -> Column:
    """Whether a node's tree has no level above this band."""
    return F.col("n") <= F.lit(min(1 << (BAND * (band + 1)), (1 << 63) - 1)).cast("long")


@dataclass
class Forest:
    """``members[b]``: (tree, idx, digest, n) at the bottom of band ``b``; ``nodes[b]``: the nodes
    above them, with intervals; ``roots``: (tree, root)."""

    members: list[DataFrame]
    nodes: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame, most: int) -> Forest:
    """The trees over ``leaves`` (tree, idx, digest, n), of which none has more than ``most`` rows.
    One written table of nodes for each ``BAND`` levels."""
    members, nodes, finished = [leaves.select("tree", "idx", "digest", "n")], [], []
    for band in range(max(1, -(-levels(most) // BAND))):
        grouped = _bucketed(members[-1]).groupBy("tree", "bucket")
        made = write_table(grouped.applyInArrow(_hash_bucket(band), _NODE), f"merkle-band-{band}")
        nodes.append(made)
        tops, done = made.where("top"), _ends_in(band)
        finished.append(tops.where(done).select("tree", F.col("digest").alias("root")))
        members.append(tops.where(~done).select("tree", F.col("bucket").alias("idx"), "digest", "n"))
    roots = finished[0]
    for f in finished[1:]:
        roots = roots.union(f)
    return Forest(members[:-1], nodes, roots)


def _attach(band: int, folded: bool):
    """Path from each member of a bucket to the root: the siblings inside the bucket, found by
    intervals, then the path above the bucket's top."""

    def work(key, left, right):
        base = band * BAND
        members = sorted(zip(left.column("idx").to_pylist(), left.column("digest").to_pylist(), range(left.num_rows)))
        n = left.column("n")[0].as_py()
        # interval -> digest, by level
        named = {base: {(i << base, min((i + 1) << base, n)): d for i, d, _ in members}}
        above = subroot = root = None
        for level, lo, hi, d, top, a, s, r in zip(*(right.column(c).to_pylist() for c in (
                "level", "lo", "hi", "digest", "top", "above", "subroot", "root"))):
            named.setdefault(level, {})[(lo, hi)] = d
            if top:
                above, subroot, root, summit = a, s, r, level
        # the bucket's intervals by level: each node's parent is the interval that contains it one level higher
        parent = {}
        for level in range(base, summit):
            starts = {lo >> (level + 1): (lo, hi) for lo, hi in named[level + 1]}
            for lo, hi in named[level]:
                parent[level, lo] = starts[lo >> (level + 1)]
        paths = {}
        for i, d, at in members:
            lo, hi = i << base, min((i + 1) << base, n)
            path = []
            for level in range(base, summit):
                plo, phi = parent[level, lo]
                # the parent's interval without the node's own
                if plo < lo:
                    path.append(bytes([_LEFT]) + named[level][plo, lo])
                elif hi < phi:
                    path.append(bytes([_RIGHT]) + named[level][hi, phi])
                else:
                    path.append(bytes([_ALONE]))
                lo, hi = plo, phi
            paths[at] = b"".join(path) + above
        rows = range(left.num_rows)
        if not folded:
            return pa.table({
                "tree": left.column("tree"), "idx": left.column("idx"), "path": pa.array([paths[r] for r in rows], pa.binary()),
                "subroot": pa.array([subroot] * len(rows), pa.binary()), "root": pa.array([root] * len(rows), pa.binary())})
        claimed = left.column("claim").to_pylist()
        proofs = [hashlib.sha256("".join(s.hex() for s in siblings(paths[r])).encode()).hexdigest() for r in rows]
        ends = [fold(claimed[r], paths[r]) for r in rows]
        return pa.table({
            "doc_id": left.column("doc_id"), "leaf": pa.array([d.hex() for d in left.column("digest").to_pylist()]),
            "subroot": pa.array([subroot.hex()] * len(rows)), "root": pa.array([root.hex()] * len(rows)),
            "proof_sha256": pa.array(proofs), "folded_root": pa.array([e.hex() for e in ends]),
            "verified": pa.array([e == root for e in ends])})

    return work


def _steps(path: bytes):
    at = 0
    while at < len(path):
        side = path[at]
        size = 0 if side == _ALONE else 32
        yield side, path[at + 1:at + 1 + size]
        at += 1 + size


def siblings(path: bytes) -> list[bytes]:
    return [d for side, d in _steps(path) if side != _ALONE]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    for side, d in _steps(path):
        leaf = _digest(d, leaf) if side == _LEFT else _digest(leaf, d) if side == _RIGHT else _digest(leaf)
    return leaf


_PATH = "tree long, idx long, path binary, subroot binary, root binary"
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def descend(forest: Forest, tops: DataFrame, leaves: DataFrame | None = None) -> DataFrame:
    """Paths of all leaves (``tree, idx, path, subroot, root``); with ``leaves`` (the members of
    band 0 with ``doc_id`` and ``claim``) their proofs instead. ``tops``: (tree, path, subroot,
    root), the path above each tree's root."""
    ends = tops.select(F.col("tree").alias("_tree"), F.col("path").alias("_path"), F.col("subroot").alias("_subroot"), F.col("root").alias("_root"))
    below = None
    for band in reversed(range(len(forest.nodes))):
        made = forest.nodes[band]
        # a top that ends its tree goes on with the path above the tree, another with its own as a member
        is_end = F.col("top") & _ends_in(band)
        out = ["tree", "bucket", "level", "lo", "hi", "digest", "top", F.col("_path").alias("above"),
               F.col("_subroot").alias("subroot"), F.col("_root").alias("root")]
        parts = [made.where(is_end).join(ends, F.col("tree") == F.col("_tree")).select(*out)]
        if below is not None:
            b = below.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"),
                             F.col("subroot").alias("_subroot"), F.col("root").alias("_root"))
            parts.append(made.where(F.col("top") & ~is_end).join(b, (F.col("tree") == F.col("_tree")) & (F.col("bucket") == F.col("_idx"))).select(*out))
        none = F.lit(None).cast("binary")
        right = made.where(~F.col("top")).select("tree", "bucket", "level", "lo", "hi", "digest", "top", none.alias("above"),
                                                 none.alias("subroot"), none.alias("root"))
        for p in parts:
            right = right.union(p)
        last = band == 0 and leaves is not None
        left = _bucketed(leaves if last else forest.members[band]).groupBy("tree", "bucket")
        below = left.cogroup(right.groupBy("tree", "bucket")).applyInArrow(_attach(band, last), _PROOF if last else _PATH)
    return below


def merkle_proofs(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "lang",
                  claims: dict[str, Column] | None = None) -> DataFrame:
    """The manifest of ``docs`` and the proof of every row.

    Returns one row per input row: ``(doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified)``. ``leaf``: digest of the ``fields``; the rows of a group (``group_col``,
    null is a group) are the leaves of a tree by id (null first; rows with one id by
    digest), ``subroot`` its root, and the subroots by group are the leaves of the tree of
    ``root``. ``proof_sha256``: digest of the siblings on the way up. ``claims`` gives fields
    another value: ``folded_root`` is what the claimed leaf and the original siblings give,
    ``verified`` whether that is the root.

    Null and empty values differ (``-`` and ``0:``). Equal rows have equal digests, and each
    its own place. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    leaf = leaf_digest([docs[f] for f in fields])
    other = leaf_digest([(claims or {}).get(f, docs[f]) for f in fields])
    rows = docs.select(docs[group_col].cast("string").alias("lang"), docs[id_col].cast("long").alias("doc_id"),
                       leaf.alias("leaf"), other.alias("claim"))
    ranked = ranked_leaves(rows)
    leaves = ranked.select("doc_id", F.col("leaf").alias("digest"), "claim", "tree", "idx", "n")
    # two numbers reach the driver; without rows both are null
    most, trees = leaves.agg(F.max("n"), F.max("tree")).first()
    forest = grow(leaves, most or 0)
    groups = (trees if trees is not None else -1) + 1
    crowns = grow(forest.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                      F.col("root").alias("digest"), F.lit(groups).cast("long").alias("n")), groups)
    start = crowns.roots.select("tree", F.lit(b"").alias("path"), F.col("root").alias("subroot"), "root")
    above = descend(crowns, start).select(F.col("idx").alias("tree"), "path", "root").join(
        forest.roots.select("tree", F.col("root").alias("subroot")), "tree")
    return descend(forest, above.select("tree", "path", "subroot", "root"), leaves)


def tampered(docs: DataFrame, id_col: str = "doc_id", count_col: str = "n_chars") -> dict[str, Column]:
    """Claims with 1 more in ``count_col`` where 7 divides the checksum of the id (null ids and
    null counts stay). Counted in decimals, so the largest long has a successor."""
    marked = F.crc32(docs[id_col].cast("string")) % TAMPER_MODULUS == 0
    count = docs[count_col].cast("decimal(20,0)")
    return {count_col: F.when(marked, count + 1).otherwise(count).cast("decimal(20,0)")}
