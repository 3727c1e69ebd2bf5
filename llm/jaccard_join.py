"""Near-duplicate groups: an n-gram Jaccard join by signature trees.

1. A document is the set of its word shingles; equal sets collapse into a class.
2. Candidate clusters. On the circle of hash values, two sets with a Jaccard
   similarity of 85 % have at least 5.67 common elements for each other one (80 %: 4),
   so a run of 5 (4) successive elements of one set is successive in the other, too.
   Sets of up to ``EVERY`` elements give all their runs (no link can be lost), larger
   ones the runs after so many points of the circle that a link at the threshold is
   lost with probability (1 - 0.85^5)^48 < ``MISS``, a closer one with less
   (``runs_for``). Sets that share a run are tied to the smallest of them; components
   of the ties are the clusters.
3. Inside a cluster a signature tree is built: the leaves hold the bitmap of a set's
   elements and its size, the nodes the OR of the bitmaps and the range of the sizes.
   A dual traversal of two trees drops a pair of nodes when no pair of sets below
   them can overlap enough; surviving pairs of sets are verified exactly, unless they
   are connected already.
4. A cluster beyond ``BLOCK_SETS`` sets or ``BLOCK_BYTES`` is cut into blocks: first
   every block alone, then every block with the first one, then the pairs of blocks
   that are not yet one component. No task holds more than two blocks.

Only links between classes are made, never all pairs of a group.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.session import write_table
from llm._spark import held, pack, ship, small_batches, unpack
from llm._symbols import U64, Block, Words, blocks, mix
from llm.components import components

WIDTH = 4
PERCENT = 85
MAX_RUN = 5
EVERY = 64
MISS = 1e-12
BLOCK_SETS = 1024
BLOCK_BYTES = 8 << 20  # of compressed text
BITS = 4096
FANOUT = 8
PAIRS = 8192  # node pairs looked at together


def _sets(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin of each row, hashes): the distinct shingles of every row, ascending."""
    row, h = Words(block, lower=True).shingles(width)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return np.searchsorted(row[fresh], np.arange(block.n + 1)), h[fresh]


def runs_for(percent: int) -> tuple[int, int]:
    """(length of a run, points of the circle) that find links of this threshold."""
    percent = min(percent, 99)
    run = min(MAX_RUN, percent // (100 - percent))
    return run, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** run))


def _keys(begin: np.ndarray, h: np.ndarray, length: int, grid: int) -> list[np.ndarray]:
    """Hashes of runs of ``length`` successive elements of every set, on the circle."""
    n = np.diff(begin)
    row = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(h)) - begin[row]
    run = np.zeros(len(h), dtype=U64)
    for k in range(length):
        run = mix(run * U64(31) + h[begin[row] + (nth + k) % n[row]])
    cell = (h // U64((1 << 64) // grid + 1)).astype(np.int64)
    below = np.zeros((len(n), grid), dtype=np.int64)
    counts = np.bincount(row * grid + cell, minlength=len(n) * grid).reshape(-1, grid)
    below[:, 1:] = np.cumsum(counts, 1)[:, :-1]
    out = []
    for i, size in enumerate(n.tolist()):
        own = run[begin[i]:begin[i + 1]]
        out.append(np.unique(own[below[i] % size] if size > EVERY else own) if size >= length else own[:0])
    return out


def _signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    runs = runs_for(percent)

    def work(batches):
        for b in batches:
            for block in blocks(b.column(2)):
                begin, h = _sets(block, width)
                n = np.diff(begin)
                # a digest of its elements in order names a set
                names = b"".join(blake2b(h[x:y].tobytes(), digest_size=16).digest() for x, y in zip(begin[:-1].tolist(), begin[1:].tolist()))
                whole = np.frombuffer(names, dtype="<i8").reshape(-1, 2).T
                keys = [k.view(np.int64) for k in _keys(begin, h, *runs)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[block.rows], b.column(1)[block.rows], pa.array(n), pa.array(whole[0]), pa.array(whole[1]),
                     pa.array(keys, pa.list_(pa.int64()))], ["_id", "_v", "n", "h1", "h2", "keys"])

    return docs.mapInArrow(work, "_id long, _v long, n long, h1 long, h2 long, keys array<long>")


class SignatureTree:
    """Levels from the leaves (one set each) to the root; see the module text."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
        own = [sets[i] for i in self.order]
        size = np.array([len(s) for s in own])
        flags = np.zeros((len(own), BITS), dtype=np.uint8)
        flags[np.repeat(np.arange(len(own)), size), (np.concatenate(own) % U64(BITS)).astype(np.int64)] = 1
        bits = np.packbits(flags, axis=1).view(U64)
        twin = size - np.bitwise_count(bits).sum(1)  # elements that share a bit with another
        self.levels = [(bits, size, size, twin)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, twin = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(twin, at)))


def _possible(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes may hold a pair of sets that reaches the threshold."""
    (bits_a, low_a, high_a, twin_a), (bits_b, low_b, high_b, twin_b) = a, b
    ok = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    most = np.minimum(np.bitwise_count(bits_a[i] & bits_b[j]).sum(1) + np.minimum(twin_a[i], twin_b[j]), np.minimum(high_a[i], high_b[j]))
    return ok & ((100 + percent) * most >= percent * (low_a[i] + low_b[j]))


def _leaf_pairs(a: SignatureTree, b: SignatureTree, percent: int):
    """Dual traversal: candidate pairs of sets, as positions in the trees' order."""
    top = max(len(a.levels), len(b.levels)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        la, lb = (t.levels[min(level, len(t.levels) - 1)] for t in (a, b))
        keep = _possible(la, lb, i, j, percent)
        i, j = i[keep], j[keep]
        if a is b:
            i, j = i[i <= j], j[i <= j]
        if not len(i):
            continue
        if level == 0:
            yield i, j
            continue
        wide = [level < len(t.levels) for t in (a, b)]  # a lower tree waits at its root
        below = [len(t.levels[min(level - 1, len(t.levels) - 1)][0]) for t in (a, b)]
        child = np.arange(FANOUT)
        i2 = (i[:, None] * FANOUT + child) if wide[0] else i[:, None]
        j2 = (j[:, None] * FANOUT + child) if wide[1] else j[:, None]
        i3 = np.repeat(i2, j2.shape[1], axis=1).ravel()
        j3 = np.tile(j2, (1, i2.shape[1])).ravel()
        ok = (i3 < below[0]) & (j3 < below[1])
        i3, j3 = i3[ok], j3[ok]
        for at in range(0, len(i3), PAIRS):
            stack.append((level - 1, i3[at:at + PAIRS], j3[at:at + PAIRS]))


def cell_links(ids: list[int], labels: list[int], sets: list[np.ndarray], side: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets of a cell as all their links would: of one block
    (side 0 only), or between two blocks. Equal labels are connected already."""
    parent: dict[int, int] = {x: x for x in labels}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    parts = [[k for k in range(len(ids)) if side[k] == s] for s in (0, 1)]
    if not parts[0] or (any(side) and not parts[1]):
        return []
    a = SignatureTree([sets[k] for k in parts[0]])
    b = SignatureTree([sets[k] for k in parts[1]]) if parts[1] else a
    at_a = [parts[0][k] for k in a.order]
    at_b = [parts[1][k] for k in b.order] if parts[1] else at_a
    out = []
    for i, j in _leaf_pairs(a, b, percent):
        root = {x: find(x) for x in parent}
        ra, rb = np.array([root[labels[k]] for k in at_a]), np.array([root[labels[k]] for k in at_b])
        open_ = ra[i] != rb[j]
        for x, y in zip(i[open_].tolist(), j[open_].tolist()):
            x, y = at_a[x], at_b[y]
            u, v = find(labels[x]), find(labels[y])
            if u == v:
                continue
            s, t = (sets[x], sets[y]) if len(sets[x]) <= len(sets[y]) else (sets[y], sets[x])
            shared = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            if 100 * shared >= percent * (len(s) + len(t) - shared):
                parent[max(u, v)] = min(u, v)
                out.append((ids[x], ids[y]))
    return out


def _links(cells: DataFrame, width: int, percent: int) -> DataFrame:
    """``cells``: (cell, side, id, label, z); a cell's rows go to one task together."""

    def work(batches):
        held, name = [], None

        def flush():
            if len(held) < 2:
                return
            sets = []
            for text in unpack(pa.array([r[3] for r in held], pa.binary())):
                begin, h = _sets(next(blocks(pa.array([text], pa.binary()))), width)
                sets.append(h)
            found = cell_links([r[1] for r in held], [r[2] for r in held], sets, [r[0] for r in held], percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        for whole in batches:
            for b in small_batches(whole):
                for cell, *row in zip(*(c.to_pylist() for c in b.columns)):
                    if cell != name:
                        yield from flush()
                        held, name = [], cell
                    held.append(row)
        yield from flush()

    rows = cells.select("cell", "side", "id", "label", "z").repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(work, "a long, b long")


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _v, _text)`` as ``keyed`` gives them, but a null id stays null."""
    text, given = docs[text_col].cast("string"), docs[id_col].cast("long")
    version = F.when(given.isNull(), F.xxhash64(text)).otherwise(F.crc32(text))
    return docs.select(given.alias("_id"), F.coalesce(version, F.lit(-1)).alias("_v"), text.alias("_text"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(<id_col>, _v, n_shingles, component_id)`` for every row: the smallest id that
    links reach, where two documents link when ``100 * intersection >= percent * union``
    of their shingle sets. A-Z is lower-cased; with fewer than ``width`` words the whole
    sequence is one shingle. ``_v`` is a checksum of the text.

    Documents without words or with null text have an empty set and are their own
    component. A row without an id links like any other, but never names a component
    (null if there is no other). Every long is an id. Rows with one id are one document:
    what one of them links, all do. An empty table gives an empty result; other columns
    are ignored. ``percent`` is at least 50 (below, no run of elements needs to be common).
    """
    if not 50 <= percent <= 100:
        raise ValueError("the threshold is a percentage from 50 to 100")
    ship(docs.sparkSession)
    rows = _versions(docs, id_col, text_col)
    every = write_table(_signatures(rows, width, percent), "signatures")
    # links are between the numbers of classes, so that an id may be any long or null
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_v", "keys")).alias("r")
    classes = write_table(every.where("n > 0").groupBy("h1", "h2").agg(first).select(
        "h1", "h2", F.monotonically_increasing_id().alias("node"), F.col("r._id").alias("rep"), F.col("r._v").alias("rep_v"), "r.keys"), "classes")
    # rows with one id and different sets
    member = every.where("n > 0 and _id is not null").select("_id", "h1", "h2").join(classes.select("h1", "h2", "node"), ["h1", "h2"]).select("_id", "node")
    several = member.groupBy("_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("_id", "x")
    same_id = write_table(member.join(several, "_id").where("node <> x").select(F.col("node").alias("a"), F.col("x").alias("b")), "same-id")

    runs = classes.select("node", F.explode("keys").alias("key"))
    shared = write_table(runs.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
                         .select("key", "low"), "shared-runs")
    ties = runs.join(shared, "key").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    clusters = components(ties).select(F.col("id").alias("node"), F.col("component").alias("cluster"))
    chosen = classes.select("node", F.col("rep").alias("c_id"), F.col("rep_v").alias("c_v")).join(clusters, "node")
    packed = pack(rows)
    texts = write_table(packed.join(chosen, packed["_id"].eqNullSafe(chosen["c_id"]) & (packed["_v"] == chosen["c_v"]))
                        .select("node", "cluster", "_z").dropDuplicates(["node"]), "cluster-texts")
    # written, so that the texts of a large cluster can be split
    sizes = write_table(texts.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count("*") / block_sets), F.ceil(F.sum(F.octet_length("_z")) / block_bytes)).alias("blocks")), "cluster-sizes")
    placed = write_table(texts.join(sizes, "cluster").select(
        "cluster", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.col("node").alias("id"), F.col("_z").alias("z")), "placed")
    cell = lambda *parts: F.concat_ws("-", "cluster", *parts)
    links = write_table(_links(placed.select(cell("block").alias("cell"), F.lit(0).alias("side"), "id", F.col("id").alias("label"), "z"),
                               width, percent).union(same_id), "near-links")
    large = write_table(placed.where("blocks > 1"), "large-clusters")
    if large.head(1):
        for with_first in (True, False):
            known = components(links)
            now = large.join(known, "id", "left").withColumn("label", F.coalesce("component", "id"))
            ranges = now.groupBy("cluster", "block").agg(F.min("label").alias("x"), F.max("label").alias("y"))
            a = ranges.select("cluster", F.col("block").alias("i"), F.col("x").alias("xi"), F.col("y").alias("yi"))
            b = ranges.select("cluster", F.col("block").alias("j"), F.col("x").alias("xj"), F.col("y").alias("yj"))
            pairs = (a.join(b, "cluster").where("i < j").where("i = 0" if with_first else "i > 0")
                     .where("not (xi = yi and xj = yj and xi = xj)"))
            both = pairs.select("cluster", "i", "j", F.explode(F.array(
                F.struct(F.lit(0).alias("side"), F.col("i").alias("block")), F.struct(F.lit(1).alias("side"), F.col("j").alias("block")))).alias("s"))
            cells = (both.select("cluster", cell("i", "j").alias("cell"), "s.side", "s.block").join(now, ["cluster", "block"])
                     .select("cell", "side", "id", "label", "z"))
            links = write_table(links.union(_links(cells, width, percent)), "near-links")
    final = components(links)
    # written, so that the classes of a large component can be split
    linked = write_table(classes.select("h1", "h2", "node", "rep").join(final, F.col("node") == F.col("id")).select(
        "h1", "h2", "rep", F.col("component").alias("group")), "linked")
    names = write_table(linked.groupBy("group").agg(F.min("rep").alias("name")), "names")
    renamed = linked.join(names, "group").select("h1", "h2", "name")
    named = write_table(classes.select("h1", "h2", "rep").join(renamed, ["h1", "h2"], "left").select(
        "h1", "h2", F.coalesce("name", "rep").alias("component")), "named")
    # documents without words have no class and stay out of the join
    out = every.where("n > 0").select("_id", "_v", "n", "h1", "h2").join(named, ["h1", "h2"]).select("_id", "_v", "n", "component")
    alone = every.where("n = 0").select("_id", "_v", "n", F.col("_id").alias("component"))
    return out.union(alone).select(F.col("_id").alias(id_col), "_v", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every near-duplicate group, the one with the smallest id, with all
    its columns, whatever their names. Rows without words (empty or null text) form no
    group and stay; so does each text without an id that links with no document that has
    one. Of rows with one id and one text one stays. An empty table stays empty."""
    found = near_duplicates(docs, id_col, text_col, **options)
    stay = write_table(found.where(F.col(id_col).eqNullSafe(F.col("component_id")) | (F.col("n_shingles") == 0))
                       .select(F.col(id_col).alias("stay_id"), F.col("_v").alias("stay_v")).distinct(), "kept-rows")
    given, text = docs[id_col].cast("long"), docs[text_col].cast("string")
    version = F.coalesce(F.when(given.isNull(), F.xxhash64(text)).otherwise(F.crc32(text)), F.lit(-1))
    rows = held(docs, rid=given, rv=version)
    kept = rows.join(stay, F.col("rid").eqNullSafe(F.col("stay_id")) & (F.col("rv") == F.col("stay_v")), "left_semi")
    return kept.dropDuplicates(["rid", "rv"]).select("row.*")
