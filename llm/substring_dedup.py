"""Substring dedup over words by a compacted De Bruijn graph.

An edge is a k-mer of ``window`` consecutive words; a node is its first or last
``window - 1`` words. Edges are never stored one by one: consecutive edges that
share a minimiser (the ``anchor``-word substring with the smallest hash) form one
path row (``Runs``), about one row per twenty words. Then, by joins:

1. paths whose minimiser stands once in the corpus cannot repeat and go;
2. paths of one minimiser with one content do not branch: all their edges have
   the same documents, the smallest of which is the source, so the path stays
   compact;
3. where contents of a minimiser differ, the graph branches there: one copy of
   each content is cut into its edges, read again at its source coordinate, and
   every edge finds its smallest document;
4. each occurrence of a path is compared with its edges' sources, and the words
   under repeated edges are removed.

Paths and edges are told apart by 128-bit BLAKE2b digests of their words, those of edges
taken from the source text again. Work and rows grow with the words; a hot edge or path
is aggregated before it is shuffled, and the aggregate is written, so that it meets its
occurrences in a join of two plain shuffles, which the adaptive planner may split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.session import write_table
from llm._spark import keyed, pack, public_id, ship, small_batches, unpack
from llm._symbols import Runs, Words, blocks, signed

WINDOW = 50
ANCHOR = 10

_PATHS = "_id long, _v long, first int, n int, anchor long, c1 long, c2 long"
_EDGES = "path long, j int, e1 long, e2 long, _id long"
_CONTENT = ("anchor", "c1", "c2")


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(_id, anchor) of every path, without the digests that most paths never need."""

    def work(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for block in blocks(b.column(2)):
                words = Words(block)
                r = Runs(words.hash, words.offsets, window, anchor)
                yield pa.RecordBatch.from_arrays([pa.array(ids[block.rows][r.row]), pa.array(signed(r.anchor))], ["_id", "anchor"])

    return docs.mapInArrow(work, "_id long, anchor long")


def _paths(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def work(batches):
        for b in batches:
            ids, vs = b.column(0).to_numpy(), b.column(1).to_numpy()
            for block in blocks(b.column(2)):
                words = Words(block)
                r = Runs(words.hash, words.offsets, window, anchor)
                c1, c2 = words.digests(r.start, r.start + r.n - 1 + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[block.rows][r.row], vs[block.rows][r.row], r.first.astype(np.int32),
                                           r.n.astype(np.int32), signed(r.anchor), c1, c2)],
                    ["_id", "_v", "first", "n", "anchor", "c1", "c2"])

    return docs.mapInArrow(work, _PATHS)


def _cut(packed: DataFrame, paths: DataFrame, window: int) -> DataFrame:
    """The edges of branching paths, from the source document's text. ``paths``:
    (_id, _v, first, n, path), one row per content."""
    lists = paths.groupBy("_id", "_v").agg(F.collect_list(F.struct("first", "n", "path")).alias("parts"))

    def work(batches):
        for whole in batches:
            for b in small_batches(whole):
                for i, text in enumerate(unpack(b.column(1))):
                    first, n, path = (p.to_numpy().astype(np.int64) for p in b.column(2)[i].values.flatten())
                    words = Words(next(blocks(pa.array([text], pa.binary()))))
                    part = np.repeat(np.arange(len(n)), n)
                    j = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
                    start = first[part] + j
                    # two paths of one text may share edges
                    own, back = np.unique(start, return_inverse=True)
                    e1, e2 = (e[back] for e in words.digests(own, own + window))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (path[part], j.astype(np.int32), e1, e2, np.full(len(part), b.column(0)[i].as_py(), np.int64))],
                        ["path", "j", "e1", "e2", "_id"])

    joined = packed.join(lists, ["_id", "_v"]).select("_id", "_z", "parts")
    # a repeated row with the same id and text would give the same edges again, which min() absorbs
    return joined.mapInArrow(work, _EDGES)


def repeated_edges(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(_id, _v, first, mask)`` for keyed documents: bit j of ``mask`` says that
    the ``window`` words from word ``first + j`` also start in a smaller ``_id``."""
    if not 0 <= window - anchor <= 62:
        raise ValueError("a path holds at most 63 edges: choose anchor >= window - 62")
    # every aggregate that meets its own rows again is written first: both sides of the join
    # are then plain shuffles, and a hot key can be split
    more = write_table(_anchors(docs, window, anchor).groupBy("anchor").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
                       .where("lo < hi").select("anchor"), "anchors")
    paths = write_table(_paths(docs, window, anchor).join(more, "anchor").select("_id", "_v", "first", "n", *_CONTENT), "paths")

    contents = write_table(
        paths.groupBy(*_CONTENT).agg(F.min(F.struct("_id", "_v", "first", "n")).alias("src"), F.max("_id").alias("hi"))
        .select(*_CONTENT, "src.*", "hi", F.monotonically_increasing_id().alias("path")), "contents")
    branching = write_table(contents.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "branching")
    cut = _cut(pack(docs), contents.join(branching, "anchor").select("_id", "_v", "first", "n", "path"), window)
    edges = write_table(cut, "edges")
    source = write_table(edges.groupBy("e1", "e2").agg(F.min("_id").alias("low"), F.max("_id").alias("hi"))
                         .where("low < hi").select("e1", "e2", "low"), "shared-edges")
    # the edges of a path that a document before its source has
    lows = (edges.join(source, ["e1", "e2"]).where("low < _id").groupBy("path", "j").agg(F.min("low").alias("low"))
            .groupBy("path").agg(F.collect_list(F.struct("j", "low")).alias("lows")))
    known = write_table(contents.join(lows, "path", "left").select(*_CONTENT, F.col("_id").alias("src"), "hi", "lows")
                        .where("lows is not null or hi > src").drop("hi"), "known-paths")
    mask = F.expr(
        "IF(src < _id, shiftleft(1L, n) - 1, "
        "aggregate(coalesce(lows, array()), 0L, (m, e) -> m | IF(e.low < _id, shiftleft(1L, e.j), 0L)))")
    return (paths.join(known, list(_CONTENT)).select("_id", "_v", "first", mask.alias("mask"))
            .where("mask <> 0"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Remove every word covered by ``window`` consecutive words that also start in
    a document with a smaller id; windows are judged on the input.

    Returns one row per input row: ``(<id_col>, n_words, n_removed, spans,
    kept_text)``; ``spans`` are the removed word ranges ``(start, end)`` (maximal,
    end exclusive), ``kept_text`` the other words joined by one space.

    Null text reads as empty (no words). A null id counts as the largest long, and
    comes back as null. Rows with the same id never remove from each other. A document
    shorter than ``window`` words loses nothing. An empty table gives an empty
    result; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    removed = (repeated_edges(rows, window, anchor).groupBy("_id", "_v")
               .agg(F.collect_list(F.struct("first", "mask")).alias("marks")))

    def work(batches):
        for whole in batches:
            for b in small_batches(whole):
                texts = unpack(b.column(1))
                out = []
                for i, text in enumerate(texts):
                    block = next(blocks(pa.array([text or b""], pa.binary())))
                    words = Words(block)
                    n = len(words.start)
                    marks = b.column(2)[i]
                    gone = np.zeros(n + 1, dtype=np.int64)
                    if marks.is_valid:
                        first, mask = (p.to_numpy() for p in marks.values.flatten())
                        bits = (mask[:, None] >> np.arange(63)) & 1
                        r, j = np.nonzero(bits)
                        starts = first[r] + j
                        np.add.at(gone, starts, 1)
                        np.add.at(gone, starts + window, -1)
                    dead = np.cumsum(gone[:n]) > 0
                    step = np.diff(np.concatenate([[0], dead.astype(np.int8), [0]]))
                    spans = np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], 1)
                    raw = text or b""
                    keep = np.flatnonzero(~dead)
                    kept = b" ".join(raw[s:e] for s, e in zip(words.start[keep].tolist(), words.end[keep].tolist()))
                    out.append((n, int(dead.sum()), [{"start": int(s), "end": int(e)} for s, e in spans], kept.decode()))
                cols = list(zip(*out)) if out else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(3), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(cols[3], pa.string())],
                    ["_id", "_v", "n_words", "n_removed", "spans", "kept_text"])

    joined = pack(rows).join(removed, ["_id", "_v"], "left").select("_id", "_z", "marks", "_v")
    out = joined.mapInArrow(work, "_id long, _v long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string")
    return out.select(public_id(F.col("_id"), F.col("_v")).alias(id_col), "n_words", "n_removed", "spans", "kept_text")
