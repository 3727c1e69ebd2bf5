"""Substring dedup over bytes by prefix-free parsing and suffix arrays.

Triggers: the position of the smallest rolling hash (of ``trigger`` bytes) in each
``window`` bytes. Triggers depend on content alone and stand at most
``window - trigger + 1`` bytes apart, so equal ``window``-byte strings are parsed
alike, wherever they stand. Windows that share a trigger occurrence form one parse
row (``Runs``); rows with equal bytes are one dictionary entry with a count.

1. Triggers that stand once in the corpus cannot carry a repeat and go.
2. A dictionary entry with several occurrences repeats as a whole.
3. Entries of one trigger with different contents (a family) are compared in corpus
   order: the suffix array of the dictionary sorts what stands left of the trigger
   (backwards), the suffix array of the parse sorts what follows it, and the longest
   common prefixes of neighbours in both give, for every window, the class of
   suffixes that share its ``window`` bytes. Families are dealt out over the tasks
   and compared byte by byte.
4. A family with more than ``family`` entries (a line of boilerplate in many
   documents) would be one large group; its windows are dealt out singly instead,
   by a 128-bit BLAKE2b digest of their bytes, and counted by a grouped sum. Same answer.

Rolling hashes only choose triggers and bring rows together. Entries are equal by a digest of
their bytes (64 bits of BLAKE2b, within one trigger hash), windows by comparison or digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.session import write_table
from llm._spark import keyed, pack, public_id, ship, small_batches, unpack
from llm._symbols import U64, Runs, blocks, byte_values, digests, mix, signed

WINDOW = 200
TRIGGER = 32
FAMILY = 8192  # entries of a window or two each: a few megabytes, the most that one task compares at once
CHUNK = 2000  # entries compared at once

_PARSE = "_id long, _v long, at long, anchor long, content long"
_ENTRY = "anchor long, hot boolean, many boolean, _id long, _v long, first long, n int, off int, bytes binary"
_MARKS = "_id long, _v long, first long, n long"


def _parse(docs: DataFrame, window: int, trigger: int) -> DataFrame:
    """Parse rows; ``at`` packs first byte, number of windows and offset of the trigger."""

    def work(batches):
        for b in batches:
            ids, vs = b.column(0).to_numpy(), b.column(1).to_numpy()
            for block in blocks(b.column(2)):
                r = Runs(byte_values(block), block.offsets, window, trigger)
                names, _ = digests(block.data, r.start, r.start + r.n - 1 + window)
                content = signed(mix(names.view(U64) ^ mix((r.n.astype(U64) << U64(32)) | (r.pos - r.start).astype(U64))))
                at = (r.first << 24) | (r.n << 12) | (r.pos - r.start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[block.rows][r.row], vs[block.rows][r.row], at, signed(r.anchor), content)],
                    ["_id", "_v", "at", "anchor", "content"])

    return docs.mapInArrow(work, _PARSE)


def _entries(packed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The bytes of dictionary entries, cut from one source document each."""
    lists = wanted.groupBy("_id", "_v").agg(F.collect_list(F.struct("at", "anchor", "hot", "many")).alias("parts"))
    # a repeated row gives its entries twice, which changes nothing: all of them have several occurrences

    def work(batches):
        for whole in batches:
            for b in small_batches(whole):
                for i, raw in enumerate(unpack(b.column(2))):
                    at, anchor, hot, many = (p.to_numpy(zero_copy_only=False) for p in b.column(3)[i].values.flatten())
                    first, n, off = at >> 24, (at >> 12) & 4095, at & 4095
                    cut = [raw[s:e] for s, e in zip(first.tolist(), (first + n - 1 + window).tolist())]
                    same = lambda k: pa.array(np.full(len(at), b.column(k)[i].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(hot), pa.array(many), same(0), same(1), pa.array(first),
                         pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(cut, pa.binary())],
                        ["anchor", "hot", "many", "_id", "_v", "first", "n", "off", "bytes"])

    return packed.join(lists, ["_id", "_v"]).select("_id", "_v", "_z", "parts").mapInArrow(work, _ENTRY)


def _order(strings: list[bytes], family: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the strings within their families: (order, common prefix
    with the one before; -1 at the first of a family)."""
    n = len(strings)
    text = np.array(strings, dtype=f"S{width}")
    length = np.array([len(s) for s in strings])
    order = np.lexsort((length, text, family))  # numpy pads with NUL: by length, an end sorts before a NUL
    grid = text.view(np.uint8).reshape(n, width)[order]
    same = np.ones((n, width + 1), dtype=bool)
    same[1:, :width] = grid[1:] == grid[:-1]
    same[:, width] = False
    common = np.zeros(n, dtype=np.int64)
    common[1:] = np.minimum(np.argmin(same[1:], 1), np.minimum(length[order][1:], length[order][:-1]))
    fam = family[order]
    common[np.concatenate([[True], fam[1:] != fam[:-1]])] = -1
    return order, common


def _classes(strings: list[bytes], family: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """(depth, string) -> class of the strings of one family with equal first ``depth`` bytes."""
    order, common = _order(strings, family, max(1, int(depths.max())))
    out = np.empty((len(depths), len(strings)), dtype=np.int64)
    out[:, order] = np.cumsum(common[None, :] < depths[:, None], axis=1)
    return out


def repeated_in_families(rows: list[tuple], window: int) -> list[np.ndarray]:
    """rows: (anchor, many, first, n, off, bytes) of whole families; for each row the
    window numbers (0 to n - 1) whose bytes also stand in another row or occurrence."""
    n, off = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    many, data = np.array([r[1] for r in rows]), [r[5] for r in rows]
    family = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
    depths = np.arange(int(off.max()) + 1)  # bytes of a window that stand left of the trigger
    left = _classes([d[:o][::-1] for d, o in zip(data, off.tolist())], family, depths)
    right = _classes([d[o:] for d, o in zip(data, off.tolist())], family, window - depths)
    depth, row = np.nonzero((depths[:, None] <= off) & (depths[:, None] > off - n))
    key = (depth * len(rows) + left[depth, row] - 1) * np.int64(len(rows)) + right[depth, row] - 1
    order = np.argsort(key, kind="stable")
    key, depth, row = key[order], depth[order], row[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    total = np.add.reduceat(1 + many[row].astype(np.int64), begin) if len(key) else begin
    again = np.repeat(total, np.diff(np.append(begin, len(key)))) > 1
    row, number = row[again], (off[row] - depth)[again]
    order = np.lexsort((number, row))
    row, number = row[order], number[order]
    return np.split(number, np.searchsorted(row, np.arange(1, len(rows))))


def _ranges(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted window numbers as (first, count) of consecutive series."""
    begin = np.flatnonzero(np.concatenate([[True], np.diff(numbers) != 1]))
    return numbers[begin], np.diff(np.append(begin, len(numbers)))


def _compare_families(entries: DataFrame, window: int) -> DataFrame:
    def marks(rows):
        out = [[], [], [], []]
        for r, numbers in zip(rows, repeated_in_families([x[:6] for x in rows], window)):
            if len(numbers) and not r[1]:  # entries with several occurrences repeat anyway
                first, count = _ranges(numbers)
                for k, v in enumerate((np.full(len(first), r[6]), np.full(len(first), r[7]), r[2] + first, count)):
                    out[k].append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], ["_id", "_v", "first", "n"])

    def work(batches):
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in ("anchor", "many", "first", "n", "off", "bytes", "_id", "_v"))):
                if len(held) >= CHUNK and row[0] != held[-1][0]:
                    yield from marks(held)
                    held = []
                held.append(row)
        if held:
            yield from marks(held)

    families = entries.where("not hot").drop("hot").repartition("anchor").sortWithinPartitions("anchor")
    return families.mapInArrow(work, _MARKS)


def _count_windows(entries: DataFrame, window: int) -> DataFrame:
    def work(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n = b.column("n").to_numpy()
            for block in blocks(b.column("bytes")):
                own = n[block.rows]
                part = np.repeat(np.arange(len(own)), own)
                j = np.arange(len(part)) - np.repeat(np.cumsum(own) - own, own)
                start = block.offsets[:-1][part] + j
                col = lambda k: b.column(k).to_numpy(zero_copy_only=False)[block.rows][part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*digests(block.data, start, start + window), col("many"), col("_id"), col("_v"), col("first") + j)],
                    ["h1", "h2", "many", "_id", "_v", "first"])

    hot = entries.where("hot").select("n", "bytes", "many", "_id", "_v", "first")
    windows = write_table(hot.mapInArrow(work, "h1 long, h2 long, many boolean, _id long, _v long, first long"), "hot-windows")
    again = write_table(windows.groupBy("h1", "h2").agg(F.sum(F.col("many").cast("int") + 1).alias("c"))
                        .where("c > 1").select("h1", "h2"), "hot-repeats")
    return windows.where("not many").join(again, ["h1", "h2"]).select("_id", "_v", "first", F.lit(1).cast("long").alias("n"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, trigger: int = TRIGGER, family: int = FAMILY) -> DataFrame:
    """``(_id, _v, first, n)`` for keyed documents: the ``window``-byte strings from
    byte ``first`` to ``first + n - 1`` each stand somewhere else too."""
    if not 0 < trigger < window < 4096:
        raise ValueError("0 < trigger < window < 4096")
    rows = _parse(docs, window, trigger)
    more = write_table(rows.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "triggers")
    rows = write_table(rows.join(more, "anchor").select("_id", "_v", "at", "anchor", "content"), "parse")
    words = write_table(rows.groupBy("anchor", "content").agg(F.count("*").alias("c"), F.min(F.struct("_id", "_v", "at")).alias("s"))
                        .select("anchor", "content", "s.*", (F.col("c") > 1).alias("many")), "dictionary")
    # aggregates that meet their own rows again are written first: both sides of the join are
    # then plain shuffles, and a hot trigger, entry or window can be split
    families = write_table(words.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1")
                           .select("anchor", (F.col("c") > family).alias("hot")), "families")
    entries = write_table(_entries(pack(docs),
                                   words.join(families, "anchor").select("_id", "_v", "at", "anchor", "hot", "many"), window), "entries")
    whole = (rows.join(words.where("many").select("anchor", "content"), ["anchor", "content"])
             .select("_id", "_v", F.shiftright("at", 24).alias("first"), F.expr("shiftright(at, 12) & 4095").alias("n")))
    return whole.union(_compare_families(entries, window)).union(_count_windows(entries, window))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 trigger: int = TRIGGER, family: int = FAMILY) -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that also starts anywhere
    else in the corpus, the same document included; strings are judged on the input
    and never cross documents.

    Returns one row per input row: ``(<id_col>, n_bytes, n_removed, spans, kept)``;
    ``spans`` are the maximal removed byte ranges (end exclusive), ``kept`` the other
    bytes. A null text is empty. Repeated rows are documents of their own and repeat
    each other; so do rows with a null id. Texts shorter than ``window`` bytes lose
    nothing. An empty table gives an empty result; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    removed = (repeated_windows(rows, window, trigger, family).groupBy("_id", "_v")
               .agg(F.collect_list(F.struct("first", "n")).alias("marks")))

    def work(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for b in small_batches(whole):
                out = []
                for i, raw in enumerate(unpack(b.column(1))):
                    raw = raw or b""
                    edge = np.zeros(len(raw) + 1, dtype=np.int64)
                    marks = b.column(2)[i]
                    if marks.is_valid:
                        first, n = (p.to_numpy() for p in marks.values.flatten())
                        np.add.at(edge, first, 1)
                        np.add.at(edge, first + n - 1 + window, -1)
                    dead = np.cumsum(edge[:-1]) > 0
                    step = np.diff(np.concatenate([[0], dead.astype(np.int8), [0]]))
                    spans = zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())
                    kept = np.frombuffer(raw, np.uint8)[~dead].tobytes()
                    out.append((len(raw), int(dead.sum()), [{"start": s, "end": e} for s, e in spans], kept))
                cols = list(zip(*out)) if out else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(3), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], span), pa.array(cols[3], pa.binary())],
                    ["_id", "_v", "n_bytes", "n_removed", "spans", "kept"])

    joined = pack(rows).join(removed, ["_id", "_v"], "left").select("_id", "_z", "marks", "_v")
    out = joined.mapInArrow(work, "_id long, _v long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(public_id(F.col("_id"), F.col("_v")).alias(id_col), "n_bytes", "n_removed", "spans", "kept")
