"""Pairs of users by blocks of left users: an item's list of raters is sent once to each block
that asks for it, and a pair, its rank and the targets that it answers never leave the block's task.

Two shuffles. The first puts the ratings (and the targets) of an item into one task, which sends
each block the lists of the items that its users rated or are asked for: a rater is an id in
byte planes and the code of his rating, some 4 bytes. No value computed from a user's mean or norm is sent with a
rater; each block gets the table of users once instead. The second shuffle holds one row per
sending task and block. A block's task then pairs a few hundred thousand ratings at a time (numpy).

An item that ``plan_join`` cuts is dealt out by its raters, and its parts go to every block. A block's
lists are bounded by ``ENTRIES``. What this does not suit goes the way of ``co_ratings``
(``block_plan``): few pairs, many users for their pairs, one user whose pairs exceed a block, more
than ``listed.MAX_STEPS`` distinct ratings.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.functions.columns import SIM_DIGITS, RatingScale
from kinship.operators.listed import Codes, rating_codes
from kinship.operators.skew import JoinPlan
from kinship.session import ship

ENTRIES = 32_000_000  # raters in the lists of a block, and the most pairs of one user
ROWS = 1_000_000  # ratings of a sending task
USERS = 100_000  # users of a row of the table of users
STEP = 500_000  # pairs that a block's task holds at a time
USER_SHARE = 4  # pairs for each row of the users that the blocks get, at least

_ROW = "block int, kind int, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, c5 binary"
_LISTS, _USERS = 0, 1
_HEAD = struct.Struct("<qqB")


@dataclass(frozen=True)
class BlockPlan:
    """``blocks`` of left users, filled by ``senders`` tasks; ``codes`` of the ratings; ``buckets`` of ``plan_join``."""

    blocks: int
    senders: int
    codes: Codes
    buckets: DataFrame | None


def block_plan(train: DataFrame, plan: JoinPlan, codes: Codes | None = None) -> BlockPlan | None:
    """The blocks of ``train``'s pairs (``plan``: its join with itself, dealt by user), or None where lists of
    raters by blocks do not suit. One job, for the ``codes`` of the ratings if they are not there."""
    if not plan.partitions or plan.reach > ENTRIES:
        return None
    spark = train.sparkSession
    blocks = max(math.ceil(plan.pairs / ENTRIES), min(plan.partitions, 2 * spark.sparkContext.defaultParallelism))
    if plan.pairs < USER_SHARE * blocks * plan.owners:
        return None
    codes = rating_codes(train) if codes is None else codes
    if codes is None or not all(v is None or math.isfinite(v) for v in codes.levels):
        return None
    senders = max(math.ceil(plan.rows / ROWS), min(plan.partitions, 2 * spark.sparkContext.defaultParallelism))
    ship(spark)
    return BlockPlan(blocks, senders, codes, plan.buckets)


def _packed(values: np.ndarray) -> bytes:
    """Longs less their smallest one, in as many byte planes as the largest needs."""
    if not len(values):
        return b""
    low = int(values.min())
    rest = (values - low).view(np.uint64)
    width = (int(rest.max()).bit_length() + 7) // 8
    return _HEAD.pack(low, len(values), width) + rest.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(data) -> np.ndarray:
    if not len(data):
        return np.empty(0, np.int64)
    low, n, width = _HEAD.unpack_from(data)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :width] = np.frombuffer(data, np.uint8, n * width, _HEAD.size).reshape(width, n).T
    return rest.reshape(-1).view(np.int64) + low


def _block_of(users: np.ndarray, blocks: int) -> np.ndarray:
    mixed = users.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def _row(block: int, kind: int, *parts: bytes) -> pa.RecordBatch:
    parts = [*parts, *[b""] * (6 - len(parts))]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([kind], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]],
        ["block", "kind", *[f"c{i}" for i in range(6)]])


def _numbers(batches: list[pa.RecordBatch], column: int, kind: type) -> np.ndarray:
    """A column of all batches; null as NaN in one of doubles."""
    return np.concatenate([b.column(column).to_numpy(zero_copy_only=False).astype(kind) for b in batches])


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of all entries of the lists."""
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _send_lists(blocks: int, lower: bool) -> Callable:
    """Rows ``(item, user, code, cut)``, a target's code being -1: the lists of raters for each block.
    ``lower``: a block needs the raters up to the last one of its own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        item, user, code, cut = (_numbers(batches, n, kind) for n, kind in enumerate((np.int64, np.int64, np.int16, np.bool_)))
        batches.clear()
        asked = code < 0
        asked_item, asked_user = item[asked], user[asked]
        item, user, code, cut = (x[~asked] for x in (item, user, code, cut))
        order = np.lexsort((user, item))
        item, user, code, cut = item[order], user[order], code[order].astype(np.uint8), cut[order]
        starts, lens = _runs(item)
        items, cut, n = item[starts], cut[starts], max(1, len(starts))
        own = _block_of(user, blocks) * n + np.repeat(np.arange(len(starts)), lens)
        every = (np.arange(blocks)[:, None] * n + np.flatnonzero(cut)).reshape(-1)
        if lower:
            order = np.argsort(own, kind="stable")
            first, times = _runs(own[order])
            last = order[first + times - 1]
            keys, ends = own[last], last - starts[own[last] % n] + 1
            keep = ~cut[keys % n]
            keys, ends = np.concatenate([keys[keep], every]), np.concatenate([ends[keep], lens[every % n]])
            order = np.argsort(keys, kind="stable")
            keys, ends = keys[order], ends[order]
        else:
            place = np.minimum(np.searchsorted(items, asked_item), n - 1)
            rated = items[place] == asked_item if len(items) else np.zeros(len(asked_item), bool)
            keys = np.unique(np.concatenate([own, (_block_of(asked_user, blocks) * n + place)[rated], every]))
            ends = lens[keys % n]
        bounds = np.searchsorted(keys, np.arange(blocks + 1) * n)
        to = _block_of(asked_user, blocks)
        order = np.argsort(to, kind="stable")
        asked_item, asked_user, to = asked_item[order], asked_user[order], np.searchsorted(to[order], np.arange(blocks + 1))
        for b in range(blocks):
            lists, took = keys[bounds[b]:bounds[b + 1]] % n, ends[bounds[b]:bounds[b + 1]]
            wanted = slice(to[b], to[b + 1])
            if len(lists) or wanted.start < wanted.stop:
                at = _spread(starts[lists], took)
                yield _row(b, _LISTS, _packed(items[lists]), _packed(took), _packed(user[at]), code[at].tobytes(),
                           _packed(asked_item[wanted]), _packed(asked_user[wanted]))

    return work


def _send_users(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(user, n_ratings, sum_rating, norm)`` in planes; every block gets them."""
    batches = [b for b in batches if b.num_rows]
    if batches:
        user, count = (_numbers(batches, n, np.int64) for n in (0, 1))
        total, norm = (_numbers(batches, n, np.float64) for n in (2, 3))
        for i in range(0, len(user), USERS):
            s = slice(i, i + USERS)
            yield _row(0, _USERS, _packed(user[s]), _packed(count[s]), _packed(total[s].view(np.int64)), _packed(norm[s].view(np.int64)))


def _sent(train: DataFrame, users: DataFrame, plan: BlockPlan, targets: DataFrame | None, lower: bool) -> DataFrame:
    """What every block's task reads, dealt out by block."""
    known = "user is not null and item is not null"
    item = F.col("item").cast("long").alias("item")
    rows = train.where(known).select(item, "user", plan.codes.of("rating").cast("short").alias("code"))
    if targets is not None:
        rows = rows.unionByName(targets.where(known).select(item, "user", F.lit(-1).cast("short").alias("code")))
    if plan.buckets is None:
        rows = rows.withColumn("cut", F.lit(False)).repartition(plan.senders, "item")
    else:
        parts = F.coalesce("_right", F.lit(1)).cast("long")
        rows = rows.join(plan.buckets.select(item, "_right"), "item", "left").select(
            "item", "user", "code", (parts > 1).alias("cut"), F.pmod(F.xxhash64("user"), parts).alias("_part")).repartition(
            plan.senders, "item", "_part").drop("_part")
    double = lambda c: (F.col(c) if c in users.columns else F.lit(None)).cast("double").alias(c)
    table = users.where("user is not null").select("user", "n_ratings", double("sum_rating"), double("norm")).mapInArrow(_send_users, _ROW)
    copies = F.explode(F.sequence(F.lit(0), F.lit(plan.blocks - 1))).alias("block")
    every = table.select(copies, *[c for c in table.columns if c != "block"])
    return rows.mapInArrow(_send_lists(plan.blocks, lower), _ROW).unionByName(every).repartitionById(plan.blocks, F.col("block"))


@dataclass
class _Block:
    """The users (sorted, with their values), the lists of raters (places in the users, codes), and the ratings
    of the block's own users and the targets asked for (each with its number of rows), by ``left``: places in ``lefts``,
    which are places in the users."""

    ids: np.ndarray
    count: np.ndarray
    mean: np.ndarray
    norm: np.ndarray
    items: np.ndarray
    starts: np.ndarray
    lens: np.ndarray
    rater: np.ndarray
    code: np.ndarray
    lefts: np.ndarray
    own_left: np.ndarray
    own_list: np.ndarray
    own_at: np.ndarray
    asked_left: np.ndarray
    asked_list: np.ndarray
    asked_times: np.ndarray


def _places(ids: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Finds ids in the sorted ``ids``; -1 where they are not."""
    low, high = int(ids[0]), int(ids[-1])
    if high - low < 4 * len(ids) + ROWS:
        table = np.full(high - low + 1, -1, np.int32)
        table[ids - low] = np.arange(len(ids), dtype=np.int32)
        return lambda x: np.where((x >= low) & (x <= high), table[np.clip(x, low, high) - low], -1)

    def search(x: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(ids, x), len(ids) - 1)
        return np.where(ids[at] == x, at, -1).astype(np.int32)

    return search


def _received(batches: Iterator[pa.RecordBatch], blocks: int) -> _Block | None:
    lists, users, block, b, parts = [], [], None, None, None
    for b in batches:
        for i in range(b.num_rows):
            parts = [b.column(f"c{c}")[i].as_buffer() for c in range(6)]
            if b.column("kind")[i].as_py() == _USERS:
                users.append(parts[:4])
            else:
                block = b.column("block")[i].as_py()
                lists.append(parts)
    if not lists or not users:
        return None
    del b, parts  # the last batch is not held beside what is read from it
    column = lambda n: np.concatenate([_unpacked(p[n]) for p in users])
    ids = column(0)
    order = np.argsort(ids)
    ids, count, norm = ids[order], column(1)[order], column(3)[order].view(np.float64)
    mean = column(2)[order].view(np.float64) / count
    users.clear()
    place = _places(ids)
    items, lens = (np.concatenate([_unpacked(p[n]) for p in lists]) for n in (0, 1))
    rater, code = np.empty(int(lens.sum()), np.int32), np.empty(int(lens.sum()), np.uint8)
    at = 0
    for p in lists:
        some = place(_unpacked(p[2]))
        rater[at:at + len(some)] = some
        code[at:at + len(some)] = np.frombuffer(p[3], np.uint8) if len(some) else []
        at += len(some)
    asked_item, asked_user = (np.concatenate([_unpacked(p[n]) for p in lists]) for n in (4, 5))
    lists.clear()
    starts = np.cumsum(lens) - lens
    order = np.argsort(items, kind="stable")
    first, times = _runs(items[order])
    if len(first) < len(items):  # the parts of an item that was cut become one list
        at = _spread(starts[order], lens[order])
        rater, code = rater[at], code[at]
        items, lens = items[order][first], np.add.reduceat(lens[order], first)
        starts, order = np.cumsum(lens) - lens, np.arange(len(items))
    mine = _block_of(ids, blocks) == block
    own_at = np.flatnonzero(mine[rater])
    if not len(own_at):
        return None
    own_list = np.searchsorted(starts, own_at, side="right") - 1
    lefts, own_left = np.unique(rater[own_at], return_inverse=True)
    by_left = np.argsort(own_left, kind="stable")
    asked_user = place(asked_user)
    left = np.minimum(np.searchsorted(lefts, asked_user), len(lefts) - 1)
    found = np.minimum(np.searchsorted(items[order], asked_item), len(items) - 1)
    asked = order[found]
    known = (lefts[left] == asked_user) & (items[asked] == asked_item)
    wanted, times = np.unique(left[known] * len(items) + asked[known], return_counts=True)
    return _Block(ids, count, mean, norm, items, starts, lens, rater, code, lefts,
                  own_left[by_left], own_list[by_left], own_at[by_left], wanted // len(items), wanted % len(items), times)


def _steps(costs: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows that cost no more than ``most`` together, or one row that costs more."""
    ends, out, at = np.cumsum(costs), [], 0
    while at < len(costs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        out.append((at, to))
        at = to
    return out


def _sorted(keys: np.ndarray) -> np.ndarray:
    """The order of non-negative keys, equal ones as they stand: keys and places are sorted as one number if it holds both."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits <= 63:
        both = (keys << bits) | np.arange(len(keys))
        both.sort()
        return both & ((1 << bits) - 1)
    return np.argsort(keys, kind="stable")


def _grouped(keys: np.ndarray, count: np.ndarray | None, dot: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct keys with the sums of ``count`` (1 each if None) and ``dot``."""
    order = _sorted(keys)
    keys = keys[order]
    first, times = _runs(keys)
    if count is not None:
        times = np.add.reduceat(count[order], first) if len(first) else count
    if dot is not None:
        dot = np.add.reduceat(dot[order], first) if len(first) else dot
    return keys[first], times, dot


def _deviation(block: _Block, at: np.ndarray, levels: np.ndarray, bounds: RatingScale) -> np.ndarray:
    """``functions.columns.deviation`` of the raters at ``at``; 0 for an unknown rating or mean."""
    rating, mean = levels[block.code[at]], block.mean[block.rater[at]]
    room = np.where(rating > mean, bounds.hi - mean, np.where(rating < mean, mean - bounds.lo, 1.0))
    if not room.all():
        raise ZeroDivisionError("a rating lies outside its scale")
    dev = (rating - mean) / room
    return np.where(np.isnan(dev), 0.0, dev)


def _unit(block: _Block, at: np.ndarray, levels: np.ndarray, bounds: RatingScale) -> np.ndarray:
    norm = block.norm[block.rater[at]]
    return np.where(norm > 0.0, _deviation(block, at, levels, bounds) / np.where(norm > 0.0, norm, 1.0), 0.0)


def _tidy(x: np.ndarray) -> np.ndarray:
    """``functions.columns.tidy`` to ``SIM_DIGITS``."""
    m = float(10**SIM_DIGITS)
    scaled = np.abs(x) * m
    return np.where(scaled < float(2**52), np.sign(x) * np.floor(scaled + 0.5) / m, x) + 0.0


def _pairs(block: _Block, levels: np.ndarray, bounds: RatingScale, cosine: bool, lower: bool) -> Iterator[tuple]:
    """``(first left, next left, keys, overlap, dot)``: the pairs of some lefts, sorted by ``key`` = left * users + neighbour."""
    n = len(block.ids)
    costs = block.lens[block.own_list]
    first, times = _runs(block.own_left)
    unit = _unit(block, block.own_at, levels, bounds) if cosine else None
    for a, b in _steps(np.add.reduceat(costs, first), STEP):
        keys = overlap = dot = None
        begin, end = first[a], first[b - 1] + times[b - 1]
        for c, d in _steps(costs[begin:end], STEP):  # several only for a single left
            rows = slice(begin + c, begin + d)
            lens = costs[rows]
            at = _spread(block.starts[block.own_list[rows]], lens)
            left, other = np.repeat(block.own_left[rows], lens), block.rater[at]
            keep = other < block.lefts[left] if lower else other != block.lefts[left]
            some = (left * n + other)[keep]
            product = (np.repeat(unit[rows], lens) * _unit(block, at, levels, bounds))[keep] if cosine else None
            if keys is None:
                keys, overlap, dot = _grouped(some, None, product)
            else:
                some, more, product = _grouped(some, None, product)
                keys, overlap, dot = _grouped(
                    np.concatenate([keys, some]), np.concatenate([overlap, more]), np.concatenate([dot, product]) if cosine else None)
        yield a, b, keys, overlap, dot


def _similar(block: _Block, levels: np.ndarray, bounds: RatingScale, *metrics: str) -> Iterator[tuple]:
    """``(first left, next left, keys, similarity, ...)`` of the pairs with a similarity other than 0."""
    n = len(block.ids)
    for a, b, keys, overlap, dot in _pairs(block, levels, bounds, "cosine" in metrics, False):
        sims = []
        for metric in metrics:
            if metric == "cosine":
                sims.append(_tidy(dot))
            else:
                union = block.count[block.lefts[keys // n]] + block.count[keys % n] - overlap
                sims.append(_tidy(np.where(union != 0, overlap / np.where(union != 0, union, 1), 0.0)))
        keep = np.any([sim != 0.0 for sim in sims], axis=0)
        yield a, b, keys[keep], *[sim[keep] for sim in sims]


def _asked(block: _Block, begin: int, end: int, keys: np.ndarray) -> Iterator[tuple]:
    """``(first target, next target, target, pair, rater)``: the raters of the targets ``begin`` to ``end`` whose pair
    with the target's user is among ``keys``, by places in the targets, in ``keys`` and in the lists."""
    n = len(block.ids)
    costs = block.lens[block.asked_list[begin:end]]
    for c, d in _steps(costs, STEP):
        lens = costs[c:d]
        at = _spread(block.starts[block.asked_list[begin + c:begin + d]], lens)
        pair = np.repeat(block.asked_left[begin + c:begin + d], lens) * n + block.rater[at]
        found = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        met = np.flatnonzero(keys[found] == pair)
        yield c, d, np.repeat(np.arange(d - c), lens)[met], found[met], at[met]


def _ranks(left: np.ndarray, sim: np.ndarray, n_users: int) -> np.ndarray:
    """The ranks of ``neighbors.ranked_all``, for rows sorted by left and neighbour."""
    top = float(2**41 - 1) / 10**SIM_DIGITS
    if len(sim) and np.abs(sim).max() < top:
        order = _sorted(2**41 - np.rint(sim * 10**SIM_DIGITS).astype(np.int64))
    else:
        order = np.argsort(-sim, kind="stable")
    order = order[_sorted(left[order])]
    first, times = _runs(left[order])
    rank = np.empty(len(sim), np.int64)
    rank[order] = np.arange(len(sim)) - np.repeat(first, times) + 1 + np.where(sim[order] < 0.0, n_users - 1 - np.repeat(times, times), 0)
    return rank


def _levels(codes: Codes) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in codes.levels], np.float64)


def block_pairs(train: DataFrame, users: DataFrame, plan: BlockPlan, columns: Sequence[str], bounds: RatingScale) -> DataFrame:
    """``co_ratings`` of all users (``user > neighbour``): ``(user, neighbour, overlap)``, with ``dot`` if ``columns``
    have ``ndev`` and the counts if they have ``n_ratings``."""
    blocks, levels, cosine, counts = plan.blocks, _levels(plan.codes), "ndev" in columns, "n_ratings" in columns
    names = ["user", "neighbour", "overlap", *["dot"] * cosine, *["n_user", "n_neighbour"] * counts]

    def work(batches):
        block = _received(batches, blocks)
        if block is None:
            return
        n = len(block.ids)
        for _, _, keys, overlap, dot in _pairs(block, levels, bounds, cosine, True):
            user, other = block.lefts[keys // n], keys % n
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                block.ids[user], block.ids[other], overlap.astype(np.int64), *[dot] * cosine,
                *[block.count[x] for x in (user, other)] * counts)], names)

    kinds = {"dot": "double"}
    return _sent(train, users, plan, None, True).mapInArrow(work, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names))


def block_ranks(train: DataFrame, users: DataFrame, plan: BlockPlan, metric: str, k: int, bounds: RatingScale) -> DataFrame:
    """``neighbors`` of all users: ``(user, neighbour, sim, rank)`` for ranks up to ``k``."""
    blocks, levels = plan.blocks, _levels(plan.codes)

    def work(batches):
        block = _received(batches, blocks)
        if block is None:
            return
        n = len(block.ids)
        for _, _, keys, sim in _similar(block, levels, bounds, metric):
            left = keys // n
            rank = _ranks(left, sim, n)
            keep = rank <= k
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (
                block.ids[block.lefts[left]], block.ids[keys % n], sim, rank)], ["user", "neighbour", "sim", "rank"])

    return _sent(train, users, plan, None, False).mapInArrow(work, "user long, neighbour long, sim double, rank long")


def block_ratios(train: DataFrame, targets: DataFrame, users: DataFrame, plan: BlockPlan, metric: str, ks: Sequence[int],
                 bounds: RatingScale, everyone: bool = False) -> DataFrame:
    """``(user, item, w, w_<k>, ...)``: the weighted deviation of the targets over their ``k`` nearest neighbours,
    ``w`` over the largest ``k`` or over all of them (``everyone``). Targets without such a neighbour are left out."""
    blocks, levels, ks = plan.blocks, _levels(plan.codes), list(ks)
    names = ["user", "item", "w", *[f"w_{k}" for k in ks]]
    cuts = np.array(ks, np.int64)

    def work(batches):
        block = _received(batches, blocks)
        if block is None:
            return
        n, wide = len(block.ids), len(ks) + 1
        for a, b, keys, sim in _similar(block, levels, bounds, metric):
            begin, end = np.searchsorted(block.asked_left, [a, b])
            if begin == end or not len(keys):
                continue
            group = np.searchsorted(cuts, _ranks(keys // n, sim, n))  # the first k that holds the rank
            num, den = np.zeros((end - begin, wide)), np.zeros((end - begin, wide))
            for c, d, target, pair, at in _asked(block, begin, end, keys):
                cell = target * wide + group[pair]
                weight = sim[pair]
                dev = _deviation(block, at, levels, bounds)
                num[c:d] += np.bincount(cell, dev * weight, (d - c) * wide).reshape(-1, wide)
                den[c:d] += np.bincount(cell, np.abs(weight), (d - c) * wide).reshape(-1, wide)
            num, den = np.cumsum(num, axis=1), np.cumsum(den, axis=1)
            ratio = np.where(den > 0.0, num / np.where(den > 0.0, den, 1.0), 0.0)
            most = wide - 1 if everyone else wide - 2
            keep = den[:, most] > 0.0
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[keep])) for x in (
                block.ids[block.lefts[block.asked_left[begin:end]]], block.items[block.asked_list[begin:end]],
                ratio[:, most], *[ratio[:, i] for i in range(len(ks))])], names)

    return _sent(train, users, plan, targets, False).mapInArrow(
        work, ", ".join(f"{c} {'long' if c in ('user', 'item') else 'double'}" for c in names))


def block_sums(train: DataFrame, targets: DataFrame, users: DataFrame, plan: BlockPlan, metrics: Sequence[str], bounds: RatingScale) -> DataFrame:
    """``listed.listed_sums``: ``(user, item, num_<metric>, den_<metric>, ...)`` of the targets over all users."""
    blocks, levels, metrics = plan.blocks, _levels(plan.codes), list(metrics)
    names = ["user", "item", *[f"{part}_{m}" for m in metrics for part in ("num", "den")]]

    def work(batches):
        block = _received(batches, blocks)
        if block is None:
            return
        for a, b, keys, *sims in _similar(block, levels, bounds, *metrics):
            begin, end = np.searchsorted(block.asked_left, [a, b])
            if begin == end or not len(keys):
                continue
            sums = [np.zeros(end - begin) for _ in names[2:]]
            for c, d, target, pair, at in _asked(block, begin, end, keys):
                dev = _deviation(block, at, levels, bounds)
                for i, sim in enumerate(sims):
                    sums[2 * i][c:d] += np.bincount(target, dev * sim[pair], d - c)
                    sums[2 * i + 1][c:d] += np.bincount(target, np.abs(sim[pair]), d - c)
            keep = np.any([den > 0.0 for den in sums[1::2]], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (
                block.ids[block.lefts[block.asked_left[begin:end]]], block.items[block.asked_list[begin:end]], *[x * block.asked_times[begin:end] for x in sums])], names)

    return _sent(train, users, plan, targets, False).mapInArrow(
        work, ", ".join(f"{c} {'long' if c in ('user', 'item') else 'double'}" for c in names))
