"""Vectorised text helpers shared by the text operators: words, rolling hashes,
windows grouped by their anchor. Pure numpy over one small block of rows; Spark
does the partitioning, the shuffles and the joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xD1B54A32D192ED03
BLOCK_BYTES = 1 << 19  # numpy works on blocks of about this many text bytes
POSITION_BITS = 24  # low bits of a key that hold its position in sliding_argmin

_pows: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (base is odd)."""
    have = _pows.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            a = np.full(size, b, dtype=U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = _pows[base] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64))


class Rolling:
    """Polynomial hash of any range of symbols in O(1), from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int = BASE_A):
        n = len(values)
        pow_, self.inv = _powers(base, n + 1)
        self.prefix = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * pow_[:n], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inv[start]

    def all(self, length: int) -> np.ndarray:
        """The hash of the range of this length at every start."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.empty(0, dtype=U64)
        return (self.prefix[length:] - self.prefix[:n]) * self.inv[:n]


class Block:
    """Some whole rows: the text bytes one after another, and where each row ends."""

    def __init__(self, rows: slice, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Split a string or binary Arrow column into blocks of whole rows (a null
    reads as empty; a row longer than ``max_bytes`` is a block of its own)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1)
        j = min(j, n)
        yield Block(slice(i, j), raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


SHORT = 15  # bytes of a word that its code holds as they are
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of every word, as two arrays. Words of up to ``SHORT`` bytes have different
    codes exactly where they differ (the bytes and their number, through a bijection of
    128 bits); a longer word is known by 120 bits of its BLAKE2b digest."""
    size = end - start
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray((len(data) + 9,), dtype="<u8", buffer=padded, strides=(1,))  # the 8 bytes from every byte on
    low = eight[start] & _LOW_BYTES[np.minimum(size, 8)]
    high = eight[start + 8] & _LOW_BYTES[np.clip(size - 8, 0, 7)]
    high |= np.minimum(size, 255).astype(U64) << U64(56)
    long = np.flatnonzero(size > SHORT)
    if len(long):
        raw = data.tobytes()
        digests = b"".join(blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(start[long].tolist(), end[long].tolist()))
        halves = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
        low[long] = halves[:, 0]
        high[long] = (halves[:, 1] & _LOW_BYTES[7]) | U64(255 << 56)
    a = mix(low ^ mix(high))
    return a, mix(high ^ mix(a ^ U64(BASE_B)))


def digests(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of a 128-bit BLAKE2b digest of every range of symbols (rows of an array)."""
    raw, size = memoryview(symbols.tobytes()), symbols[:1].nbytes
    out = b"".join(blake2b(raw[s:e], digest_size=16).digest() for s, e in zip((start * size).tolist(), (end * size).tolist()))
    halves = np.frombuffer(out, dtype="<i8").reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


class Words:
    """The words (maximal runs of non-separator bytes) of a block, and their codes."""

    def __init__(self, block: Block, lower: bool = False):
        data = _LOWER[block.data] if lower else block.data
        n = len(data)
        inside = np.zeros(n + 1, dtype=bool)
        np.logical_not(_SEP[data], out=inside[:n])
        first = np.zeros(n + 1, dtype=bool)
        first[block.offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:]
        ends = inside[:-1] & (~inside[1:] | first[1:])
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(ends) + 1
        self.hash, self.hash2 = word_codes(data, self.start, self.end)
        #: word index where each row begins, and one past the last row
        self.offsets = np.searchsorted(self.start, block.offsets)

    def digests(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that name the words from ``start`` to ``end``: a BLAKE2b digest of their codes."""
        return digests(np.stack([self.hash, self.hash2], 1), start, end)

    def _rolls(self) -> tuple[Rolling, Rolling]:
        return Rolling(self.hash, BASE_B), Rolling(self.hash2, BASE_A)

    def windows(self, width: int) -> np.ndarray:
        """A hash of the ``width`` words from every word on, across row ends as well."""
        a, b = (roll.all(width) for roll in self._rolls())
        return mix(a ^ mix(b))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of ``width`` words, rows in order. A row with
        fewer words gives its whole sequence as one shingle, an empty row none."""
        counts = np.diff(self.offsets)
        hashes = self.windows(width)
        row_of = np.repeat(np.arange(len(counts)), counts)
        pos = np.arange(len(row_of))
        ok = pos + width <= self.offsets[1:][row_of]
        rows, values = row_of[ok], hashes[np.flatnonzero(ok)]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            a, b = (roll(self.offsets[:-1][short], self.offsets[1:][short]) for roll in self._rolls())
            whole = mix(a ^ mix(b + counts[short].astype(U64) * U64(BASE_A)))
            rows, values = np.concatenate([rows, short]), np.concatenate([values, whole])
            order = np.argsort(rows, kind="stable")
            rows, values = rows[order], values[order]
        return rows, values


def byte_values(block: Block) -> np.ndarray:
    return _BYTE_VALUES[block.data]


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of every ``width`` consecutive keys (leftmost of
    equals on the bits above ``POSITION_BITS``). More keys than these bits can number
    are taken in segments that overlap by ``width - 1`` keys: same answer."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    most = 1 << POSITION_BITS
    if len(keys) > most:
        step = most - width + 1
        return np.concatenate([sliding_argmin(keys[s:s + most], width) + s for s in range(0, n, step)])
    low = U64(most - 1)
    m = (keys & ~low) | np.arange(len(keys), dtype=U64)
    size = 1
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < width:
        m = np.minimum(m[:n], m[width - size:width - size + n])
    return (m[:n] & low).astype(np.int64)


class Runs:
    """Windows of ``window`` symbols, grouped into runs that share one anchor.

    The anchor of a window is its ``k``-symbol substring with the smallest mixed
    hash, so equal windows have equal anchors at equal offsets, wherever they
    stand. A run is a maximal series of consecutive windows of one row with the
    same anchor occurrence: ``start`` (first window), ``n`` (windows), ``anchor``
    and ``content`` (hash of the covered symbols, their number and the anchor's
    offset). ``len(start)`` is about ``2 / (window - k + 2)`` of the symbols.
    """

    def __init__(self, values: np.ndarray, offsets: np.ndarray, window: int, k: int):
        self.window = window
        grams = mix(Rolling(values, BASE_A).all(k))
        best = sliding_argmin(grams, window - k + 1)
        n = len(best)
        row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
        ok = np.arange(n) + window <= offsets[1:][row_of] if n else np.empty(0, bool)
        new = np.ones(n, dtype=bool)
        if n:
            new[1:] = (best[1:] != best[:-1]) | (row_of[1:] != row_of[:-1])
            new &= ok
        self.start = np.flatnonzero(new)
        # windows that cross a row end are the last of each row, so a run ends
        # before the next run starts or before the last window of its row
        self.row = row_of[self.start] if n else np.empty(0, np.int64)
        nxt = np.append(self.start[1:], n) if len(self.start) else self.start
        last = offsets[1:][self.row] - window + 1 if n else nxt
        self.n = np.minimum(nxt, last) - self.start
        self.pos = best[self.start]
        self.anchor = grams[self.pos]
        self.roll = Rolling(values, BASE_B)
        shape = (self.n.astype(U64) << U64(32)) | (self.pos - self.start).astype(U64)
        self.content = mix(self.roll(self.start, self.start + self.n - 1 + window) + mix(shape))
        self.first = self.start - offsets[:-1][self.row] if n else self.start


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
