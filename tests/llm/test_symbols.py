import numpy as np
import pytest

from llm import _symbols
from llm._symbols import Runs, mix, sliding_argmin


@pytest.mark.parametrize("n", [250, 256, 257, 500, 3000])
@pytest.mark.parametrize("width", [1, 2, 7, 169])
def test_positions_beyond_the_position_bits(monkeypatch, n, width):
    monkeypatch.setattr(_symbols, "POSITION_BITS", 8)
    keys = np.random.default_rng(n).integers(0, 40, n).astype(np.uint64) << np.uint64(8)
    want = [s + int(np.argmin(keys[s:s + width])) for s in range(n - width + 1)]
    assert sliding_argmin(keys, width).tolist() == want


def test_runs_of_a_row_do_not_depend_on_the_position_bits(monkeypatch):
    values, offsets = mix(np.arange(2000, dtype=np.uint64) % np.uint64(701)), np.array([0, 30, 1990, 2000])
    want = Runs(values, offsets, 40, 6)
    monkeypatch.setattr(_symbols, "POSITION_BITS", 8)
    got = Runs(values, offsets, 40, 6)
    assert all((getattr(got, k) == getattr(want, k)).all() for k in ("start", "n", "pos", "anchor", "content", "first"))
    assert len(got.pos) and (got.pos >= got.start).all()


def test_more_than_2_to_the_24_keys():
    n, width = (1 << 24) + 500, 169
    keys = mix(np.arange(n, dtype=np.uint64))
    at = np.arange(n - width - 300, n - width + 1)
    got = sliding_argmin(keys, width)
    assert len(got) == n - width + 1
    assert got[at].tolist() == [s + int(np.argmin(keys[s:s + width] >> np.uint64(24))) for s in at.tolist()]


def thue_morse(n, a="a", b="b"):
    """Words that every polynomial hash modulo 2^64 takes for their complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(a if x else b for x in bits), "".join(b if x else a for x in bits)


def test_codes_tell_words_apart():
    texts = [*thue_morse(1024), *thue_morse(2048), "a", "a\0", "\0a", "\0", "ab", "ba", "a" * 8, "a" * 9, "a" * 15, "a" * 16, "a" * 17, "b" + "a" * 15]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    size = np.array([len(t) for t in texts])
    end = np.cumsum(size)
    a, b = _symbols.word_codes(data, end - size, end)
    assert len({(x, y) for x, y in zip(a.tolist(), b.tolist())}) == len(texts) == len(set(a.tolist()))
    # the same wherever a word stands
    other = _symbols.word_codes(np.concatenate([np.frombuffer(b"xyz ", np.uint8), data]), end - size + 4, end + 4)
    assert (other[0] == a).all() and (other[1] == b).all()
