"""Array views of Arrow text batches: words, word hashes and shingles without Python strings.

Everything here works on the UTF-8 bytes of a run of documents at once.  A run holds at most
``RUN_BYTES`` of text (a longer document makes a run of its own), so memory in a task is bounded
by one run, not by the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tablemill.functions.batches import give_back as give_back

RUN_BYTES = 1 << 19

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15 | 1)
_P_INV = _U(pow(int(_P), -1, 1 << 64))
_Q = _U(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are runs of bytes outside U+0020 and U+0009..U+000D.
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[32, 9, 10, 11, 12, 13]] = False

#: Words are runs of digits, letters a-z and everything beyond ASCII.
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[48:58] = ALNUM_WORDS[97:123] = ALNUM_WORDS[128:] = True


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        steps = np.full(max(n, RUN_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 4 * RUN_BYTES:
            _powers[key] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_utf8())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], (at - at[0]) if len(at) else np.zeros(1, np.int64)


def runs(batch: pa.RecordBatch, column: str, limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes in ``column`` (or one row)."""
    n = batch.num_rows
    if not n:
        return
    _, at = utf8(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < n:
        stop = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def words(raw: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of all words, and where each document's words begin."""
    n = len(raw)
    inside = kind[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, at)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    A long text goes piece by piece (some words, or one), so that sums over its bytes need no memory
    of their own for all of it."""
    n = len(raw)
    if n > 2 * RUN_BYTES and len(start) > 1:
        out = np.empty(len(start), dtype=np.uint64)
        a = 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(end, start[a] + RUN_BYTES, side="right")))
            lo, hi = start[a], end[b - 1]
            out[a:b] = _word_hashes(raw[lo:hi], start[a:b] - lo, end[a:b] - lo)
            a = b
        return out
    return _word_hashes(raw, start, end)


def _word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(raw)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power(_P_INV, n), out=total[1:])
    return mix64((total[end] - total[start]) * _power(_P, n + 1)[end])


def window_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` consecutive words (across document borders too)."""
    n = len(word) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = word[:n].copy()
    for k in range(1, size):
        out *= _Q
        out += word[k : k + n]
    return mix64(out)


def shingle_sets(word: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Each document's sorted distinct shingles; fewer words make one shingle, none make none."""
    hashes, out = window_hashes(word, size), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(hashes[a : b - size + 1]))
        elif b > a:
            out.append(window_hashes(word[a:b], b - a) ^ _U(b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
