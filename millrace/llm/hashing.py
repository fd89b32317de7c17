"""Vectorised hashes of words and n-grams, a batch of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
#: An odd multiplier of the polynomial hash and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 22

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes that are no letters; bytes above 127 belong to letters of UTF-8.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = (np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1))[_LOWER]


def _powers(of: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    filled, step = 1, of
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * _U(step)
        filled, step = filled + more, step * step % (1 << 64)
    return out


_TABLES: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a public finaliser of multiplications and shifts)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins and the last ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(starts) < 2:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


#: Values of bytes as they are, for two independent hashes.
EXACT = tuple(
    np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1) for seed in (11, 12)
)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    """Hashes of ranges of bytes, which depend on the bytes alone."""
    need = len(data) + 1
    if len(_TABLES[0]) < need:
        size = max(need, _CHUNK + 2)
        _TABLES[:] = [_powers(_BASE, size), _powers(_INVERSE, size)]
    total = np.zeros(need, _U)
    np.cumsum(values[data] * _TABLES[0][: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * _TABLES[1][starts] + (ends - starts).astype(_U))


def words(texts: pa.Array, separators: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a batch (A-Z lower-cased), and each text's first word and end.

    A word is a run of bytes without separator.  Long batches are worked through in chunks,
    cut at separators or text borders, so memory follows the chunk.
    """
    data, at = flat(texts)
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(len(at), np.int64)
    out, begins, lo = [], [], 0
    while lo < n:
        hi = min(lo + _CHUNK, n)
        if hi < n:
            border = at[np.searchsorted(at, hi, "right") - 1]
            gaps = np.flatnonzero(separators[data[max(lo, hi - 65536) : hi]])
            last = max(lo, hi - 65536) + gaps[-1] + 1 if len(gaps) else lo
            cut = max(border, last)
            if cut <= lo:  # one word longer than the chunk
                more = np.flatnonzero(separators[data[hi:]])
                cut = min(hi + more[0] if len(more) else n, at[np.searchsorted(at, lo, "right")])
            hi = int(cut)
        part = data[lo:hi]
        inside = ~separators[part]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        borders = at[np.searchsorted(at, lo) : np.searchsorted(at, hi)] - lo
        before[borders] = False
        first = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[borders[borders > 0] - 1] = False
        end = np.flatnonzero(inside & ~after) + 1
        out.append(hash_ranges(part, first, end))
        begins.append(first + lo)
        lo = hi
    begin = np.concatenate(begins)
    return np.concatenate(out), np.searchsorted(begin, at)


def ngrams(hashes: np.ndarray, at: np.ndarray, n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row (``skip`` words left out between them) and their borders."""
    span = (n - 1) * (skip + 1) + 1
    count = np.maximum(np.diff(at) - span + 1, 0)
    borders = np.concatenate([[0], np.cumsum(count)])
    total = int(borders[-1])
    if not total:
        return np.zeros(0, _U), borders
    pos = np.arange(total) + np.repeat(at[:-1] - borders[:-1], count)
    out = np.full(total, (n * 31 + skip) * 0x632BE59BD9B4E019 % (1 << 64), _U)
    for k in range(n):
        out = out * _U(0xD1342543DE82EF95) + hashes[pos + k * (skip + 1)]
    return mix(out), borders
