"""Sets of word shingles of whole texts, their fingerprints and b-bit minhash signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from millrace.llm import hashing

WORDS = 5


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their borders.

    A text with fewer words has its whole sequence as one shingle, one without words none.
    """
    hashes, at = hashing.words(texts)
    grams, borders = hashing.ngrams(hashes, at, words)
    n_words = np.diff(at)
    short = {}
    for n in range(1, words):
        rows = np.flatnonzero(n_words == n)
        if len(rows):
            some, where = hashing.ngrams(hashes, at, n)
            short.update(zip(rows.tolist(), some[where[rows]], strict=True))
    parts, sizes = [], np.zeros(len(n_words), np.int64)
    for i in range(len(n_words)):
        if i in short:
            own = np.array([short[i]], np.uint64)
        else:
            own = np.sort(grams[borders[i] : borders[i + 1]])
            if len(own):
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        parts.append(own)
        sizes[i] = len(own)
    out = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return out, np.concatenate([[0], np.cumsum(sizes)])


def fingerprints(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal sets, and in practice only these, agree."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(hashing.mix(sets ^ np.uint64(salt)), out=total[1:])
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def multipliers(symbols: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    return rng.integers(1, 1 << 63, symbols, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: np.ndarray, at: np.ndarray, symbols: int) -> np.ndarray:
    """16-bit minhash symbols, one row per text; zeros where the set is empty."""
    n = len(at) - 1
    out = np.zeros((n, symbols), "<u2")
    full = np.flatnonzero(np.diff(at) > 0)
    factors = multipliers(symbols)
    i = 0
    while i < len(full):  # a stretch of texts at a time, so that it stays in the cache
        j = int(np.searchsorted(at[full], at[full[i]] + 32768))
        j = max(j, i + 1)
        rows = full[i:j]
        part = sets[at[rows[0]] : at[rows[-1] + 1]]
        begins = at[rows] - at[rows[0]]
        for k in range(symbols):
            least = np.minimum.reduceat(part * factors[k], begins)
            out[rows, k] = (hashing.mix(least) & np.uint64(0xFFFF)).astype("<u2")
        i = j
    return out
