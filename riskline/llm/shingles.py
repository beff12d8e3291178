"""Word shingles of whole texts as sets of 64-bit hashes, many texts at once in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5
U = np.uint64
_rng = np.random.default_rng(20240229)
#: Random value of every byte (A-Z as a-z), odd base of the rolling sums and its inverse modulo 2**64.
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_MULTIPLIERS = _rng.integers(1, 2**63, WORDS, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits look independent (the SplitMix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = U(base)
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {"up": powers(BASE, 1 << 16), "down": powers(INVERSE, 1 << 16)}


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of them (kept by the worker up to 16 Mi)."""
    if len(_tables["up"]) < n:
        up, down = powers(BASE, n), powers(INVERSE, n)
        if n > 1 << 24:
            return up, down
        _tables.update(up=up, down=down)
    return _tables["up"], _tables["down"]


def prefix_sums(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    """s with s[0] = 0 and s[i + 1] = s[i] + values[i] * base ** i; substrings hash to (s[j] - s[i]) * base ** -i."""
    s = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=s[1:])
    return s


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word: runs without white space (U+0020, U+0009..D), A-Z lower-cased."""
    raw = [(t or "").encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]]) if len(data) else space
    start = np.flatnonzero(~space & before)
    stop = np.flatnonzero(space & ~before)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = tables(len(data))
    s = prefix_sums(_BYTE[data], up)
    return mix((s[stop] - s[start]) * down[start] + (stop - start).astype(np.uint64)), np.searchsorted(ends, start, side="right")


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the distinct shingles of every text, sorted within it, one text after the other.

    A shingle is five consecutive words, or the whole sequence of a text with fewer; a text without words has none.
    """
    word, doc = word_hashes(texts)
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    n_words = np.bincount(doc, minlength=len(texts))
    last = len(word) - WORDS + 1
    if last > 0:
        total = np.zeros(last, np.uint64)
        for k in range(WORDS):
            total += word[k : last + k] * _MULTIPLIERS[k]
        inside = doc[:last] == doc[WORDS - 1 :]
        hashes, owner = mix(total[inside]), doc[:last][inside]
    else:
        hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(few):
        first = np.searchsorted(doc, few)
        n = n_words[few]
        whole = n.astype(np.uint64) * U(0xD6E8FEB86659FD93)
        for k in range(WORDS - 1):
            at = np.minimum(first + k, len(word) - 1)
            whole += np.where(k < n, word[at] * _MULTIPLIERS[k], U(0))
        hashes, owner = np.concatenate([hashes, mix(whole)]), np.concatenate([owner, few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(texts))
