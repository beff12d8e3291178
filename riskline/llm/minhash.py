"""SuperMinHash signatures."""

from __future__ import annotations

import numpy as np

from riskline.llm.shingles import U, mix

#: Signature length, and elements handled at once.
SLOTS, CHUNK = 128, 1 << 15
_GOLD, _FULL = 0x9E3779B97F4A7C15, np.iinfo(np.uint64).max


def super_minhash(hashes: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row per set (all ones for an empty set).

    Every element walks through a random permutation of the slots and offers its j-th slot the value j + r with r
    random below 1 (here j in the upper, r in the lower 32 bits), so the ranks that one element offers to different
    slots are correlated.  All elements of many sets take step j together; a set stops once all its slots hold values
    below j + 1, because later steps cannot lower any: after few steps for large sets.
    """
    h = np.full((len(sizes), slots), _FULL, np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(hashes), CHUNK):
        _offer(h, hashes[at : at + CHUNK], owner[at : at + CHUNK], slots)
    return h


def _offer(h: np.ndarray, x: np.ndarray, owner: np.ndarray, slots: int) -> None:
    if not len(x):
        return
    base, top = int(owner[0]), int(owner[-1]) + 1
    part = h[base:top]
    flat = part.reshape(-1)
    own = owner - base
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(x), 1))
    here = np.arange(len(x))
    for j in range(slots):
        draw = mix(x[here] + U(_GOLD * (j + 1) & int(_FULL)))
        k = j + (((draw & U(0xFFFFFFFF)) * U(slots - j)) >> U(32)).astype(np.int64)
        slot = order[here, k]
        order[here, k] = order[here, j]
        np.minimum.at(flat, own[here] * slots + slot, U(j << 32) | (draw >> U(32)))
        open_ = part.max(axis=1) >= U((j + 1) << 32)
        here = here[open_[own[here]]]
        if not len(here):
            return
