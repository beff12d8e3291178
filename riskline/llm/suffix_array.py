"""Enhanced suffix arrays of short strings and their maximal repeats."""

from __future__ import annotations

import numpy as np

#: Left neighbour of an interval whose members are preceded by different bytes.
DIVERSE = -1


def suffixes(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, lcp, string, offset) of all suffixes with at least ``least`` bytes.

    ``string`` and ``offset`` tell where a suffix begins, suffix numbers run through the strings in turn; ``order`` is
    the suffix array, ``lcp[i]`` the longest common prefix of its entries i - 1 and i (``lcp[0]`` is 0).  Bytes must be
    below 255, as in UTF-8.
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    count = np.maximum(lengths - least + 1, 0)
    string = np.repeat(np.arange(len(strings)), count)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(count) - count, count)
    if not len(string):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), string, offset
    width = int(lengths.max())
    # bytes are raised by one, so that the zeros behind a string sort below them
    gap = bytes(width)
    data = np.frombuffer(gap.join([*strings, b""]), np.uint8).copy()
    begin = np.cumsum(lengths + width) - lengths - width
    inside = np.ones(len(data), bool)
    for b, n in zip(begin.tolist(), lengths.tolist(), strict=True):
        inside[b + n : b + n + width] = False
    data[inside] += 1
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[begin[string] + offset]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").reshape(-1), kind="stable")
    ranked = rows[order]
    differ = ranked[1:] != ranked[:-1]
    left = (lengths[string] - offset)[order]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp[1:] = np.minimum(lcp[1:], np.minimum(left[1:], left[:-1]))
    return order, lcp, string, offset


def maximal_repeats(strings: list[bytes], owner: np.ndarray, least: int):
    """All maximal repeats of at least ``least`` bytes: yields (length, suffixes, smallest owner).

    A stack scan over the LCP table closes the common-prefix intervals, children before parents; every interval knows
    its smallest owner and whether its occurrences are preceded by different bytes (a string's begin differs from
    everything).  Those that are left-diverse are maximal, and come with all their occurrences as suffix numbers.
    """
    order, lcp, string, offset = suffixes(strings, least)
    if not len(order):
        return
    before = [strings[s][o - 1] if o else DIVERSE for s, o in zip(string[order].tolist(), offset[order].tolist(), strict=True)]
    smallest = owner[string][order].tolist()
    depth = lcp.tolist() + [0]
    at, n = 1, len(order)
    near = np.flatnonzero(lcp >= least)
    while at <= n:
        # jump to the next pair of suffixes with a long enough common prefix
        k = np.searchsorted(near, at)
        if k == len(near):
            return
        at = int(near[k])
        stack = [[depth[at], at - 1, before[at - 1], smallest[at - 1]]]
        while stack:
            # the stack holds open intervals of growing depth; entry ``at`` joins the deepest one
            top = stack[-1]
            if before[at] != top[2]:
                top[2] = DIVERSE
            top[3] = min(top[3], smallest[at])
            at += 1
            closed = None
            while stack and depth[at] < stack[-1][0]:
                length, first, left, least_owner = closed = stack.pop()
                if left == DIVERSE:
                    yield length, order[first:at], least_owner
                if stack and depth[at] <= stack[-1][0]:
                    parent = stack[-1]
                    parent[2] = parent[2] if parent[2] == left else DIVERSE
                    parent[3] = min(parent[3], least_owner)
                    closed = None
            if depth[at] < least:
                break
            if closed is not None:  # a shallower interval that begins where the closed one did
                stack.append([depth[at], closed[1], closed[2], closed[3]])
            elif not stack or depth[at] > stack[-1][0]:
                stack.append([depth[at], at - 1, before[at - 1], smallest[at - 1]])
