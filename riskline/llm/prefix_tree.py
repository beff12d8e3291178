"""Suffix trees of word sequences, built from the root a word at a time, and their maximal repeats."""

from __future__ import annotations

import numpy as np

#: Word before a suffix that begins its sequence.
BEGIN = -1


def deep_repeats(words: np.ndarray, start: np.ndarray, left: np.ndarray, before: np.ndarray, owner: np.ndarray, least: int):
    """Maximal repeats of at least ``least`` words: yields (lengths, sizes, suffixes, smallest owners) of many nodes.

    Suffix i is ``words[start[i] : start[i] + left[i]]`` (word numbers, none negative), ``before[i]`` the word in front of it or
    BEGIN.  All subtrees grow at once: at every depth the suffixes of a node are split by their next word, one that
    ends is a branch of its own, and branches with a single suffix are leaves that need no more work.  A node that
    splits is an internal node; if it is deep enough and its suffixes follow different words (or a begin), its path is a maximal
    repeat, whose occurrences are all its suffixes: ``sizes`` of them for each node, one node after the other.
    """
    at, node, depth = np.arange(len(start)), np.zeros(len(start), np.int64), 0
    while len(at):
        ended = left[at] <= depth
        word = np.where(ended, -1, words[np.minimum(start[at] + depth, len(words) - 1)]).astype(np.int64)
        key = node * (int(words.max(initial=0)) + 2) + word + 1
        order = np.argsort(key, kind="stable")
        at, node, key, ended = at[order], node[order], key[order], ended[order]
        head = np.concatenate([[True], node[1:] != node[:-1]])
        branch = np.concatenate([[True], key[1:] != key[:-1]]) | ended
        if depth >= least:
            first = np.flatnonzero(head)
            low, high = np.minimum.reduceat(before[at], first), np.maximum.reduceat(before[at], first)
            repeat = (np.add.reduceat(branch.astype(np.int64), first) > 1) & ((low != high) | (low == BEGIN))
            if repeat.any():
                size = np.diff(np.append(first, len(at)))
                smallest = np.minimum.reduceat(owner[at], first)
                yield np.full(int(repeat.sum()), depth), size[repeat], at[np.repeat(repeat, size)], smallest[repeat]
        child = np.cumsum(branch) - 1
        several = np.bincount(child)[child] > 1
        at, child = at[several], child[several]
        node = np.cumsum(np.concatenate([[True], child[1:] != child[:-1]])) - 1 if len(at) else child
        depth += 1
