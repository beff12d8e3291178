"""Word suffix trees and the removal of repeated passages against plain Python."""

import random
import re

import numpy as np
import pytest

from riskline.llm import passage_dedup as PD
from riskline.llm.prefix_tree import BEGIN, deep_repeats

from .fixtures import awkward, empty, table


def repeats(strings, owner, least):
    """(length, places, smallest owner) of all maximal repeats."""
    places = {}
    for s, t in enumerate(strings):
        for o in range(len(t)):
            for end in range(o + least, len(t) + 1):
                places.setdefault(tuple(t[o:end]), []).append((s, o))
    out = set()
    for w, p in places.items():
        left = {strings[s][o - 1] if o else ("edge", s, o) for s, o in p}
        right = {strings[s][o + len(w)] if o + len(w) < len(strings[s]) else ("edge", s, o) for s, o in p}
        if len(p) > 1 and len(left) > 1 and len(right) > 1:
            out.add((len(w), tuple(sorted(p)), min(owner[s] for s, _ in p)))
    return out


def test_deep_repeats():
    rng = random.Random(8)
    for turn in range(800):
        least = rng.randint(1, 4)
        strings = [[rng.randrange(2 + turn % 2) for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 5))]
        owner = [rng.randint(0, 9) for _ in strings]
        flat = np.array([w for s in strings for w in s], np.int64)
        begins = np.cumsum([0, *map(len, strings)])
        suffix = [(s, o) for s, t in enumerate(strings) for o in range(len(t) - least + 1)]
        start = np.array([begins[s] + o for s, o in suffix], np.int64)
        left = np.array([len(strings[s]) - o for s, o in suffix], np.int64)
        before = np.array([strings[s][o - 1] if o else BEGIN for s, o in suffix], np.int64)
        own = np.array([owner[s] for s, _ in suffix], np.int64)
        got = set()
        for depth, sizes, members, low in deep_repeats(flat, start, left, before, own, least):
            ends = np.cumsum(sizes)
            for k in range(len(sizes)):
                got.add((int(depth[k]), tuple(sorted(suffix[i] for i in members[ends[k] - sizes[k] : ends[k]])), int(low[k])))
        assert got == repeats(strings, owner, least)


def expected(rows, window=PD.WINDOW):
    first = {}
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < d:
                    gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


def shared(rng, docs, vocabulary=9):
    """Documents of few words, that share many stretches; one word sequence repeats within and across them."""
    line = [f"L{i}" for i in range(20)]
    out = []
    for d in range(docs):
        words = []
        for _ in range(rng.randint(0, 8)):
            words += line[: rng.randint(5, 20)] if rng.random() < 0.5 else [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, 30))]
        out.append((d if rng.random() < 0.9 else rng.randrange(docs), " ".join(words)))
    return out + [(docs + i, "a b " * (30 + 40 * i)) for i in range(3)]


@pytest.mark.parametrize("group", [PD.GROUP, 40, 1])
def test_equal_to_plain_python(spark, group):
    """Also where anchors have more suffixes than a group and are divided by longer prefixes, down to whole windows."""
    rows = awkward() + [(10_000 + d, t) for d, t in shared(random.Random(4), 40)]
    rows += [(20_000 + i, f"start {i} " + " ".join(f"p{k}" for k in range(60)) + f" end {i}") for i in range(60)]  # a hot passage
    rows += [(30_000, " ".join(f"t{k}" for k in range(2000))), (30_001, "x " + " ".join(f"t{k}" for k in range(500, 1500)))]
    assert got(PD.passage_dedup(table(spark, rows), group)) == expected(rows)


def test_case_and_white_space(spark):
    text = " ".join(f"Word{i}" for i in range(14))
    rows = [(1, text), (2, text.lower()), (3, text.replace(" ", "\n\t ")), (4, "é" + text), (5, text + "\x1c"), (-5, text.split(" ", 1)[1])]
    assert got(PD.passage_dedup(table(spark, rows))) == expected(rows)


def test_empty(spark):
    assert PD.passage_dedup(empty(spark)).count() == 0
    assert got(PD.passage_dedup(table(spark, [(1, None), (None, "a " * 40), (None, "a " * 40)]))) == expected([(1, None), (None, "a " * 40), (None, "a " * 40)])
