"""Small document tables with the awkward cases of every contract."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score string, digest string, part string, n string, root string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    syllables = ["th", "and", "er", "ing", "Ou", "re", "né", "ß", "in", "tion", "st"]
    made = random.Random(7)
    listed = ["".join(made.choices(syllables, k=made.randint(1, 4))) for _ in range(vocabulary)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "  ", ". "]) for w in rng.choices(listed, k=n))


def awkward(seed: int = 1) -> list[tuple]:
    """(doc_id, text): nulls, empty and very long texts, copies, near copies, shared passages, ties, repeated rows."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = words(rng, 30)
    rows = [(5, None), (6, ""), (7, " \t\n "), (8, "one two"), (9, "one two"), (10, "One\ttwo"), (11, "3 4 5"), (None, base), (None, "lonely words")]
    rows += [(100 + i, base) for i in range(6)]
    rows += [(120 + i, base.replace(" ", "  ", i)) for i in range(1, 3)]
    for i in range(12):
        w = base.split(" ")
        for _ in range(i):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, words(rng, 40) + passage + words(rng, 25)) for i in range(10)]
    rows += [(400, "ab" * 3000), (401, "ab" * 2500), (402, "a" * 4000), (403, words(rng, 6000)), (404, "x" * 49), (405, "x" * 50), (406, "x" * 50)]
    rows += [(500, "日本語の文章です。" * 20), (501, "éàü" * 40 + "<|endoftext|> tail"), (502, "nul \x00 byte " * 9), (503, "\x1c odd\x85space\u2003here")]
    rows += [(300, rows[-1][1]), (100, base), (101, base)]  # ids that are repeated, with another text or the same
    return rows


def table(spark, rows):
    """Documents with further columns whose names clash with those used inside."""
    langs = ["en", "fr", None]
    full = [(d, t, langs[i % 3], f"s{i % 2}", None if t is None else len(t), "a", "b", "c", "d", "e") for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
