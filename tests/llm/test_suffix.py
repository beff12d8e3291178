"""Suffix arrays and the removal of repeated strings against plain Python."""

import random
import zlib

import numpy as np
import pytest

from riskline.llm import suffix_dedup as SD
from riskline.llm.suffix_array import maximal_repeats, suffixes

from .fixtures import awkward, empty, table


def repeats(strings, owner, least):
    places = {}
    for s, t in enumerate(strings):
        for o in range(len(t)):
            for end in range(o + least, len(t) + 1):
                places.setdefault(t[o:end], []).append((s, o))
    out = set()
    for w, p in places.items():
        left = {strings[s][o - 1] if o else ("edge", s, o) for s, o in p}
        right = {strings[s][o + len(w)] if o + len(w) < len(strings[s]) else ("edge", s, o) for s, o in p}
        if len(left) > 1 and len(right) > 1:
            out.add((len(w), tuple(sorted(p)), min(owner[s] for s, _ in p)))
    return out


def test_maximal_repeats():
    rng = random.Random(5)
    for turn in range(1500):
        least = rng.randint(1, 4)
        alphabet = b"ab" if turn % 2 else b"abc\x00"
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 6))]
        owner = np.array([rng.randint(0, 9) for _ in strings])
        _, _, string, offset = suffixes(strings, least)
        got = {(n, tuple(sorted((int(string[x]), int(offset[x])) for x in found)), low) for n, found, low in maximal_repeats(strings, owner, least)}
        assert got == repeats(strings, owner, least)


def expected(rows):
    """(doc_id, bytes, removed, spans, kept) of every row."""
    first = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        if d is not None:
            for p in range(len(b) - SD.MATCH + 1):
                w = b[p : p + SD.MATCH]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        if d is not None:
            for p in range(len(b) - SD.MATCH + 1):
                if first[b[p : p + SD.MATCH]] < d:
                    gone[p : p + SD.MATCH] = b"\1" * SD.MATCH
        out.append((d, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def answers(frame):
    rows = frame.collect()
    return sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["begin"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in rows), key=str)


def test_suffix_dedup(spark):
    rows = awkward()
    assert answers(SD.suffix_dedup(table(spark, rows))) == expected(rows)


def test_suffix_dedup_empty(spark):
    assert SD.suffix_dedup(empty(spark)).collect() == []


def test_suffix_dedup_carries_columns(spark):
    rows = awkward()
    got = SD.suffix_dedup(table(spark, rows), carry=["lang", "part", "n"]).collect()
    assert len(got) == len(rows) and all(r["carried"]["part"] == "c" and r["carried"]["n"] == "d" for r in got)


def locally(rows, slices=3, parts=5):
    """The steps of the job without Spark."""
    docs = [(d, (t or "").encode()) for d, t in rows if d is not None]

    def out_rows(o):
        return [tuple(r.values()) for r in o.batch().to_pylist()]

    o = SD.Out(parts)
    spread = []
    for k in range(slices):
        part = docs[k::slices]
        SD.cut_slice(np.array([d for d, _ in part], np.int64), [b for _, b in part], o)
        spread += out_rows(o)

    def solve(packed):
        done = [r for r in packed if r[0] in (SD.SPANS, SD.ASK, SD.ASK_WINDOWS)]
        SD.solve_runs([r[1:] for r in packed if r[0] == SD.RUNS], o)
        SD.solve_texts([r[1:] for r in packed if r[0] == SD.TEXTS], o)
        return done + out_rows(o)

    first = solve(spread)
    texts = {(d, zlib.crc32(b)): b for d, b in docs}
    kinds = {r[0] for r in first}
    SD.fetch([(r[0], r[2], r[3]) for r in first if r[0] in (SD.ASK, SD.ASK_WINDOWS)], texts, o)
    spans = [r for r in first + solve(out_rows(o)) if r[0] == SD.SPANS]
    found = {}
    for _, _, n, payload in spans:
        t, _ = SD.unpack(SD.SPANS, n, payload)
        for d, g, a, k in zip(*(t[f].tolist() for f in ("doc", "tag", "start", "n"))):
            found.setdefault((d, g), []).append((a, k))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        w = np.array(found.get((d, zlib.crc32(b)), []), np.int64).reshape(-1, 2)
        cut, kept = SD.cut(b, w[:, 0], w[:, 1])
        out.append((d, len(b), sum(e - s for s, e in cut), len(cut), kept))
    return sorted(out, key=str), kinds


@pytest.mark.parametrize(("slice_texts", "group_texts", "kind"), [(32, 2048, SD.ASK), (1, 2048, SD.ASK_WINDOWS), (32, 2, SD.ASK_WINDOWS)])
def test_frequent_minimizers_go_window_by_window(monkeypatch, slice_texts, group_texts, kind):
    monkeypatch.setattr(SD, "SLICE_TEXTS", slice_texts)
    monkeypatch.setattr(SD, "GROUP_TEXTS", group_texts)
    rng = random.Random(31)
    line = "the very common line that many documents hold, word for word"
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 90))) + line + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    got, kinds = locally(rows)
    assert got == expected(rows) and kind in kinds


def test_windows_with_one_equal_hash_are_not_equal(monkeypatch):
    """Windows of frequent minimizers whose first hash collides: only those with the same bytes go."""
    monkeypatch.setattr(SD, "_BYTE", np.full(256, 7, np.uint64))  # every window has the same first hash
    rng = random.Random(32)
    same = bytes(rng.choices(b"abcdefgh", k=60))
    docs = {d: same if d in (2, 4) else bytes(rng.choices(b"abcdefgh", k=60)) for d in range(6)}
    texts = {(d, zlib.crc32(b)): b for d, b in docs.items()}

    def windows(*ids):
        asked = {"doc": np.array(ids), "tag": np.array([zlib.crc32(docs[d]) for d in ids]), "start": np.zeros(len(ids)), "n": np.full(len(ids), 60 - SD.MATCH + 1)}
        return [(SD.ASK_WINDOWS, len(ids), SD.pack(SD.ASK_WINDOWS, asked))]

    def removed(out):
        found = [SD.unpack(SD.SPANS, n, b)[0] for k, _, n, b in (tuple(r.values()) for r in out) if k == SD.SPANS]
        return sorted((d, a, n) for t in found for d, a, n in zip(*(t[f].tolist() for f in ("doc", "start", "n"))))

    met = SD.Out(5)
    SD.fetch(windows(*docs), texts, met)  # all in one document bucket
    assert removed(met.batch().to_pylist()) == [(4, 0, 11)]
    apart = SD.Out(5)
    SD.fetch(windows(0, 2, 3), texts, apart)
    SD.fetch(windows(1, 4, 5), texts, apart)  # in two, whose windows meet later
    packed = apart.batch().to_pylist()
    assert removed(packed) == []
    SD.solve_runs([(r["part"], r["rows"], r["payload"]) for r in packed if r["kind"] == SD.RUNS], apart)
    assert removed(apart.batch().to_pylist()) == [(4, 0, 11)]


def test_small_alphabets():
    """Periodic and highly repetitive texts: long runs, many equal windows."""
    rng = random.Random(33)
    for turn in range(25):
        unit = "".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))
        rows = [(i, "".join(rng.choice([unit, unit[::-1], "é", "b"]) for _ in range(rng.randint(0, 40)))) for i in range(8)]
        got, _ = locally(rows, slices=1 + turn % 4)
        assert got == expected(rows)


def test_memory_of_the_first_step_is_bounded():
    """Its tables follow the slice, not the Arrow batch."""
    import random
    import tracemalloc

    import pyarrow as pa

    from riskline.llm import suffix_dedup as SD

    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=350)) for _ in range(1900)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1900)), "text": texts})
    out = SD.Out(12)
    tracemalloc.start()
    found = sum(b.num_rows for b in SD.cut_batches(iter([batch]), out))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and batch.nbytes > 3 << 20 and peak < 50 << 20
