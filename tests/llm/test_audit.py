"""The filter audit against every order played through in plain Python."""

import re
from itertools import permutations

from riskline.llm import filter_audit as FA

from .fixtures import awkward, empty, table

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
    return out + ("D" if re.search(r"[#$%&*|]", text) else "")


def expected(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    docs = []
    for d, t, s in rows:
        t = t or ""
        again = d is not None and any(o is not None and o < d and (u or "") == t for o, u, _ in rows)
        docs.append((s or "", fails(t) + "E" * again, d is not None and d in good, d is not None and d in toxic))
    out = {}
    for part in {p for p, *_ in docs}:
        own = [x[1:] for x in docs if x[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, f in enumerate(order, 1):
                hit = [x for x in left if f in x[0]]
                redundant = sum(f in x[0] for x in own) - len(hit)
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(hit)
                out[part, order, step] = [len(left), len(hit), redundant, sum(x[0] == f for x in own), sum(x[1] for x in hit), sum(x[2] for x in hit)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_order(spark):
    rows = awkward()
    rows += [(600 + i, t) for i, t in enumerate(["A# b", "A# b", "ÀÉ " * 60, "same words " * 40, "# " * 60, "GOOD DAY " * 30])]
    docs = table(spark, rows)
    triples = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    ids = [d for d, _ in rows if d is not None]
    labels = [(d, i % 3 % 2, i % 2) for i, d in enumerate(ids)] + [(100, 1, 0), (100, 0, 1), (None, 1, 1), (7, None, None), (10**12, 1, 1)]
    marks = spark.createDataFrame([(*x, "clash", "clash") for x in labels], "doc_id long, quality int, toxic int, part string, n string")
    assert got(FA.filter_audit(docs, marks)) == expected(triples, labels)


def test_parts_and_missing_labels(spark):
    rows = [(1, "one", None), (2, "one", ""), (3, None, "p"), (4, "", "p"), (None, "one", "q"), (None, None, "q"), (5, " ".join(f"w{i}" for i in range(60)), "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = got(FA.filter_audit(docs, none))
    assert found == expected(rows, [])
    assert found["clean", "EDCBA", 5] == (1, 0, 0, 0, 0, 0, 0)


def test_empty(spark):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert FA.filter_audit(empty(spark), labels).count() == 0


def test_copies_are_summed_up_before_they_move(spark):
    """The right side of the self-join holds one row per distinct text, summed before and after the shuffle."""
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(3000)], "doc_id long, text string")
    found = FA.repeats(docs)
    assert sorted(r["doc_id"] for r in found.collect()) == [i for i in range(3000) if i % 3 and i > 1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
