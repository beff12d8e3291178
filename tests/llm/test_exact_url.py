"""Exact dedup and the URL filter against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from riskline.llm import exact_dedup as ED
from riskline.llm import url_filter as UF

from .fixtures import awkward, empty, table


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(d)
    out = []
    for text, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = min(known) if known else None
        out += [(d, keep, len(ids), d == keep, hashlib.sha256(text.encode()).hexdigest()) for d in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [2, ED.HEAVY])
def test_exact_dedup(spark, heavy):
    rows = awkward() + [(1000 + i, "the same again") for i in range(200)]
    got = [tuple(r) for r in ED.exact_dedup(table(spark, rows), heavy=heavy).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_exact_dedup_empty(spark):
    assert ED.exact_dedup(empty(spark)).collect() == []


def test_misra_gries_keeps_every_heavy_item():
    rng = random.Random(3)
    for _ in range(200):
        items = [bytes([int(rng.paretovariate(1)) % 40]) for _ in range(rng.randint(0, 300))]
        size = rng.randint(1, 12)
        kept = ED.misra_gries(items, size)
        assert len(kept) <= size
        assert all(x in kept for x in set(items) if items.count(x) > len(items) / (size + 1))


URLS = [
    None, "", "no scheme", "://", "http://", "http://org/", "HTTP://A.ORG/x", "https://EXAMPLE.org/es/1?q#f", "https://www.example.org/es/",
    "https://xexample.org/es/", "https://example.org/en/12", "https://example.org/en/2", "https://example.org/en/1", "http://a.com/fr/", "http://a.com/fr",
    "http://com/de/x", "http://telecom/de/x", "http://a.com/de/?x", "http://b.net?x://c.org/", "http://b.net#frag/de/", "http://a.org", "ftp://ÄB.Org/é",
    "http://a.com://b.com/de/", "http://x.com/" + "a/" * 20000, "http://a\n.org/\nx", "http://a.com/fr/", "http://a.com/fr/",
]


def judge(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", None, None
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in UF.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_url_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "<html>", "clash") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in UF.url_filter(pages, UF.labelled_urls(spark)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = judge(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
        assert 0 <= got[i]["p_block"] <= 1


def test_url_model_on_addresses_it_has_not_seen(spark):
    bad = ["http://best-casino.example.net/slots", "http://spam-farm.example.net/en/77", "http://cheap-viagra.example.net/order", "http://xxx-cams.example.net/porn"]
    good = ["https://history.example.net/en/88", "https://www.thorea.example.net/de/4.html", "https://blog.physics.example.net/article/7", "https://docs.example.net/guide"]
    pages = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in UF.url_filter(pages, UF.labelled_urls(spark)).collect()}
    right = sum(got[i] == ("block" if i < len(bad) else "allow") for i in got)
    assert right >= 7


def test_url_filter_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "url string, label int")
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert [tuple(r)[4:] for r in UF.url_filter(pages, none).collect()] == [("allow", 0.0)]
    assert UF.url_filter(pages.limit(0), UF.labelled_urls(spark)).collect() == []


def test_url_filter_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    plan = UF.url_filter(pages, UF.labelled_urls(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapIn", plan.replace("ExternalRDD", ""))
