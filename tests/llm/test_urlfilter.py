"""Temporal list join against a plain as-of lookup."""

import random
from datetime import datetime, timedelta

import pytest

from storyloom.llm import urlfilter

DAY0 = datetime(2024, 1, 1)
URLS = ["http://a.example.com/x", "https://a.example.com:443/x/", "http://user@b.example.com/y?q=1#f", "//c.org", "HTTP://A.Example.COM./x",
        "ftp://nope", "", None, "http://", "http://d.example.com:8080/z", "no host at all", "http://" + "l." * 200 + "org/"]


def _norm(url):
    import re

    m = re.match(r"(?i)^(?:https?:)?//(?:[^/?#@]*@)?([^#]*)", (url or "").strip())
    if not m:
        return None
    host = re.match(r"[^/?]*", m[1])[0]
    path = m[1][len(host):].rstrip("/")
    host = re.sub(r"(?::(?:80|443))?$", "", host.lower()).rstrip(".")
    return host + path if host else None


def _plain(url, fetched, entries):
    import re

    address = _norm(url)
    if address is None:
        return "invalid", 0
    if fetched is None:
        return "undated", 0
    host = re.sub(r":\d+$", "", re.match(r"[^/?]*", address)[0])
    labels = host.split(".")
    keys = {("url", address), ("host", host)}
    if len(host) <= 253:
        keys |= {("domain", ".".join(labels[i:])) for i in range(len(labels))}
    active = []
    for kind, key in keys:
        past = [(at, {None: 0, "allow": 1, "block": 2}[v], v) for k, n, at, v in entries if (k, n) == (kind, key) and at and at <= fetched]
        if past and max(past)[2]:
            active.append((["domain", "host", "url"].index(kind), len(key), max(past)[2] == "block"))
    if not active:
        return "none", 0
    return ("block" if max(active)[2] else "allow"), len(active)


@pytest.mark.parametrize("bucket", [1, 30])
def test_equals_a_plain_lookup(spark, bucket):
    rng = random.Random(3)
    pages = [(i, rng.choice(URLS), None if rng.random() < 0.1 else DAY0 + timedelta(hours=rng.randrange(2000))) for i in range(400)]
    names = [("url", "a.example.com/x"), ("host", "a.example.com"), ("domain", "example.com"), ("domain", "com"), ("domain", "c.org"),
             ("host", "b.example.com"), ("domain", "org"), (None, "x"), ("host", None), ("url", "d.example.com:8080/z")]
    entries = [(*rng.choice(names), None if rng.random() < 0.05 else DAY0 + timedelta(hours=rng.randrange(-500, 2500)), rng.choice(["block", "allow", None]))
               for _ in range(60)]
    entries += entries[:10] + [("domain", "com", DAY0, "block"), ("domain", "com", DAY0, "allow")]
    captures = spark.createDataFrame(pages, "page_id long, url string, fetched timestamp_ntz").selectExpr("*", "1 AS kind", "2 AS address")
    listed = spark.createDataFrame(entries, "kind string, key string, at timestamp_ntz, listed string")
    got = {r.page_id: (r.verdict, r.n_active) for r in urlfilter.judge(captures, listed, bucket).collect()}
    assert got == {i: _plain(u, t, entries) for i, u, t in pages}
    assert len(set(v for v, _ in got.values())) == 5


def test_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", DAY0), (1, "http://a.b/c", DAY0)], "page_id long, url string, fetched timestamp_ntz")
    entries = spark.createDataFrame([], "kind string, key string, at timestamp_ntz, listed string")
    assert [r.verdict for r in urlfilter.judge(pages, entries).collect()] == ["none", "none"]
    assert urlfilter.judge(pages.limit(0), urlfilter.sample_lists(pages)).count() == 0
    plan = urlfilter.judge(pages, urlfilter.sample_lists(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
