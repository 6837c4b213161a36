"""Temporal list join against a scan of all entries."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from jobsight.llm.url_lists import drop_blocked, filter_captures, host

DAY = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]


def names(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(/[^?#]*)?", url or "")
    h = m[1].lower().removesuffix(".") if m else ""
    if not h:
        return set()
    labels, path = h.split("."), (m[2] or "")
    out = {f"host:{h}"} | {"domain:" + ".".join(labels[i:]) for i in range(len(labels))}
    return out | {f"path:{h}{path[:i + 1]}" for i, c in enumerate(path) if c == "/" and i}


def brute(captures, entries):
    out = []
    for i, url, at in captures:
        hit = set()
        for name, pattern in {(e[0], e[1]) for e in entries if None not in e}:
            before = [e for e in entries if e[:2] == (name, pattern) and None not in e and at and e[3] <= at]
            if before and pattern in names(url):
                last = max(e[3] for e in before)
                if all(e[2] == "add" for e in before if e[3] == last):
                    hit.add(name)
        out.append((i, url, at, len(hit), ",".join(sorted(hit)), bool(hit)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rnd = random.Random(4)
    hosts = ["a.example.com", "b.example.com", "www.a.example.com", "x.org", "X.org.", "localhost"]
    urls = [f"{s}://{u}{h}{p}{path}" for h in hosts for s in ("http", "HTTPS") for u, p in (("", ""), ("me@", ":80"))
            for path in ("", "/", "/en/x", "/en/y/z?q=/de/", "/en#f")] + [None, "", "mailto:x", "no url", "http:///p"]
    captures = [(i, rnd.choice(urls), rnd.choice([*DAY, None])) for i in range(300)] + [(None, urls[0], DAY[9])] * 2
    patterns = sorted(set().union(*map(names, urls))) + ["host:none.org", None]
    entries = [(rnd.choice(["l1", "l2", None]), rnd.choice(patterns), rnd.choice(["add", "add", "remove", None]), rnd.choice([*DAY, None]))
               for _ in range(400)]
    c = spark.createDataFrame([(*r, "x", 1) for r in captures], "page_id long, url string, fetched_at date, list string, n_lists int")
    e = spark.createDataFrame([(*r, 5) for r in entries], "list string, pattern string, action string, at date, page_id int")
    want = brute(captures, entries)
    assert sum(r[5] for r in want) > 50
    assert sorted(map(tuple, filter_captures(c, e).collect()), key=str) == want
    left = drop_blocked(c, e)
    assert left.columns == c.columns and left.count() == sum(not r[5] for r in want)
    assert filter_captures(c.limit(0), e).collect() == []
    assert all(not r["blocked"] for r in filter_captures(c, e.limit(0)).collect())


def test_hosts(spark):
    rows = spark.createDataFrame([("http://A.b.C:80/x",), ("ftp://u:p@h.org?x",), ("//h.org",), (None,)], "u string")
    assert [r[0] for r in rows.select(host(F.col("u"))).collect()] == ["a.b.c", "h.org", "", None]
