"""Runs by recompression against a definition-level search."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsight.llm import periodic_runs as P
from jobsight.llm.recompression import Grammar

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """All runs: for each period the maximal stretches of equal words at that distance; smallest period of a stretch wins."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def digest_row(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts():
    rnd = random.Random(11)
    out = []
    for i in range(150):
        parts = []
        for _ in range(rnd.randrange(1, 6)):
            unit = [rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 20]))]
            parts += (unit * rnd.randrange(1, 12))[:rnd.randrange(1, 90)]
            if rnd.random() < .5:
                parts += ["w%d" % rnd.randrange(40) for _ in range(rnd.randrange(20))]
        out.append(rnd.choice([" ", "\n", " \t "]).join(parts))
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    return out + ["", None, " ", "x " * 11, "x " * 12, "x " * 3000, "ab " * 5 + "É é É é " * 4, " ".join(fib[-1]),
                  ("p q " * 7 + "r ") * 9, " ".join("%d" % (i % 37) for i in range(1000))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5))
def test_small_alphabets(docs):
    got = P.find_runs([np.array(d, np.int64) for d in docs], 3, 3)
    for d, runs in zip(docs, got):
        assert sorted(map(tuple, runs.tolist())) == brute(d, 3)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=120), st.randoms(use_true_random=False))
def test_agreement(middle, rnd):
    s = [3, *middle, 4]
    x, y = np.array([sorted(rnd.sample(range(len(s)), 2)) for _ in range(30)]).T
    grammar = Grammar(np.array(s))
    for a, b, f, t in zip(x, y, grammar.agree(x, y), grammar.agree(x, y, forward=False)):
        n = 0
        while b + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        m = 0
        while a - m >= 0 and s[a - m] == s[b - m]:
            m += 1
        assert (f, t) == (n, m)


def test_chunks_of_one_document(monkeypatch):
    words = np.array([i % 7 if i < 300 else i % 50 for i in range(700)])
    whole = P.find_runs([words], 50)[0].tolist()
    monkeypatch.setattr(P, "CHUNK", 64)
    assert P.find_runs([words], 50)[0].tolist() == whole
    assert sorted(map(tuple, whole)) == brute(words.tolist())


def test_query_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "z z " * 10), (7, "z z " * 10), (7, "z z " * 10)]
    df = spark.createDataFrame([(t, "x", i) for i, t in rows], "text string, runs string, doc_id long").repartition(3)
    got = sorted(map(str, map(tuple, P.run_digests(df).collect())))
    assert got == sorted(str(digest_row(i, t)) for i, t in rows)


def test_collapse(spark):
    df = spark.createDataFrame([("d1", "to be or " * 5 + "not"), ("d2", None), (None, "a b")], "k string, body string")
    got = {r["id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.collapse_runs(df, "k", "body").collect()}
    assert got == {"d1": (16, [(0, 15, 3)], "to be or not"), "d2": (0, [], ""), None: (2, [], "a b")}
    assert P.collapse_runs(df.limit(0), "k", "body").collect() == []
