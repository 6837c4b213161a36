"""Collocations against a plain count of all n-grams."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from jobsight.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, longest=3, swallow=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            if any(100 * b >= swallow * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items() if len(q) > len(p)):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def cases(n=260):
    rnd = random.Random(7)
    vocab = ["w%d" % i for i in range(60)] + ["New", "York", "état", "É", "a-b", "\x1f", " x"]
    stock = ["New York City", "of the people", "état  de\tdroit", "x x x x", "Zz yy"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randrange(0, 30)):
            parts.append(rnd.choice(stock) if rnd.random() < .3 else vocab[min(int(rnd.expovariate(.08)), len(vocab) - 1)])
            parts.append(rnd.choice([" ", " ", " ", " ", ". ", "\n", ",", " \t"]))
        rows.append((rnd.choice(["en", "fr", None, "und", "e\tn"]), "".join(parts)))
    return rows + [("en", None), ("en", ""), (None, "..!?"), ("xx", "solo"), ("en", "of the " * 400)] * 2


def frame(spark, rows):
    return spark.createDataFrame([(t, "x", 1.0, lang) for lang, t in rows], "text string, phrase string, a double, lang string").repartition(3)


@pytest.mark.parametrize("least,longest,swallow,top", [(10, 3, 50, 2000), (4, 3, 80, 15), (5, 5, 50, 2000), (3, 2, 50, 50)])
def test_brute_force(spark, least, longest, swallow, top):
    rows = cases()
    got = C.collocations(frame(spark, rows), max_words=longest, least=least, swallow=swallow, top=top).collect()
    assert sorted(map(tuple, got)) == brute(rows, least, longest, swallow, top)


def test_empty(spark):
    assert C.collocations(frame(spark, cases()).limit(0)).collect() == []
    assert C.collocations(frame(spark, [("en", None), (None, "")])).collect() == []


def test_large_products(spark):
    """Scores are exact where the products pass 64 bits."""
    from pyspark.sql import functions as F
    rows = [(4_000_000_007, 5_000_000_009, 6_000_000_011), (9_999_999_999_999, 9_999_999_999_999, 9_999_999_999_999)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    assert [r[0] for r in df.select(F.expr(C.SCORE)).collect()] == [10**6 * a * a // (l * r) for a, l, r in rows]


def fold(keyed):
    """What the task steps make of counted cells, without Spark."""
    import pyarrow as pa
    keyed = sorted(keyed)
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in keyed]), pa.array([p for _, p in keyed], pa.binary())], schema=C.KEYED)
    return iter([batch])


def test_sparse_tiles_and_many_blocks():
    """Ids far beyond the dense tiles, blocks in several groups, bundles held and summed in steps."""
    import pyarrow as pa
    rnd = np.random.RandomState(1)
    blocks, want = [], Counter()
    for b in range(12):
        ids = (rnd.zipf(1.3, 4000) % 200_000).astype(np.int64)
        ids[rnd.rand(4000) < .1] = -1
        ids, = C.unbroken(ids)
        blocks.append((b, "en", C.pack(C.narrow(ids), C.narrow(ids))))
        want.update((x, y) for x, y in zip(ids.tolist(), ids[1:].tolist()) if x >= 0 and y >= 0)
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*blocks), C.CODED_SCHEMA)], schema=C.CODED_SCHEMA)
    rows = [tuple(r.values()) for out in C.tiled(2, 3, 4)(iter([batch])) for r in out.to_pylist()]
    dense = [tuple(r.values()) for out in C.group_tiles(fold([r for r in rows if r[0][0] != "#"])) for r in out.to_pylist()]
    sparse = [r for r in rows if r[0][0] == "#"]
    assert dense and sparse
    got = {(r["left"], r["right"]): r["a"] for out in C.frequent_cells(3)(fold(dense + sparse)) for r in out.to_pylist()}
    assert got == {p: a for p, a in want.items() if a >= 3}


def test_texts_are_cut_at_blanks(monkeypatch):
    text = "One two\tthree, four\nfive " * 30 + "x" * 300 + " end"
    whole = C.numbered(text, C.Numbers())
    monkeypatch.setattr(C, "PIECE", 40)
    parts = C.numbered(text, C.Numbers())
    assert len(parts) > len(whole)
    assert np.array_equal(np.concatenate(whole), np.concatenate(parts))
