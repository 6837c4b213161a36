"""Repeated lines against brute force; the perfect hash against a dictionary."""

import random
from collections import Counter

import numpy as np
import pytest

from jobsight.llm import line_dedup as L
from jobsight.llm.perfect_hash import PerfectHash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)


def brute(rows, least, chars):
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < chars or held[key(x)] < least]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(map(str, out))


def cases():
    rnd = random.Random(3)
    common = ["Follow us", " follow us\t", "FOLLOW US\r", " nbsp kept", "É", "é", "ab", "", "  ", "\x0b\x0c", "\x1f", "x" * 5000]
    rows = []
    for i in range(120):
        lines = [rnd.choice(common) if rnd.random() < .4 else "line %d" % rnd.randrange(90) for _ in range(rnd.randrange(0, 12))]
        rows.append((i, "\n".join(lines)))
    return rows + [(500, None), (501, ""), (502, "\n\n"), (None, "Follow us\nown"), (None, "Follow us\nown"), (7, "again\n" * 40), (503, "\n".join("deep %d" % i for i in range(3000)))]


@pytest.mark.parametrize("least,chars,small", [(10, 1, False), (3, 3, True), (1, 1, True), (1000, 1, False)])
def test_brute_force(spark, monkeypatch, least, chars, small):
    if small:  # many blocks and shards
        monkeypatch.setattr(L, "SHARD_LINES", 8)
        monkeypatch.setattr(L, "BLOCK_DOCS", 5)
    rows = cases()
    df = spark.createDataFrame([(1.5, t, i, "k") for i, t in rows], "r1 double, text string, doc_id long, dropped string").repartition(3)
    out = L.drop_repeated_lines(df, min_docs=least, min_chars=chars)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert sorted(str((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"])) for r in out.collect()) == brute(rows, least, chars)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.drop_repeated_lines(df).collect() == []
    assert L.line_digests(df).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_index_counts_every_line_once(spark):
    rows = cases()
    df = spark.createDataFrame([(i, i, t) for i, (_, t) in enumerate(rows)], "a long, b long, text string").repartition(4)
    blocks = df.mapInArrow(L.to_blocks(1), "block long, n_keys long, payload binary")
    n = sum(r["n_keys"] for r in L.line_index(blocks, 3).collect())
    assert n == len({key(x) for _, t in rows for x in (t or "").split("\n")} - {""})


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.random.RandomState(n).permutation(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    index = PerfectHash.build(keys)
    assert sorted(index.find(keys).tolist()) == list(range(n))
    assert len(index.words) * 64 <= max(64 * 3, 5 * n)


def test_perfect_hash_rejects_repeats():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], np.uint64))
