"""Jaccard components against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from jobsight.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, size):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i:i + min(size, len(w))]) for i in range(len(w) - min(size, len(w)) + 1)} if w else set()


def brute(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def cases(seed):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(150)] + ["É", "ß."]
    shared = " ".join(rnd.choice(vocab) for _ in range(60))
    bases = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 9, 12, 30, 60, 120, 300]))] for _ in range(30)]
    docs = []
    for i in range(220):
        w = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 9])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        if rnd.random() < .2:
            w = [x.upper() for x in w]
        text = rnd.choice([" ", "\n", "\t "]).join(w)
        docs.append((i * 3 + 1, text + (" " + shared if rnd.random() < .3 else "")))
    return docs + [(2, None), (5, ""), (8, " \n"), (11, "one"), (14, "One"), (None, docs[0][1]), (None, "nothing like it at all"),
                   (docs[3][0], docs[3][1]), (docs[3][0], docs[3][1])]


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_components(spark, monkeypatch, size, percent):
    monkeypatch.setattr(J, "BLOCK_ROWS", 7)
    docs = cases(size)
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n int, cls string")
    got = J.near_duplicates(frame, shingle=size, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    want = brute(docs, size, percent)
    assert max(Counter(c for _, _, c in want).values()) > 4
    assert sorted(map(tuple, got), key=str) == want


def test_stage_keeps_one_of_each_component(spark):
    docs = cases(9)
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, cls string")
    left = J.drop_near_duplicates(frame)
    assert left.columns == frame.columns
    comps = {c for d, n, c in brute(docs, 5, 80) if n and c is not None}
    got = [r["doc_id"] for r in left.collect() if r["text"] and r["text"].strip() and r["doc_id"] is not None]
    assert sorted(got) == sorted(comps)
    assert J.drop_near_duplicates(frame.limit(0)).collect() == []


def test_linked_sets_meet_in_a_tile():
    rnd = np.random.RandomState(1)
    for percent in (80, 85):
        for n in [6, 7, 8, 20, 33, 100, 333, 1000]:
            for _ in range(60):
                a = np.unique(rnd.randint(0, 1 << 62, n).astype(np.uint64) * np.uint64(3))
                most = (100 - percent) * 2 * len(a) // (100 + percent)
                gone = rnd.randint(0, most + 1)
                b = np.union1d(np.delete(a, rnd.choice(len(a), gone, replace=False)),
                               rnd.randint(0, 1 << 62, most - gone).astype(np.uint64))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                    assert len(np.intersect1d(J.tile_keys(a, percent), J.tile_keys(b, percent)))


def test_shared_tiles_across_batches():
    rnd = random.Random(3)
    for _ in range(200):
        rows = sorted((rnd.randrange(6), rnd.randrange(4)) for _ in range(rnd.randrange(0, 25)))
        batches, at = [], 0
        while at < len(rows):
            n = rnd.randrange(1, 5)
            k, c = zip(*rows[at:at + n])
            batches.append(pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c, pa.int64())], names=["key", "c"]))
            at += n
        got = sorted(tuple(r.values()) for b in J.shared_tiles(iter(batches)) for r in b.to_pylist())
        want = sorted((k, c, min(x for y, x in rows if y == k)) for k, c in set(rows) if len({x for y, x in rows if y == k}) > 1)
        assert got == want


def test_short_sets_with_empty_ranges_meet():
    """Sets that leave many ranges empty enter further orders, and still meet whom they link with."""
    rnd = np.random.RandomState(2)
    further = 0
    for n in (7, 8, 9, 12):
        k, m, cuts = J.band_plan(int(np.searchsorted(J.band_edges(80), n, side="right")) - 1, 80)
        for _ in range(4000):
            a = np.unique(rnd.randint(0, 1 << 62, n).astype(np.uint64) * np.uint64(5))
            empty = m - len(np.unique(np.searchsorted(cuts, a)))
            further += empty >= m - k
            b = np.union1d(a[1:], rnd.randint(0, 1 << 62, 1).astype(np.uint64)) if rnd.rand() < .5 else a[1:]
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert len(np.intersect1d(J.tile_keys(a, 80), J.tile_keys(b, 80)))
    assert further > 20


def test_folded_bitmaps_bound_the_difference():
    rnd = np.random.RandomState(3)
    for _ in range(200):
        a = np.unique(rnd.randint(0, 1 << 62, rnd.randint(1, 400)).astype(np.uint64))
        b = np.union1d(a[:rnd.randint(0, len(a) + 1)], rnd.randint(0, 1 << 62, rnd.randint(0, 200)).astype(np.uint64))
        x, y = (np.frombuffer(J.parity_bitmap(s), np.uint64) for s in (a, b))
        words = min(len(x), len(y))
        differ = int(np.bitwise_count(J.folded(x, words) ^ J.folded(y, words)).sum())
        assert differ <= len(np.setxor1d(a, b))
        assert differ % 2 == len(np.setxor1d(a, b)) % 2


def test_pairs_that_do_not_link_are_not_listed():
    """Long texts of one origin below the threshold: the bitmaps tell them apart."""
    rnd = np.random.RandomState(4)
    base = np.unique(rnd.randint(0, 1 << 62, 4000).astype(np.uint64))
    sets = [np.union1d(np.delete(base, rnd.choice(len(base), 320, replace=False)), rnd.randint(0, 1 << 62, 320).astype(np.uint64)) for _ in range(40)]
    bits = [np.frombuffer(J.parity_bitmap(s), np.uint64) for s in sets]
    words = min(map(len, bits))
    found = list(J.group_pairs(np.arange(40), np.arange(40), np.array([len(s) for s in sets]), np.zeros(40, int),
                               np.stack([J.folded(b, words) for b in bits]), 85, None))
    assert found == []


@pytest.mark.parametrize("percent", [70, 80, 85, 90])
def test_sets_of_all_sizes_need_few_orders(percent):
    """Also the smallest sets of a band find enough ranges that are not empty."""
    rnd = np.random.RandomState(5)
    for n in [*range(1, 40), *(int(1.07 ** i) for i in range(55, 150))]:
        a = np.unique(rnd.randint(0, 1 << 62, n).astype(np.uint64) * np.uint64(7))
        own = int(np.searchsorted(J.band_edges(percent), len(a), side="right")) - 1
        most = sum(J.band_plan(b, percent)[1] for b in (own, own + 1))
        assert len(J.tile_keys(a, percent)) <= 8 * most + 8
