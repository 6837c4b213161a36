"""Exact duplicates against a brute-force grouping."""

import hashlib
from collections import defaultdict

import pytest

from jobsight.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "block of text " * 40
ROWS = [(1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, " "), (7, LONG), (8, LONG.upper()), (9, LONG + "x"),
        (10, "x" + LONG), (11, "Été"), (12, "été"), (13, "ÉTé"), (None, "abc"), (None, "only null"),
        (14, "same"), (14, "same"), (15, "\U0001f600" * 50), (16, "\U0001f600" * 50), (17, LONG[:64]), (18, LONG[:128])]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4096, 64, 7])
def test_groups(spark, block):
    docs = spark.createDataFrame([(i, t, 1, "s", "k") for i, t in ROWS], "doc_id long, text string, level int, sha string, name string")
    got = sorted((tuple(r) for r in exact_duplicates(docs, block_chars=block).collect()), key=str)
    assert got == brute(ROWS)


def test_dropped_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in ROWS], "doc_id long, text string, sha string")
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    want = sorted(((i, (h, n)) for i, k, n, kept, h in brute(ROWS) if kept), key=str)
    assert len(want) == left.count()
    assert sorted(map(str, (i for i, _ in want))) == sorted(str(r["doc_id"]) for r in left.collect())
    assert exact_duplicates(docs.limit(0)).collect() == []
    assert drop_exact_duplicates(docs.limit(0)).collect() == []
