"""Extendible hashing against a directory that splits one bucket at a time."""

import hashlib
from collections import Counter, defaultdict

from jobsight.llm import sharding as S


def brute(rows, limit):
    items, seen = [], Counter()
    for i, t in rows:
        name = hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15]
        nth, seen[name] = seen[name], seen[name] + 1
        if nth:
            name = hashlib.md5(f"{name}:{nth}".encode()).hexdigest()[:15]
        items.append((i, len((t or "").encode()), int(name, 16)))
    done, queue = [], [("", [x for x in items if x[1] <= limit])]
    while queue:
        bits, bucket = queue.pop()
        if sum(n for _, n, _ in bucket) <= limit or len(bits) == 60:
            done += [(i, bits, n) for i, n, _ in bucket]
            continue
        halves = defaultdict(list)
        for x in bucket:
            halves[format(x[2], "060b")[len(bits)]].append(x)
        queue += [(bits + b, h) for b, h in halves.items()]
    done += [(i, f"own:{h:015x}", n) for i, n, h in items if n > limit]
    return sorted(done, key=str)


def rows():
    out = [(i, "text " * (i % 37) + str(i)) for i in range(600)]
    out += [(7, "again" * 10)] * 30 + [(None, "no id")] * 3 + [(None, None), (900, ""), (901, "long " * 2000)]
    return out


def test_directory(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows()], "doc_id long, text string, shard string, depth int")
    for limit in (100_000_000, 5000, 700):
        got = S.assign_shards(docs, limit).collect()
        assert sorted(((r["doc_id"], r["shard"], r["n_bytes"]) for r in got), key=str) == brute(rows(), limit)
        sums = defaultdict(int)
        for r in got:
            sums[r["shard"]] += r["n_bytes"]
        assert all(r["shard_bytes"] == sums[r["shard"]] for r in got)
    assert S.assign_shards(docs.limit(0)).collect() == []
    plain = docs.drop("shard", "depth")
    S.write_shards(plain, str(tmp_path / "out"), 5000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows())
    assert sorted(str((r["doc_id"], r["text"])) for r in back.collect()) == sorted(str(r) for r in rows())
    S.write_shards(plain.limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).collect() == []


def test_copies_split(spark):
    """Any number of rows of one id and text fits the limit."""
    docs = spark.createDataFrame([(7, "x" * 1000)] * 700 + [(1, "y")], "doc_id long, text string").repartition(5)
    got = S.assign_shards(docs, 20_000).collect()
    assert len(got) == 701 and max(r["shard_bytes"] for r in got) <= 20_000


def test_deep_buckets_take_more_rounds(spark, monkeypatch):
    monkeypatch.setattr(S, "SPARE_BITS", 0)
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    got = S.assign_shards(docs, 700).collect()
    assert sorted(((r["doc_id"], r["shard"], r["n_bytes"]) for r in got), key=str) == brute(rows(), 700)
