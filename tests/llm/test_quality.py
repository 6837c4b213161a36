"""Held-out accuracy and gradients of the attention model."""

import numpy as np
from pyspark.sql import functions as F

from jobsight.llm import quality
from jobsight.llm.quality import N_FEATURES, fit_quality, fitting, passages, quality_score, train
from jobsight.llm.textops import crc_mod

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = crc_mod(F.col("doc_id"), 3) == 1
    model = fit_quality(docs, labels.filter(~held))
    rows = (docs.join(labels.filter(held), "doc_id")
            .select("quality", (quality_score(F.col("text"), model) >= 0.5).cast("int").alias("p")).collect())
    right = sum(r["quality"] == r["p"] for r in rows) / len(rows)
    bad = [r["p"] for r in rows if not r["quality"]]
    print(len(rows), right, 1 - sum(bad) / len(bad))
    assert right > 0.95 and sum(bad) / len(bad) < 0.2


def test_attention_finds_the_telling_passage():
    rnd = np.random.RandomState(0)
    bags, y = [], []
    for i in range(300):
        b = rnd.normal(0, 1, (rnd.randint(1, 9), 4))
        y.append(i % 2)
        if y[-1]:
            b[rnd.randint(len(b)), 0] = 6
        bags.append(b)
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    model = train(np.concatenate(bags), starts, np.array(y, float))
    f = model.forward(np.concatenate(bags), starts)
    assert ((f["y"] > .5) == np.array(y)).mean() > 0.97
    assert np.allclose(np.add.reduceat(f["alpha"], starts), 1)


def test_defined_results(spark):
    assert passages(None) == passages("") == passages(" \n") == [[0.0] * N_FEATURES]
    assert len(passages("w " * 1_000_000)) == 10_000
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "Some words.", "z"), (2, "", "y")], "doc_id long, text string, label string")
    none = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, quality int")
    assert fit_quality(docs, none) is None
    assert [r[0] for r in docs.select(quality_score(F.col("text"), None)).collect()] == [0.5] * 4
    model = fit_quality(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert all(0 <= r[0] <= 1 for r in docs.select(quality_score(F.col("text"), model)).collect())
    assert docs.limit(0).select(quality_score(F.col("text"), model)).collect() == []


def test_passages_of_the_fit_are_bounded(spark, monkeypatch):
    rows = ([(i, "word " * 450, i % 2) for i in range(60)] + [(100, "copy " * 100, 1)] * 200 + [(101, "long " * 40_000, 0)])
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = docs.select("doc_id", "quality").distinct()
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, starts, y: seen.append((len(x), np.diff(np.r_[starts, len(x)]).tolist(), set(y))))
    fit_quality(docs, labels)
    total, sizes, kinds = seen.pop()
    assert total == 900 and sorted(sizes) == [1] * 200 + [5] * 60 + [400] and kinds == {0.0, 1.0}
    fit_quality(docs, labels, fit_passages=100)
    total, sizes, kinds = seen.pop()
    assert total == 100 and sizes == [5] * 20 and kinds == {0.0, 1.0}  # whole documents


def test_each_label_keeps_a_group():
    assert fitting([(1, 0, 4), (2, 1, 50), (3, 1, 20), (4, 0, 5), (5, 0, 2)], 10) == [(1, 0), (4, 0), (3, 1)]
