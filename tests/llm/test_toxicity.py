"""Folding, matching, and held-out accuracy of the toxicity score."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from jobsight.llm.store import sampled
from jobsight.llm.textops import crc_mod
from jobsight.llm.toxicity import (LEAST_WEIGHT, WHOLE, ToxicityModel, chosen, features, fit_toxicity, fold, labelled_sample,
                                   lower_bound, toxicity_score)

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("text", ["idiot", "IDIOT", "1d10t", "іdiоt", "ídïöt", "idi​ot", "ⅰdiot", "id!ot", "idⅰot", "ｉｄｉｏｔ"])
def test_variants_fold_to_the_word(text):
    assert fold(text) == fold("idiot")


def test_boundaries_exceptions_and_length():
    a = ToxicityModel({fold("trash"): 3.0}, ("trash can",)).automaton()
    whole = ToxicityModel({fold("trash") + WHOLE: 3.0}).automaton()
    assert features("a trash", whole)[2] and not features("a trashy", whole)[2]
    both = ToxicityModel({fold("tra"): 1.0, fold("trash") + WHOLE: 3.0}).automaton()
    assert features("trash", both)[0] == features("trash", whole)[0]  # a word counts once
    hit = lambda t: features(t, a)[2]
    assert hit("you tr4sh!") and hit("TRASH") and hit("tra$h")
    assert hit("trashy") and not hit("mytrash") and not hit("a trash can here") and not hit("")
    assert hit("a trash can is trash")
    assert features("trash", a)[1] > features("trash" + " word" * 500, a)[1]
    assert features("trash " * 200000, a)[0] > 10


def test_defined_results(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "scum", "z"), (2, "", "y")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    assert model.lexicon == {}
    got = docs.select("doc_id", toxicity_score(F.col("text"), model).alias("s")).collect()
    assert len(got) == 4 and all(0 <= r["s"] < 0.3 for r in got)
    assert docs.limit(0).select(toxicity_score(F.col("text"), model)).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = fit_toxicity(docs, labels.filter(~held))
    rows = (docs.join(labels.filter(held), "doc_id")
            .select("lang", "toxic", (toxicity_score(F.col("text"), model) >= 0.3).cast("int").alias("p")).collect())
    right = sum(r["toxic"] == r["p"] for r in rows) / len(rows)
    recall = sum(r["p"] for r in rows if r["toxic"]) / sum(r["toxic"] for r in rows)
    assert right > 0.97 and recall > 0.85
    assert sum(r["p"] for r in rows if not r["toxic"]) <= 0.005 * len(rows)


def test_every_word_of_a_large_lexicon(spark):
    pairs = ["".join(x) for x in itertools.product("bcdfghjkmnprstvwyz", repeat=2)]
    toxic = [a + b + "unepar" for a, b in itertools.product(pairs[:20], repeat=2)]  # 8 entries a word, 3,200 in all
    clean = [a + b + "omesat" for a, b in itertools.product(pairs[20:40], repeat=2)]
    texts = [(" ".join(f"{p} {w}" for w in toxic), 1) for p in pairs[:30]] + [(" ".join(f"{p} {w}" for w in clean), 0) for p in pairs]
    rows = [(i, t, y) for i, (t, y) in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    automaton = model.automaton()
    assert all(features(w, automaton)[2] for w in toxic) and not any(features(w, automaton)[2] for w in clean)


def test_chosen_against_all_pairs():
    rnd = random.Random(5)
    for _ in range(200):
        names = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 6))) + rnd.choice(["", WHOLE]) for _ in range(25)}
        counts = {n: (rnd.randint(3, 200), rnd.randint(0, 3)) for n in names}
        entries = [(n, *c, lower_bound(*c, 2000, 20000)) for n, c in counts.items()]
        want = {}
        for name, n1, n0, weight in sorted(entries, key=lambda e: (-e[3], -len(e[0]), e[0])):
            longer = [counts[x] for x in want if x.startswith(name)]
            if longer:
                weight = lower_bound(max(0, n1 - sum(c[0] for c in longer)), max(0, n0 - sum(c[1] for c in longer)), 2000, 20000)
            if weight >= LEAST_WEIGHT and not any(name.startswith(x) for x in want):
                want[name] = weight
        assert chosen(entries, 2000, 20000) == want


def test_sample_of_any_share(spark):
    ids = spark.range(4_000_000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.lit(1).alias("toxic"))
    assert 0 < labelled_sample(ids, ids, "toxic", "doc_id", "text", 3).count() < 12  # below one in a million
    assert 900 < ids.filter(sampled(F.xxhash64("doc_id"), 1_000, 4_000_000)).count() < 1_100
    for n in (8_000_000_001, 10**13, 10**18):  # the least hash is in the sample at any size
        least = spark.range(1).select(sampled(F.lit(-2**63), 8_000, n).alias("least"), sampled(F.lit(2**63 - 1), 8_000, n).alias("most"))
        assert tuple(least.first()) == (True, False)
    assert ids.limit(10).filter(sampled(F.xxhash64("doc_id"), 10, 10)).count() == 10
