"""Winnowing against brute-force windows."""

import random
import re

from jobsight.llm.decontaminate import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    windows = []
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        windows += [(str(i) if i is not None else "null", tuple(w[k:k + n])) for k in range(len(w) - n + 1) if n]
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found.add(item)
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def cases():
    rnd = random.Random(5)
    vocab = ["w%d" % i for i in range(300)] + ["Été", "naïve", "X"]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, prose(rnd.choice([3, 5, 12, 13, 14, 20, 40, 60]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "..."), (None, prose(20)), (7, prose(30)), (103, "same " * 15), (104, items[6][1])]
    docs = []
    for i in range(60):
        parts = [prose(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(0, 3)):
            w = words(rnd.choice(items)[1])
            if w:
                a = rnd.randrange(0, max(1, len(w) - 10))
                parts += [rnd.choice([",  ", "\n"]).join(x.upper() if rnd.random() < .3 else x for x in w[a:a + rnd.randrange(10, 40)])
                          if rnd.random() < .7 else " ".join(w), prose(rnd.randrange(0, 30))]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (None, items[6][1]), (None, items[6][1]), (5, "other text"), (202, "same " * 40)]
    return docs, items


def test_brute_force(spark):
    docs, items = cases()
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, fp int")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    got = contamination(d, b).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["item_ids"]), r["contaminated"]) for r in got), key=str) == brute(docs, items)
    left = drop_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(x[0]) for x in brute(docs, items) if not x[4])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in contamination(d, b).collect()] == [(3, 0, False)]
    assert contamination(d.limit(0), b).collect() == []
