"""The pipeline on planted cases against a brute-force version of its stages."""

import hashlib
import random
import re

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

from jobsight.llm.piece_bpe import MergeCodec  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def planted():
    """(id, text) rows, labels, items, and the ids of toxic documents."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) + "é" * (i % 7 == 0) for i in range(600)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(prose(rnd.randrange(18, 30)))) for i in range(8)]
    docs, toxic = [], set()
    for i in range(240):
        docs.append((i, " ".join(prose(rnd.randrange(30, 90)))))
    for i in range(240, 300):
        w = prose(rnd.randrange(30, 70))
        for _ in range(3):
            w.insert(rnd.randrange(len(w)), rnd.choice(["idiot", "Idiot", "1diot", "scum"]))
        docs.append((i, " ".join(w)))
        toxic.add(i)
    for i in range(300, 330):
        docs.append((i, docs[i - 300][1].upper().replace("É", "é") if i % 2 else docs[i - 300][1]))
    for i in range(330, 360):
        w = docs[40 + (i - 330) // 3][1].split()
        w[rnd.randrange(len(w))] = "changed"
        docs.append((i, ("  " if i % 2 else " ").join(w)))
    for i in range(360, 376):
        docs.append((i, " ".join(prose(20) + [rnd.choice(items)[1].upper()] + prose(20))))
    docs += [(376, ""), (377, None), (378, "one"), (379, "two words")]
    labels = [(i, 1, int(i in toxic)) for i in range(0, 300) if i % 3]
    return docs, labels, items, toxic


def brute(docs, items, toxic):
    left = [(i, t) for i, t in docs if i not in toxic]
    best = {}
    for i, t in left:
        key = (t or "").translate(LOWER)
        best[key] = max(best.get(key, i), i)
    left = [(i, t) for i, t in left if best[(t or "").translate(LOWER)] == i]

    def shingles(t):
        w = WORD.findall((t or "").translate(LOWER))
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in left]
    parent = list(range(len(left)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(left)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    first = {}
    for a, (i, _) in enumerate(left):
        first[find(a)] = min(first.get(find(a), i), i)
    left = [(i, t) for a, (i, t) in enumerate(left) if not sets[a] or first[find(a)] == i]

    letters = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for _, t in items:
        w = letters.findall(t.translate(LOWER))
        windows.update(tuple(w[k:k + 13]) for k in range(len(w) - 12))

    def contaminated(t):
        w = letters.findall((t or "").translate(LOWER))
        hit = {p for k in range(len(w) - 12) if tuple(w[k:k + 13]) in windows for p in range(k, k + 13)}
        return bool(hit) and 20 * len(hit) >= len(w)

    return [(i, t) for i, t in left if not contaminated(t)]


def test_run(spark, tmp_path):
    docs, labels, items, toxic = planted()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    library = MergeCodec(public_tokenizers.path("piece_bpe_32k.model")).library
    want = []
    for i, t in brute(docs, items, toxic):
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert 200 < len(want) < 290


def test_stages_keep_the_columns(spark, tmp_path):
    docs, labels, items, _ = planted()
    base = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs[:40]], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, base, str(tmp_path))
        assert out.columns == base.columns and out.dtypes == base.dtypes
