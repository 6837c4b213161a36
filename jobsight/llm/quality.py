"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words; only the document
is labelled.  Every passage is encoded from its character classes, its word
lengths and its repetitions by a small tanh layer.  Gated attention (tanh times
sigmoid) gives each passage a weight within its document, the weighted sum of
the encodings represents the document, and a logistic unit scores it.

Training runs on the driver on the features of a sample of labelled
documents, bounded in documents and in passages; scoring reads every passage of every document in Arrow batches.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.llm.store import written
from jobsight.llm.toxicity import labelled_sample

PASSAGE_WORDS = 100
#: Labelled documents that the model is fitted on, about.
FIT_DOCUMENTS = 8_000
#: Passages of these documents that the driver trains on, at most.
FIT_PASSAGES = 120_000
#: Groups of labelled documents, by a hash of the id, that are taken or left as a whole.
GROUPS = 65_536
#: Documents whose passages are taken together when scoring.
SCORE_DOCUMENTS = 256
HIDDEN, GATE, STEPS, RATE, RIDGE = 16, 8, 400, 0.02, 1e-4


def _classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 sentence sign, 6 bar, 7 other sign, 8 beyond ASCII."""
    out = np.zeros(256, np.int64)
    out[97:123], out[65:91], out[48:58], out[128:] = 1, 2, 3, 8
    out[33:48] = out[58:65] = out[91:97] = out[123:127] = 7
    out[[ord(c) for c in ".,;:?'\"()-"]] = 5
    out[[9, 10, 13, 32]] = 4
    out[ord("|")] = 6
    return out


CLASSES = _classes()
N_FEATURES = 20


def passage_features(words: list[str]) -> list[float]:
    """Features of one passage; all zero for none."""
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    share = np.bincount(CLASSES[data], minlength=9) / len(data)
    counts = Counter(words)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    top = counts.most_common(1)[0][1]
    repeated = sum(a == b for a, b in zip(words, words[1:])) / n
    return [*share[1:], len(counts) / n, top / n, repeated, mean / 10, max(lengths) / 50 if max(lengths) < 500 else 10.0,
            math.sqrt(sum((x - mean) ** 2 for x in lengths) / n) / 5,
            sum(w[0].isupper() for w in words) / n, sum(w.isupper() for w in words) / n,
            sum(not w[-1].isalnum() for w in words) / n, sum(w[-1] in ".?!" for w in words) / n,
            sum(len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum() for w in words) / n,
            math.log1p(n) / 5]


def passages(text: str | None) -> list[list[float]]:
    """Features of all passages of a text; a text without words is one empty passage."""
    words = (text or "").split()
    return [passage_features(words[i:i + PASSAGE_WORDS]) for i in range(0, max(1, len(words)), PASSAGE_WORDS)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Scaling and weights: encoder (w, b), gates (v, u), attention (a), output (c, d)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.weights, np.diff(np.r_[starts, len(x)])
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        alpha = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(alpha[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "g": g, "alpha": alpha, "z": z, "y": sigmoid(z @ p["c"] + p["d"][0]), "sizes": sizes}

    def score(self, texts: list[str | None]) -> np.ndarray:
        bags = [passages(t) for t in texts]
        if not bags:
            return np.zeros(0)
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return self.forward(np.array([f for b in bags for f in b]), starts)["y"]


def train(x: np.ndarray, starts: np.ndarray, y: np.ndarray, steps: int = STEPS) -> AttentionModel:
    """Fit by Adam on all bags at once; deterministic."""
    rnd = np.random.RandomState(7)
    shape = {"w": (x.shape[1], HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "d": (1,)}
    p = {k: rnd.normal(0, 0.3, s) if k not in "bd" else np.zeros(s) for k, s in shape.items()}
    model = AttentionModel(x.mean(axis=0), x.std(axis=0) + 1e-3, p)
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        f = model.forward(x, starts)
        h, t, g, alpha, sizes = f["h"], f["t"], f["g"], f["alpha"], f["sizes"]
        dy = (f["y"] - y) / len(y)
        dz = np.repeat(dy, sizes)[:, None] * p["c"]
        dalpha = (dz * h).sum(axis=1)
        de = alpha * (dalpha - np.repeat(np.add.reduceat(alpha * dalpha, starts), sizes))
        dt, dg = de[:, None] * p["a"] * g * (1 - t * t), de[:, None] * p["a"] * t * g * (1 - g)
        dh = (alpha[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
        grad = {"w": f["x"].T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
                "c": f["z"].T @ dy, "d": np.array([dy.sum()])}
        for k in p:
            gr = grad[k] + RIDGE * p[k]
            m[k] = 0.9 * m[k] + 0.1 * gr
            v[k] = 0.999 * v[k] + 0.001 * gr * gr
            p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fitting(sizes: list[tuple[int, int, int]], most: int) -> list[tuple[int, int]]:
    """Of groups (number, label, passages) those that fit into ``most`` passages, by their number; each label keeps its smallest at least."""
    out, left = [], most
    for number, label, size in sorted(sizes):
        if size <= left:
            out.append((number, label))
            left -= size
    for label in sorted({s[1] for s in sizes} - {o[1] for o in out}):
        out.append(min((s for s in sizes if s[1] == label), key=lambda s: (s[2], s[0]))[:2])
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", fit_documents: int = FIT_DOCUMENTS,
                fit_passages: int = FIT_PASSAGES) -> AttentionModel | None:
    """Fit on ``labels`` (pass only rows that may be learned from); None without labels.

    If the sampled documents have more than ``fit_passages`` passages, whole documents
    (all rows of an id) are chosen by a hash of the id as long as they fit.  Only where
    no document of a label fits is the bound exceeded, by the smallest group of that label.
    """
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"].astype(str), "part": batch["part"], "label": batch["label"],
                                "bag": [np.array(passages(t), np.float32).ravel() for t in batch["text"]]})

    sample = labelled_sample(docs, labels, label_col, id_col, text_col, fit_documents).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.lit(GROUPS)).cast("int"))
    bagged = written(sample.mapInPandas(measure, "id string, part int, label int, bag array<float>"), "quality-sample")
    sizes = [tuple(r) for r in bagged.groupBy("part", "label").agg(
        F.sum(F.size("bag") / N_FEATURES).cast("long")).collect()]  # two rows a group at most
    if sum(s[2] for s in sizes) > fit_passages:
        taken = docs.sparkSession.createDataFrame(fitting(sizes, fit_passages), "part int, label int")
        bagged = bagged.join(F.broadcast(taken), ["part", "label"])
    rows = bagged.select("id", "label", "bag").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["id"], len(r["bag"]), r["bag"]))
    bags = [np.array(r["bag"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    return train(np.concatenate(bags).astype(np.float64), starts, np.array([r["label"] for r in rows], float))


def quality_score(text: Column, model: AttentionModel | None) -> Column:
    """Score column, 0 to 1 (higher: label 1 likelier); null and empty texts are one empty passage.

    Without a model every score is 0.5.
    """
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if model is None:
                yield pd.Series(np.full(len(batch), 0.5))
                continue
            texts = batch.tolist()
            yield pd.Series(np.concatenate([np.zeros(0), *(model.score(texts[i:i + SCORE_DOCUMENTS])
                                                            for i in range(0, len(texts), SCORE_DOCUMENTS))]))

    return score(text)
