"""Toxicity by a weighted lexicon matched with Aho-Corasick on folded text.

Folding maps letters that look alike (Cyrillic and Greek look-alikes, accented
and full-width letters, digits and signs that stand for letters) to one symbol,
so that "1dіöt" and "idiot" are the same word; i, l, 1 and | share a symbol.  The
lexicon holds words and stems (beginnings of words) of labelled documents; the
weight is the lower confidence bound of the log-odds.  What counts is not how
many documents hold a word but in how many contexts (previous words) it stands,
so that copies of a document count once.  A word counts with its best entry, and
hits inside an exception phrase do not count.  The score is a logistic function of the summed weights, of the weights
normalised by length, and of whether there is a hit at all, fitted on the same
labelled documents.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.llm.store import sampled, written

# Letters and digits that stand for a Latin letter.
LOOKS_LIKE = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i", "|": "i",
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "i", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ß": "ss",
}
# Signs that stand for a letter inside a word only.
INSIDE = (("$", re.compile(r"\$(?=\w)"), "s"), ("@", re.compile(r"@(?=\w)"), "a"),
          ("!", re.compile(r"(?<=\w)!(?=\w)"), "i"), ("*", re.compile(r"(?<=\w)\*(?=\w)"), ""))
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bag", "clown fish", "idiot proof", "stupid simple", "sore loser board")
#: Labelled documents that the lexicon and the score are fitted on, about.
FIT_DOCUMENTS = 20_000
#: A word or stem enters with this weight (natural log-odds, lower 99 % bound) or more.
LEAST_WEIGHT = 2.0
#: Letters of a stem.
STEM = (4, 10)
#: Ends an entry that is a whole word.
WHOLE = "$"


def fold_table() -> dict[int, str | None]:
    """Lower-case, strip accents, fold look-alikes; zero-width signs vanish."""
    out: dict[int, str | None] = {cp: None for cp in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
    for cp in [*range(0x20, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0x2160, 0x2180), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        folded = "".join(LOOKS_LIKE.get(c, c) for c in plain.lower())
        if folded != chr(cp) and folded.strip():
            out[cp] = folded
    out.update({cp: None for cp in range(0x300, 0x370)})
    return out


FOLD = fold_table()


def fold(text: str) -> str:
    for sign, pattern, letter in INSIDE:
        if sign in text:
            text = pattern.sub(letter, text)
    return text.translate(FOLD)


@dataclass
class ToxicityModel:
    """Lexicon (folded stem, or word and ``WHOLE``, to weight), exception phrases and the score's coefficients."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: list[float] = field(default_factory=lambda: [-3.0, 1.0, 10.0, 2.0])

    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton()
        entries: dict[str, list[float]] = {}  # weight as a stem, as a whole word
        for name, weight in self.lexicon.items():
            whole = name.endswith(WHOLE)
            entries.setdefault(name.removesuffix(WHOLE), [0.0, 0.0])[whole] = weight
        for phrase in map(fold, self.exceptions):
            entries.setdefault(phrase, [0.0, 0.0])
        for name, (stem, whole) in entries.items():
            found.add_word(name, (stem, whole, len(name)))
        if len(found):
            found.make_automaton()
        return found


def features(text: str, automaton) -> tuple[float, float, float]:
    """Summed weights (log), weights per word, and 1 if anything was hit."""
    folded = fold(text)
    hits: dict[int, tuple[int, float]] = {}  # of a word's start: its end and best weight
    spared: list[tuple[int, int]] = []
    if len(automaton):
        for end, (stem, whole, size) in automaton.iter(folded):
            start = end + 1 - size
            if start and folded[start - 1].isalnum():
                continue
            ends = end + 1 == len(folded) or not folded[end + 1].isalnum()
            weight = max(stem, whole) if ends else stem
            if weight > hits.get(start, (0, 0.0))[1]:
                hits[start] = end, weight
            if ends and not stem and not whole:
                spared.append((start, end))
    total = sum(w for s, (e, w) in hits.items() if not any(a <= s and e <= b for a, b in spared))
    if not total:
        return 0.0, 0.0, 0.0
    return math.log1p(total), total / (len(folded.split()) + 20.0), 1.0


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> list[float]:
    """Ridge logistic regression by Newton steps; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                    most: int) -> DataFrame:
    """``id, label, text`` of about ``most`` labelled documents, chosen by a hash of the id.

    Rows without id or label are no labels; an id labelled twice takes the larger.
    The chosen ids are broadcast: their number is bounded by ``most``.
    """
    usable = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    usable = usable.filter(sampled(F.xxhash64("id"), most, usable.count()))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(usable), "id")


def lower_bound(n1: float, n0: float, all1: float, all0: float) -> float:
    """Lower 99 % bound of the log-odds of toxic against other contexts."""
    cells = n1 + 0.5, n0 + 0.5, all1 - n1 + 0.5, all0 - n0 + 0.5
    return math.log(cells[0] / cells[2]) - math.log(cells[1] / cells[3]) - 2.58 * math.sqrt(sum(1 / c for c in cells))


def chosen(entries: list[tuple[str, int, int, float]], all1: int, all0: int) -> dict[str, float]:
    """Entries (name, toxic and other contexts, weight) that say something beyond better ones.

    By falling weight: an entry is left out if a chosen stem begins it, and a
    stem whose longer forms are chosen has to stand on the contexts they leave.
    """
    out: dict[str, float] = {}
    taken: dict[str, list[int]] = {}  # contexts of the chosen entries that begin with a name
    for name, n1, n0, weight in sorted(entries, key=lambda e: (-e[3], -len(e[0]), e[0])):
        if any(name[:k] in out for k in range(1, len(name))):
            continue
        if name in taken:
            weight = lower_bound(max(0, n1 - taken[name][0]), max(0, n0 - taken[name][1]), all1, all0)
        if weight >= LEAST_WEIGHT:
            out[name] = weight
            for k in range(1, len(name)):
                sums = taken.setdefault(name[:k], [0, 0])
                sums[0], sums[1] = sums[0] + n1, sums[1] + n0
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", exceptions: tuple[str, ...] = EXCEPTIONS,
                 fit_documents: int = FIT_DOCUMENTS) -> ToxicityModel:
    """Learn lexicon and score from ``labels`` (pass only rows that may be learned from).

    Without usable labels of both kinds the lexicon is empty and scores are low.
    Every entry of ``LEAST_WEIGHT`` or more is considered; their number is bounded
    by the words of the about ``fit_documents`` documents.
    """
    sample = labelled_sample(docs, labels, label_col, id_col, text_col, fit_documents)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = set()
            for y, t in zip(batch["label"], batch["text"]):
                found = re.findall(r"\w+", fold(t))
                seen.update(zip(found, ["", *found], repeat(int(y))))
            yield pd.DataFrame([x for x in seen if 2 < len(x[0]) <= 40], columns=["word", "before", "label"])

    model = ToxicityModel({}, exceptions)
    kinds = {r["label"] for r in sample.select("label").distinct().collect()}
    if kinds != {0, 1}:
        return model
    contexts = (sample.select("label", "text").mapInPandas(words, "word string, before string, label int").distinct()
                .groupBy("word").agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0")))
    contexts = written(contexts, "words")
    whole = contexts.agg(F.sum("n1"), F.sum("n0")).first()
    low, high = STEM
    names = F.concat(F.array(F.concat("word", F.lit(WHOLE))), F.when(F.length("word") >= low, F.transform(
        F.sequence(F.lit(low), F.least(F.length("word"), F.lit(high))), lambda n: F.substring("word", F.lit(1), n)))
        .otherwise(F.array().cast("array<string>")))
    counted = contexts.select(F.explode(names).alias("name"), "n1", "n0").groupBy("name").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    in1, in0 = F.col("n1") + 0.5, F.col("n0") + 0.5
    not1, not0 = whole[0] - F.col("n1") + 0.5, whole[1] - F.col("n0") + 0.5
    odds = F.log(in1 / not1) - F.log(in0 / not0)
    error = F.sqrt(1 / in1 + 1 / in0 + 1 / not1 + 1 / not0)
    top = (counted.filter("n1 >= 3").select("name", "n1", "n0", (odds - 2.58 * error).alias("weight"))
           .filter(F.col("weight") >= LEAST_WEIGHT)).collect()
    model.lexicon = chosen([(r["name"], r["n1"], r["n0"], r["weight"]) for r in top], whole[0], whole[1])
    if not model.lexicon:
        return model

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = model.automaton()
        for batch in batches:
            got = pd.DataFrame([features(t, automaton) for t in batch["text"]], columns=["a", "b", "c"])
            yield got.assign(label=batch["label"].to_numpy())

    # documents without a hit all look alike: they are counted, the others (of the sample) collected
    seen = sample.select("label", "text").mapInPandas(measured, "a double, b double, c double, label int")
    rows = seen.groupBy("a", "b", "c", "label").agg(F.count("*").alias("n")).collect()
    x = np.repeat(np.array([[r["a"], r["b"], r["c"]] for r in rows]), [r["n"] for r in rows], axis=0)
    y = np.repeat(np.array([r["label"] for r in rows], float), [r["n"] for r in rows])
    model.coefficients = fit_logistic(x, y)
    return model


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score column, 0 to 1; null and empty texts get the score of a text without hits."""
    w0, w1, w2, w3 = model.coefficients

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton()
        for batch in batches:
            got = []
            for t in batch:
                a, b, c = features(t or "", automaton)
                got.append(1 / (1 + math.exp(-max(-30.0, min(30.0, w0 + w1 * a + w2 * b + w3 * c)))))
            yield pd.Series(got, dtype="float64")

    return score(text)
