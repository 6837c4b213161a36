"""Maximal periodic runs of the words of a text.

A run of period q with two periods or more holds two neighbouring places of the
grid 0, q, 2q, ..., and the words there are equal.  All grids together have about
n ln n pairs of neighbours.  Pairs of equal words whose agreement is longer than
one word are candidates; a run-length grammar of the words (see
``recompression``) tells how far a candidate's two places agree to both sides,
which is the run.  Of runs over the same words the one with the smallest period
stays, since the others have multiples of it.

Documents are independent: a batch of them is one sequence of word numbers with
a separator of its own between any two, and only documents with candidates enter
the grammar.  A document's words are held by its task, nothing crosses a shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsight.llm.recompression import Grammar

#: Least words of a run.
MIN_WORDS = 12
#: Words of documents taken together, and grid pairs looked at together.
BATCH_WORDS, CHUNK = 1 << 17, 1 << 20


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def grid_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document, place and period of all neighbouring grid places, in chunks."""
    periods = sizes // 2
    first_row = np.concatenate([[0], np.cumsum(periods)])
    for d0, d1, q0, q1 in row_chunks(sizes, periods):
        doc = np.repeat(np.arange(d0, d1), periods[d0:d1]) if d1 - d0 > 1 else np.full(q1 - q0, d0)
        q = np.arange(len(doc)) - (first_row[doc] - first_row[d0]) + 1 if d1 - d0 > 1 else np.arange(q0 + 1, q1 + 1)
        pairs = (sizes[doc] - 1) // q
        row = np.repeat(np.arange(len(doc)), pairs)
        k = np.arange(len(row)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        q, doc = q[row], doc[row]
        yield doc, starts[doc] + k * q, q


def row_chunks(sizes: np.ndarray, periods: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of documents (all their periods) with about CHUNK pairs, or ranges of periods of one large document."""
    cost = sizes * (np.log(np.maximum(sizes, 2)) + 1)
    d0 = 0
    while d0 < len(sizes):
        d1, total = d0, 0.0
        while d1 < len(sizes) and (d1 == d0 or total + cost[d1] <= CHUNK):
            total += cost[d1]
            d1 += 1
        if d1 - d0 > 1 or total <= CHUNK:
            if d1 - d0 > 1:
                yield d0, d1, 0, 0
            elif periods[d0]:
                yield d0, d1, 0, int(periods[d0])
        else:
            q0, n = 0, int(sizes[d0])
            while q0 < periods[d0]:
                q1 = q0 + max(1, min(int(periods[d0]) - q0, CHUNK * (q0 + 1) // n))
                yield d0, d1, q0, q1
                q0 = q1
        d0 = d1


def candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grid pairs of equal words that agree beyond that word."""
    for doc, at, q in grid_pairs(starts, sizes):
        keep = np.flatnonzero(words[at] == words[at + q])
        doc, at, q = doc[keep], at[keep], q[keep]
        keep = (words[at + 1] == words[at + 1 + q]) | (words[at - 1] == words[at - 1 + q])
        if keep.any():
            yield doc[keep], at[keep], q[keep]


def joined(docs: list[np.ndarray], n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sequence with a separator around each document; starts and sizes of the documents."""
    sizes = np.array([len(d) for d in docs], np.int64)
    starts = np.cumsum(sizes + 1) - sizes
    words = np.empty(int(sizes.sum()) + len(docs) + 1, np.int64)
    gaps = np.concatenate([[0], starts + sizes])
    words[gaps] = n_words + np.arange(len(gaps))
    for d, s in zip(docs, starts):
        words[s:s + len(d)] = d
    return words, starts, sizes


def find_runs(docs: list[np.ndarray], n_words: int, least: int = MIN_WORDS) -> list[np.ndarray]:
    """For each document (word numbers below ``n_words``) its runs of ``least`` (3 or more) words: rows of start, length, period, in this order."""
    out = [np.empty((0, 3), np.int64)] * len(docs)
    words, starts, sizes = joined(docs, n_words)
    active = np.zeros(len(docs), bool)
    for doc, _, _ in candidates(words, starts, sizes):
        active[doc] = True
    chosen = np.flatnonzero(active)
    if not len(chosen):
        return out
    words, starts, sizes = joined([docs[i] for i in chosen], n_words)
    grammar = Grammar(words)
    found = []
    for doc, at, q in candidates(words, starts, sizes):
        start = at - grammar.agree(at - 1, at - 1 + q, forward=False)
        end = at + q + grammar.agree(at, at + q)
        keep = end - start >= np.maximum(least, 2 * q)
        found.append(np.unique(np.column_stack([doc, start, end, q])[keep], axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    same = np.zeros(len(runs), bool)
    same[1:] = (runs[1:, 1] == runs[:-1, 1]) & (runs[1:, 2] == runs[:-1, 2])
    runs = runs[~same]
    for part in np.split(runs, np.flatnonzero(np.diff(runs[:, 0])) + 1):
        if len(part):
            d = part[0, 0]
            rows = np.column_stack([part[:, 1] - starts[d], part[:, 2] - part[:, 1], part[:, 3]])
            out[chosen[d]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def cycled(words: list[bytes], name: str | None) -> list[bytes]:
    """The registered query's planted repeats: of one document in ten (by the crc of its id) the words go round from a place on."""
    h = zlib.crc32((name or "").encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def word_batches(batches: Iterator[pa.RecordBatch], change) -> Iterator[tuple[list, list[list[bytes]], list[np.ndarray]]]:
    """Ids, words and runs of documents, some documents at a time.  Columns: id, id as text, text."""
    def solved() -> tuple:
        return ids, texts, find_runs(coded, len(numbers))

    ids, texts, coded, numbers, total = [], [], [], Numbers(), 0
    for batch in batches:
        for i, name, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = change((text or "").encode().split(), name)
            ids.append(i)
            texts.append(words)
            coded.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            total += len(words)
            if total >= BATCH_WORDS or len(ids) >= 4096:
                yield solved()
                ids, texts, coded, numbers, total = [], [], [], Numbers(), 0
    if ids:
        yield solved()


def source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, runs, collapsed`` for every row.

    Words are runs of anything but ASCII white space.  ``runs`` (start, length,
    period in words, ordered by start, then period) are all stretches of at least
    12 words and two periods that no neighbouring word extends, with their smallest
    period; ``collapsed`` joins the words that no run holds after its first period
    by one space.  Null and empty texts have no words, no runs and an empty
    ``collapsed``; null ids, repeated rows and other columns are of no concern, since
    rows are independent; an empty table gives no rows.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, found in word_batches(batches, lambda words, _: words):
            runs = [[dict(zip(("start", "length", "period"), r)) for r in rows.tolist()] for rows in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([len(w) for w in texts], pa.int64()), pa.array(runs, kind),
                 pa.array([collapsed(w, r).decode() for w, r in zip(texts, found)], pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    rows = source(docs, id_col, text_col)
    id_type = arrow_type(rows, "id")
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, "
                                "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if len(runs):
        words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
    return b" ".join(words)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every row, after ``cycled``: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, found in word_batches(batches, cycled):
            best, of_runs, of_text = [], [], []
            for words, runs in zip(texts, found):
                top = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist() if len(runs) else [None] * 3
                best.append([*top, 1000 * top[1] // top[2] if len(runs) else None])
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
                of_runs.append(hashlib.sha256(listed.encode()).hexdigest())
                of_text.append(hashlib.sha256(collapsed(words, runs)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([len(r) for r in found], pa.int64()),
                 *(pa.array(c, pa.int64()) for c in zip(*best)), pa.array(of_runs, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    rows = source(docs, id_col, text_col)
    id_type = arrow_type(rows, "id")
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, n_runs long, start long, length long, "
                                "period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
