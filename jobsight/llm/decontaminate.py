"""Benchmark decontamination by winnowing.

Of every ``SPAN - K + 1`` consecutive K-word grams the one with the smallest
hash is a fingerprint, in documents and in items alike, so any shared run of
``SPAN`` words shares a fingerprint at the same place of the run.  Documents and
items join on fingerprints; each match is extended along its diagonal in both
directions, and runs that hold a whole window of the item are hits.

An item shorter than ``SPAN`` words is one window; its fingerprint is the hash
of all its words, and documents offer their grams of the lengths that occur.

Documents keep a fingerprint only if its bit is set in a bitmap of all item
fingerprints.  The bitmap has a fixed size (2 MB), whatever the benchmark's: it
thins out what crosses the shuffle and decides nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.llm.bitmap import bitmap, in_bitmap
from jobsight.llm.store import written
from jobsight.llm.words import BY_LETTER, U, grams, hash_words

SPAN = 13
K = 7


def winnow(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints (of equal minima, all)."""
    g = grams(words, K)
    w = SPAN - K + 1
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, np.int64), g[:0]
    least = g[:n].copy()
    for i in range(1, w):
        np.minimum(least, g[i:i + n], out=least)
    chosen = np.zeros(len(g), bool)
    for i in range(w):
        chosen[i:i + n] |= g[i:i + n] == least
    at = np.flatnonzero(chosen)
    return at, g[at]


def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, length and fingerprints of items; items without words vanish."""
    for batch in batches:
        rows = []
        for item, words in zip(batch.column(0).to_pylist(), hash_words(batch.column(1).to_pylist(), BY_LETTER)):
            if len(words):
                at, fp = winnow(words) if len(words) >= SPAN else (np.zeros(1, np.int64), grams(words, len(words)))
                rows.append((item, len(words), words.tobytes(), at.astype(np.int32), fp.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
            names=["item_id", "n", "item_words", "at", "fp"])


def document_rows(bits, short: list[int]):
    """Per document its number of words and, if any fingerprint passes the bitmap, words and fingerprints."""
    def passing(at: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = in_bitmap(bits.value, fp)
        return at[keep], fp[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                n, kept, ats, fps = [], [], [], []
                for words in hash_words(batch.column(2).to_pylist(), BY_LETTER):
                    found = [passing(*winnow(words))]
                    for k in short:
                        g = grams(words, k)
                        found.append(passing(np.arange(len(g)), g))
                    at = np.concatenate([a for a, _ in found]).astype(np.int32)
                    n.append(len(words))
                    kept.append(words.tobytes() if len(at) else None)
                    ats.append(at if len(at) else None)
                    fps.append(np.concatenate([f for _, f in found]).view(np.int64) if len(at) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(kept, pa.binary()),
                     pa.array(ats, pa.list_(pa.int32())), pa.array(fps, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_words", "words", "at", "fp"])
    return run


def hit_spans(words: np.ndarray, item: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Runs of the document, [start, end), that hold whole windows of the item on the given diagonals."""
    least = min(SPAN, len(item))
    out = []
    for d in np.unique(offsets):
        lo, hi = max(0, int(d)), min(len(words), int(d) + len(item))
        same = np.zeros(hi - lo + 2, np.int8)
        same[1:-1] = words[lo:hi] == item[lo - d:hi - d]
        step = np.diff(same)
        for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            if e - s >= least:
                out.append((lo + int(s), lo + int(e)))
    return out


SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 256):
            batch = whole.slice(begin, 256)
            words, items, offsets = (batch.column(i).to_pylist() for i in (3, 4, 5))
            spans = [[{"s": s, "e": e} for s, e in hit_spans(np.frombuffer(w, U), np.frombuffer(i, U), np.array(o))]
                     for w, i, o in zip(words, items, offsets)]
            out = pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(spans, SPANS)],
                                             names=["doc_id", "text_key", "item_id", "spans"])
            yield out.filter(pa.array([bool(x) for x in spans], pa.bool_()))


def text_key(text: Column) -> Column:
    """128 bits that tell the texts of one id apart."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, text_key, n_words, n_hit, item_ids, contaminated``.

    ``item_ids`` (strings, sorted) are the items of which a window occurs.
    Null texts have no words; items without words match nothing; a null item id
    is shown as ``null``; rows with one item id are parts of one item.  Null
    document ids and repeated rows are answered row by row.
    """
    spark = docs.sparkSession
    items = written(
        benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item_id"),
                         F.col(item_text_col).alias("text"))
        .mapInArrow(item_rows, "item_id string, n int, item_words binary, at array<int>, fp array<long>")
        .withColumn("item_key", F.monotonically_increasing_id()), "items")
    prints = written(items.select("item_key", F.explode(F.arrays_zip("at", "fp")).alias("x"))
                     .select(F.col("x.fp").alias("fp"), "item_key", F.col("x.at").alias("item_at")), "prints")
    short = sorted(r["n"] for r in items.filter(F.col("n") < SPAN).select("n").distinct().collect())
    bits = spark.sparkContext.broadcast(bitmap(prints, "fp"))

    source = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                         F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    marked = written(source.mapInArrow(
        document_rows(bits, short),
        f"doc_id {kind}, text_key binary, n_words long, words binary, at array<int>, fp array<long>"), "prints-of-docs")

    key = ["doc_id", "text_key"]
    some = marked.filter("words IS NOT NULL")
    matches = (some.select(*key, F.explode(F.arrays_zip("at", "fp")).alias("x"))
               .select(*key, F.col("x.at").alias("doc_at"), F.col("x.fp").alias("fp"))
               .join(prints, "fp")
               .groupBy(*key, "item_key").agg(F.collect_set(F.col("doc_at") - F.col("item_at")).alias("offsets")))
    texts = some.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "words")
    pairs = (matches.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
             .join(items.select("item_key", "item_id", "item_words"), "item_key")
             .select(*key, "item_id", "words", "item_words", "offsets"))
    hits = (pairs.mapInArrow(extend, f"doc_id {kind}, text_key binary, item_id string, spans array<struct<s:int,e:int>>")
            .groupBy(*key).agg(F.flatten(F.collect_set("spans")).alias("spans"),
                               F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    covered = F.expr("""aggregate(array_sort(spans), named_struct('upto', 0, 'n', 0L), (a, x) -> named_struct(
        'upto', greatest(a.upto, x.e), 'n', a.n + greatest(0, x.e - greatest(a.upto, x.s)))).n""")
    hits = hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), covered.alias("n_hit"), "item_ids")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (marked.select(*key, "n_words")
            .join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
            .select(*key, "n_words", hit.alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they came."""
    bad = (contamination(docs, benchmark, id_col, text_col).filter("contaminated")
           .select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t")))
    marked = docs.withColumn("__k", text_key(F.col(text_col)))
    return marked.join(bad, marked[id_col].eqNullSafe(bad["__d"]) & (marked["__k"] == bad["__t"]),
                       "left_anti").select(*[marked[c] for c in docs.columns])
