"""Line deduplication with a sharded minimal perfect hash.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased,
as a 128-bit hash.  Its upper half names the shard, its lower half is what the
shard's minimal perfect hash is built over; the slot indexes an array of 16-bit
fingerprints and an array of document counts, both of exactly as many entries as
the shard has distinct lines.  The number of shards grows with the number of
lines, so a shard stays small.

Documents are read in blocks.  A block sends each distinct key once to its shard:
first with the number of its documents that hold it, of which the arrays are
built, then to probe the arrays; the answers, which of the block's keys are
repeated, come back to the block.  Lines are never joined, and a line that is in
every document crosses a shuffle once per block.  Documents that lose lines are
read again and rewritten; the rest never leave their task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.llm.bitmap import bitmap, in_bitmap
from jobsight.llm.packed import answered, emitted, gathered, groups, next_block, pack, rows_of, unpack
from jobsight.llm.perfect_hash import PerfectHash
from jobsight.llm.store import discard, written
from jobsight.llm.words import U, mix

#: Of the registered query.
MIN_DOCS, MIN_CHARS = 10, 1
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
#: A block ends with the document that brings it to this many distinct lines or documents.
BLOCK_LINES, BLOCK_DOCS = 1 << 18, 1 << 16
#: Distinct lines of a shard, about, at most.
SHARD_LINES = 1 << 14

BLOCKS = pa.schema([("block", pa.int64()), ("n_keys", pa.int64()), ("payload", pa.binary())])
PARTS = pa.schema([("key", pa.string()), ("block", pa.int64()), ("payload", pa.binary())])


def line_keys(text: str | None) -> list[bytes]:
    """The key of each line; null and the empty text are one empty line."""
    return [line.strip(BLANK).lower() for line in (text or "").encode().split(b"\n")]


def row_identity(id_col: Column, text: Column) -> list[Column]:
    """128 bits of id and text; rows that share both share all results."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(id_col.cast("string"), text).alias("r1"), F.xxhash64(F.lit(1), text, id_col.cast("string")).alias("r2")]


def to_blocks(min_chars: int):
    """r1, r2, text -> blocks: identities, line counts, each line's place among the block's keys (-1: too short), keys, documents of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = next_block()

        def rows() -> Iterator[tuple]:
            ids, held, lines, sizes, r1, r2 = {}, [], [], [], [], []

            def block() -> tuple:
                digests = b"".join(map(xxhash.xxh3_128_digest, ids))
                hashes = np.frombuffer(digests, U).reshape(-1, 2)
                return next(number), len(ids), pack(
                    np.array(r1, np.int64), np.array(r2, np.int64), np.array(sizes, np.int64),
                    np.concatenate(lines), hashes[:, 0], hashes[:, 1], np.array(held, np.int64))

            for batch in batches:
                for a, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                    keys = line_keys(text)
                    own = {}
                    for key in keys:
                        if key not in own:
                            if len(key) < min_chars or min_chars > 1 and len(key.decode()) < min_chars:
                                own[key] = -1
                            else:
                                at = own[key] = ids.setdefault(key, len(ids))
                                if at == len(held):
                                    held.append(1)
                                else:
                                    held[at] += 1
                    lines.append(np.fromiter(map(own.__getitem__, keys), np.int32, len(keys)))
                    sizes.append(len(keys))
                    r1.append(a)
                    r2.append(b)
                    if len(ids) >= BLOCK_LINES or len(sizes) >= BLOCK_DOCS:
                        yield block()
                        ids, held, lines, sizes, r1, r2 = {}, [], [], [], [], []
            if sizes:
                yield block()
        yield from emitted(rows(), BLOCKS)
    return run


def to_shards(shard_bits: int, counts: bool):
    """Blocks -> one row per shard: key halves and counts, or key halves and places in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for block, _, payload in rows_of(batches):
                *_, low, high, held = unpack(payload)
                shard = (high >> U(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(high), np.int64)
                order = np.argsort(shard, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if len(part):
                        yield f"{shard[part[0]]}", block, pack(low[part], held[part] if counts else part.astype(np.int32))
        yield from emitted(rows(), PARTS)
    return run


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ U(0xA5A5A5A5A5A5A5A5)) >> U(48)).astype(np.uint16)


def build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shards -> per shard the perfect hash, fingerprints and counts (in the narrowest type that holds them)."""
    def rows() -> Iterator[tuple]:
        for key, parts in groups(batches):
            keys, held = zip(*(unpack(payload) for *_, payload in parts))
            keys, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, np.concatenate(held))
            index = PerfectHash.build(keys)
            slot = index.find(keys)
            prints, counts = np.empty(len(keys), np.uint16), np.empty(len(keys), np.min_scalar_type(int(sums.max(initial=0))))
            prints[slot], counts[slot] = fingerprints(keys), sums
            yield key, len(keys), pack(index.sizes, index.words, prints, counts)
    yield from emitted(rows(), pa.schema([("key", pa.string()), ("n_keys", pa.int64()), ("payload", pa.binary())]))


def open_shard(parts: list) -> tuple:
    sizes, words, prints, counts = unpack(parts[0])
    return PerfectHash(sizes, words), prints, counts


def probe(least: int):
    """Places of those keys of a request that ``least`` documents hold; none: no answer."""
    def ask(shard: tuple, payload) -> bytes | None:
        index, prints, counts = shard
        keys, places = unpack(payload)
        slot = index.find(keys)
        if (slot < 0).any() or (prints[slot] != fingerprints(keys)).any():
            raise ValueError("a line is not in the index")
        places = places[counts[slot] >= least]
        return pack(places) if len(places) else None
    return ask


def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers, then the block itself: the documents that lose lines, with the numbers of those lines."""
    out = pa.schema([("r1", pa.int64()), ("r2", pa.int64()), ("dropped", pa.list_(pa.int32()))])

    def rows() -> Iterator[tuple]:
        for _, members in groups(batches):
            answers = []
            for _, kind, payload in members:
                if not kind:
                    answers.append(unpack(payload)[0])
                elif answers:
                    r1, r2, sizes, lines, low, *_ = unpack(payload)
                    gone = np.zeros(len(low) + 1, bool)  # the last stands for -1
                    gone[np.concatenate(answers)] = True
                    gone[-1] = False
                    hit = gone[lines]
                    ends = np.cumsum(sizes)
                    at = np.flatnonzero(hit)
                    doc = np.searchsorted(ends, at, side="right")
                    for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(doc)) + 1):
                        if len(part):
                            d = doc[part[0]]
                            yield int(r1[d]), int(r2[d]), at[part] - (ends[d] - sizes[d])
    yield from emitted(rows(), out)


def line_index(blocks: DataFrame, shard_bits: int) -> DataFrame:
    """``key, n_keys, payload``: one row per shard over all distinct lines of the blocks."""
    parts = blocks.mapInArrow(to_shards(shard_bits, True), "key string, block long, payload binary")
    return gathered(parts, build_shards, "key string, n_keys long, payload binary")


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int) -> DataFrame:
    """``r1, r2, dropped``: rows that lose lines, by identity, with the numbers of those lines (from 0)."""
    source = docs.select(*row_identity(F.col(id_col), F.col(text_col)), F.col(text_col).alias("text"))
    blocks = written(source.mapInArrow(to_blocks(min_chars), "block long, n_keys long, payload binary"), "line-blocks")
    total = blocks.agg(F.sum("n_keys")).first()[0] or 0
    shard_bits = max(0, -(-total // SHARD_LINES) - 1).bit_length()
    index = written(line_index(blocks, shard_bits), "line-index")
    requests = blocks.mapInArrow(to_shards(shard_bits, False), "key string, block long, payload binary")
    answers = answered(index.select("key", "payload"), requests, open_shard, probe(min_docs))
    both = (answers.select(F.col("block").alias("key"), F.lit(0).alias("kind"), "payload")
            .unionByName(blocks.select(F.col("block").alias("key"), F.lit(1).alias("kind"), "payload")))
    found = written(gathered(both, resolve, "r1 long, r2 long, dropped array<int>", "kind").dropDuplicates(["r1", "r2"]), "line-drops")
    discard(blocks, index)
    return found


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                        min_chars: int = MIN_CHARS, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the text rewritten, and two new last columns: the lines it had and the lines it lost (long).

    A text is cut at ``\\n``; null and empty texts are one empty line (and come back
    empty).  Keys of at least ``min_chars`` code points that at least ``min_docs``
    rows hold lose all their lines; a row counts once however often it repeats the
    line, rows that repeat id and text each count.  The other lines stay as they
    are, joined by ``\\n``.  Other columns and null ids pass through; an empty table gives no rows.
    """
    drops = repeated_lines(docs, id_col, text_col, min_docs, min_chars)
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(drops, "r1"))
    names = [f"__{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    id_at, text_at = (names[docs.columns.index(c)] for c in (id_col, text_col))
    marked = inner.select(*names, *row_identity(F.col(id_at), F.col(text_at)))

    @F.pandas_udf("boolean")
    def may_lose(r1):
        import pandas as pd
        return pd.Series(in_bitmap(bits.value, r1.to_numpy().view(U)))

    some = marked.withColumn("__may", may_lose("r1"))
    text = F.coalesce(F.col(text_at), F.lit(""))
    lost = F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped"))
    whole = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    right = drops.select(F.col("r1").alias("__a"), F.col("r2").alias("__b"), "dropped")
    hit = some.filter("__may").join(right, (F.col("r1") == F.col("__a")) & (F.col("r2") == F.col("__b")), "left")

    @F.pandas_udf("string")
    def kept_text(texts, gone):
        import pandas as pd
        return pd.Series([without(t or "", g) for t, g in zip(texts, gone)], dtype=object)

    def row(rest: Column, n: Column) -> list[Column]:
        return [*((rest if c == text_at else F.col(c)).alias(o) for c, o in zip(names, docs.columns)),
                whole.cast("long").alias(n_lines), n.cast("long").alias(n_dropped)]

    return (some.filter(~F.col("__may")).select(*row(text, F.lit(0)))
            .union(hit.select(*row(kept_text(text, "dropped"), lost))))


def without(text: str, gone) -> str:
    if gone is None or not len(gone):
        return text
    drop = set(gone.tolist() if hasattr(gone, "tolist") else gone)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in drop)


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` for every row."""
    rows = drop_repeated_lines(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
