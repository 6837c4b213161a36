"""Packed rows: numpy arrays as one binary column, gathered by key and streamed group by group.

A block is what one task has read until a limit; its distinct codes (words,
lines, pairs) leave as one row per key, so a code that is in every document
leaves once per block.  Rows of one key meet in one task, which reads them one
after the other: of a group only the folded state is held.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: their number, then type and size of each, then their contents on multiples of 8."""
    head = [struct.pack("<q", len(arrays))]
    body = []
    for a in arrays:
        data = np.ascontiguousarray(a).tobytes()
        head.append(struct.pack("<8sq", a.dtype.str.encode(), len(data)))
        body += [data, b"\0" * (-len(data) % 8)]
    return b"".join(head + body)


def unpack(data: bytes | pa.Buffer) -> list[np.ndarray]:
    view = memoryview(data)
    n, = struct.unpack_from("<q", view)
    at, out = 8 + 16 * n, []
    for i in range(n):
        kind, size = struct.unpack_from("<8sq", view, 8 + 16 * i)
        kind = np.dtype(kind.rstrip(b"\0").decode())
        out.append(np.frombuffer(view, kind, size // kind.itemsize, at))
        at += size + -size % 8
    return out


def next_block() -> Iterator[int]:
    """Numbers of the blocks of this task; no two tasks of a stage share one."""
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    while True:
        yield first
        first += 1


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one by one; binary columns as buffers without a copy."""
    for batch in batches:
        yield from zip(*((v.as_buffer() for v in c) if pa.types.is_binary(c.type) else c.to_pylist() for c in batch.columns))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Over rows sorted by their first column: each value with its rows, streamed."""
    return groupby(rows_of(batches), itemgetter(0))


def emitted(rows: Iterator[tuple], schema: pa.Schema, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of up to 1,000 rows or about ``limit`` bytes of binaries."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size >= limit or len(kept) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)


def gathered(rows: DataFrame, run, schema: str, *order: str) -> DataFrame:
    """``rows`` brought together by ``key`` and sorted by it (and ``order``), then streamed through ``run``."""
    return rows.repartition("key").sortWithinPartitions("key", *order).mapInArrow(run, schema)


def answered(table: DataFrame, requests: DataFrame, load, ask) -> DataFrame:
    """Requests answered by the table part of their key: ``block, payload`` of all that ``ask`` answers.

    ``table`` has ``key, payload`` (``load`` opens the list of a key's payloads),
    ``requests`` have ``key, block, payload``.  Table parts come first in each group;
    requests whose key the table lacks get no answer.
    """
    out = pa.schema([("block", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers() -> Iterator[tuple]:
            for _, rows in groups(batches):
                parts, opened = [], None
                for _, kind, block, payload in rows:
                    if not kind:
                        parts.append(payload)
                        continue
                    if not parts:
                        break
                    opened = opened if opened is not None else load(parts)
                    found = ask(opened, payload)
                    if found is not None:
                        yield block, found
        yield from emitted(answers(), out)

    both = (table.select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "payload")
            .unionByName(requests.select("key", F.lit(1).alias("kind"), "block", "payload")))
    return gathered(both, run, "block long, payload binary", "kind")
