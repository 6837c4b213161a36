"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a row's hash.  It starts with no
bits; a bucket over the byte limit splits on one more bit, and only such
buckets do, until every shard fits.  Since the buckets over a row are nested,
its shard is the first of them that fits.  Sizes are summed once per round at
some bits beyond the expected depth and rolled up from there; rows are read
again only for buckets that need still more bits.

Rows that repeat id and text are told apart by an occurrence number, which is
hashed with them, so that no number of copies makes a bucket that cannot split.
Copies are numbered inside their partitions, and the counts of the partitions
before are added; only hashes that repeat take part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsight.llm.store import discard, written

HASH_BITS = 60
#: Bytes of text in a shard, at most.
SHARD_BYTES = 1 << 20
#: Bits summed beyond the depth that evenly filled shards would have.
SPARE_BITS = 4


def bits_of(name: Column) -> Column:
    """``HASH_BITS`` bits of a hash."""
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def hex_of(h: str) -> Column:
    return F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``__row`` (its place), ``__n`` (bytes of text) and ``__h`` (a hash of id and text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select("*", F.monotonically_increasing_id().alias("__row"), F.octet_length(text).cast("long").alias("__n"), bits_of(name).alias("__h"))


def told_apart(rows: DataFrame) -> DataFrame:
    """``row, n_bytes, h`` (written) with other hashes for the second and further rows of one hash."""
    again = rows.groupBy("h").agg(F.count("*").alias("copies")).filter("copies > 1").select("h")
    part = F.shiftright("row", 33)
    copies = rows.join(again, "h", "left_semi").withColumn("part", part)
    counts = copies.groupBy("h", "part").agg(F.count("*").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = F.row_number().over(Window.partitionBy("h", "part").orderBy("row"))
    numbered = copies.withColumn("at", at).join(counts.select("h", "part", before.alias("before")), ["h", "part"])
    nth = F.col("before") + F.col("at") - 1
    other = bits_of(F.concat(hex_of("h"), F.lit(":"), nth.cast("string")))
    return (rows.join(again, "h", "left_anti").select("row", "n_bytes", "h")
            .unionByName(numbered.select("row", "n_bytes", F.when(nth == 0, F.col("h")).otherwise(other).alias("h"))))


def prefix(h, bits):
    """The leading ``bits`` of ``h``; both may be columns."""
    return F.expr(f"shiftright({h}, {HASH_BITS} - {bits})")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """``bits, leaf, depth``: the depth of the bucket of each leading bit pattern.

    The entries of a round share ``bits``; a later round refines buckets that
    are still too large.  Buckets that no bit can split (one hash) get all bits.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, found = 0, None
    bits = min(HASH_BITS, math.ceil(math.log2(total / limit + 1)) + SPARE_BITS)
    while True:
        sizes = written(rows.groupBy(prefix("h", bits).alias("leaf")).agg(F.sum("n_bytes").alias("n_bytes")), "leaves")
        deep = sizes.select("leaf", "n_bytes", F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth"))
        deep = deep.withColumn("at", F.expr(f"shiftright(leaf, {bits} - depth)"))
        fits = deep.groupBy("depth", "at").agg(F.sum("n_bytes").alias("whole")).filter(F.col("whole") <= limit)
        depth = (deep.join(fits, ["depth", "at"]).groupBy("leaf").agg(F.min("depth").alias("depth")))
        entries = written(sizes.select("leaf").join(depth, "leaf", "left").select(
            F.lit(bits).alias("bits"), "leaf",
            F.coalesce("depth", F.lit(HASH_BITS) if bits == HASH_BITS else F.lit(None).cast("int")).alias("depth")), "directory")
        done = entries.filter("depth IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        rest = entries.filter("depth IS NULL").select(F.col("leaf").alias("open"))
        if bits == HASH_BITS or rest.isEmpty():
            return found
        rows = rows.withColumn("open", prefix("h", bits)).join(rest, "open", "left_semi").drop("open")
        low, bits = bits + 1, min(HASH_BITS, bits + 8)


def placed_rows(rows: DataFrame, limit: int) -> DataFrame:
    """``row, n_bytes, shard, depth`` of ``row, n_bytes, h``."""
    small = rows.filter(F.col("n_bytes") <= limit)
    entries = directory(small, limit)
    placed = rows.filter(F.col("n_bytes") > limit).select(
        "row", "n_bytes", F.concat(F.lit("own:"), hex_of("h")).alias("shard"), F.lit(HASH_BITS).alias("depth"))
    for r in entries.select("bits").distinct().orderBy("bits").collect():
        part = entries.filter(F.col("bits") == r["bits"]).drop("bits")
        placed = placed.unionByName(
            small.withColumn("leaf", prefix("h", r["bits"])).join(part, "leaf")
            .select("row", "n_bytes", F.when(F.col("depth") == 0, "").otherwise(
                F.lpad(F.bin(prefix("h", "depth")), F.col("depth"), F.lit("0"))).alias("shard"), "depth"))
    return placed


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, shard, depth, n_bytes, shard_bytes, shard_docs``.

    ``shard`` is the bucket's bit pattern (empty for an undivided table); no
    bucket is over the limit.  A text over the limit is a shard of its own, ``own:`` and
    its hash, and does not count in the buckets.  Rows that repeat id and text
    are hashed with an occurrence number from the second on.
    Null ids and null texts (0 bytes) are hashed as empty.
    """
    raw = written(hashed(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col("__row").alias("row"), F.col("__n").alias("n_bytes"),
                                                        F.col("__h").alias("h")), "hashes")
    rows = written(told_apart(raw.drop("doc_id")), "told-apart")
    placed = written(placed_rows(rows, limit).join(raw.select("row", "doc_id"), "row"), "placed")
    sums = written(placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs")), "shards")
    discard(raw, rows)
    return placed.join(sums, "shard").select("doc_id", "shard", "depth", "n_bytes", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as Parquet, one folder per shard, rows of a shard in one task each.

    The folder of the undivided table is ``all``, of a bucket ``b`` and its bits, of a text
    of its own ``own-`` and its hash.  The documents are written once with
    their places and joined once with the shards, at whatever depth those are; an
    empty table leaves an empty Parquet table.
    """
    wide = written(hashed(docs, id_col, text_col), "places")
    rows = written(told_apart(wide.select(F.col("__row").alias("row"), F.col("__n").alias("n_bytes"), F.col("__h").alias("h"))), "told-apart")
    folder = F.when(F.col("shard").startswith("own:"), F.replace("shard", F.lit(":"), F.lit("-"))).when(F.col("shard") == "", "all").otherwise(F.concat(F.lit("b"), "shard"))
    placed = placed_rows(rows, limit).select("row", folder.alias("shard"))
    out = wide.join(placed, F.col("__row") == F.col("row")).drop("__row", "__n", "__h", "row").repartition("shard")
    if out.isEmpty():
        docs.limit(0).write.parquet(path)
    else:
        out.write.partitionBy("shard").parquet(path)
    discard(wide, rows)
