"""Exact duplicates by deterministic block naming.

Every normalised text is cut into blocks of a fixed number of characters.  The
distinct blocks are sorted within their shuffle partitions and numbered, so a
block's integer name stands for its content.  Adjacent pairs of names are then
named in the same way, level by level, until a document has one name: two
documents with the same (level, name) have the same text, and none other.

Only the distinct blocks cross a shuffle as text, and copies inside one task
meet before it.  Occurrences find their block's name by a 256-bit digest; that
no two different blocks share a digest is verified over the whole table (the
job stops if they do), so a name never joins different contents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsight.llm.store import written
from jobsight.llm.textops import fold_ascii

BLOCK_CHARS = 4096


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per distinct (id, text): ``doc_id, sha, copies, level, name``.

    ``(level, name)`` identifies the text after lower-casing A-Z.  ``copies``
    counts rows that repeat both id and text.  A null text is the empty text
    (one empty block), a null id is kept as it is; extra columns are ignored.
    """
    norm = docs.select(F.col(id_col).alias("doc_id"),
                       fold_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    cut = norm.select(
        "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.when(F.col("norm") == "", F.array(F.lit("")))
        .otherwise(F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)))
        .alias("blocks"))
    occurs = cut.select("doc_id", "sha", F.size("blocks").alias("n"),
                        F.posexplode("blocks").alias("pos", "block"))
    occurs = occurs.withColumn("digest", F.unhex(F.sha2("block", 256)))

    blocks = occurs.select("digest", "block").distinct().sortWithinPartitions("block")
    numbered = blocks.select("digest", F.monotonically_increasing_id().alias("name"))
    names = written(
        numbered.groupBy("digest").agg(F.count("*").alias("n"), F.min("name").alias("name"))
        .select("digest", F.when(F.col("n") > 1, F.raise_error(
            F.lit("two different blocks share a digest")).cast("long"))
            .otherwise(F.col("name")).alias("name")), "blocks")
    cur = written(occurs.drop("block").join(names, "digest")
                  .select("doc_id", "sha", "n", F.lit(1).cast("long").alias("copies"), "pos", "name"),
                  "named")

    ready = ["doc_id", "sha", "copies", "level", "name"]
    done = cur.filter("n = 1").withColumn("level", F.lit(0)).select(*ready)
    most = cur.agg(F.max("n")).first()[0] or 1
    cur = cur.filter("n > 1")
    level = 0
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        left = F.col("pos") % 2 == 0
        pairs = cur.groupBy("doc_id", "sha", "n", F.floor(F.col("pos") / 2).cast("int").alias("at")).agg(
            F.max(F.when(left, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(-1)).alias("b"),
            F.sum(F.when(left, F.col("copies"))).alias("copies"))
        names = written(pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
                        .select("a", "b", F.monotonically_increasing_id().alias("name")), f"pairs{level}")
        cur = written(pairs.join(names, ["a", "b"])
                      .select("doc_id", "sha", "n", "copies", F.col("at").alias("pos"), "name"),
                      f"level{level}")
        done = done.unionByName(cur.filter(F.col("n") <= 2 ** level)
                                .withColumn("level", F.lit(level)).select(*ready))
        cur = cur.filter(F.col("n") > 2 ** level)
    return done.groupBy("doc_id", "sha", "level", "name").agg(F.sum("copies").alias("copies"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays; a null id loses against
    any other.  Of rows that repeat both id and text exactly one is kept.  An
    empty table gives no rows.
    """
    named = name_documents(docs, id_col, text_col, block_chars)
    groups = written(
        named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"),
                                           F.sum("copies").alias("group_size"))
        .filter("group_size > 1"), "groups")
    rows = named.join(groups, ["level", "name"], "left").select(
        "doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "sha", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"))
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they came."""
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"))
    marked = docs.withColumn("__sha2", F.unhex(F.sha2(
        fold_ascii(F.coalesce(F.col(text_col), F.lit(""))), 256)))
    joined = marked.join(kept, marked[id_col].eqNullSafe(kept["__id"]) & (marked["__sha2"] == kept["__sha"]))
    # the join leaves the rows of an (id, text) together: no further shuffle
    return joined.dropDuplicates(["__id", "__sha"]).select(*[joined[c] for c in docs.columns])
