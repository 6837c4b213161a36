"""Landing zone: JSON-lines records, one dataset per source.

Lines are read as text, not with ``spark.read.json``: inference would lose the
difference between a malformed line and a null field, and between a missing
key and an explicit null.  A line is a record iff it parses to a JSON object,
which ``json_object_keys`` reports without a second parse.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RECORD

ORDER_COLS = ["file_path", "block_start", "pos"]
#: Names of the files that ``write_landing`` makes.
LANDED = "part-*.txt"


def read_landing(spark: SparkSession, path: str, pattern: str = "*.jl",
                 max_age_hours: float | None = None) -> DataFrame:
    """A1: every line of every landing file with its position.

    ``(file_path, block_start, pos)`` orders lines as they appear on disk: a
    split never reorders lines and the id grows inside a split.  With
    ``max_age_hours`` only files modified that recently are read (a source
    whose crawl failed would otherwise be reloaded as fresh).
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    df = reader.text(path)
    df = df.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        F.monotonically_increasing_id().alias("pos"),
    )
    if max_age_hours is not None:
        df = df.filter(F.col("file_mtime") >= F.current_timestamp() - F.make_dt_interval(
            hours=F.lit(int(max_age_hours)), mins=F.lit(int(max_age_hours * 60) % 60)))
    return df


def is_json_object(value: Column) -> Column:
    return F.json_object_keys(value).isNotNull()


def parse_landing(lines: DataFrame, value: str = "value", schema=RECORD,
                  keep_keys: bool = True) -> DataFrame:
    """A1: keep lines that are JSON objects and parse them into ``schema``.

    Every field is declared as a string, so numbers and nested values arrive as
    their JSON text.  ``_keys`` lists the keys present (for the key-presence
    rules).
    """
    keys = F.json_object_keys(F.col(value))
    parsed = (lines.withColumn("_keys", keys)
              .filter(F.col("_keys").isNotNull())
              .withColumn("_rec", F.from_json(F.col(value), schema)))
    cols = [c for c in lines.columns if c != value]
    out = parsed.select(*cols, *(["_keys"] if keep_keys else []), "_rec.*")
    return out


def route_records(records: DataFrame, key: str = "course_title") -> tuple[DataFrame, DataFrame]:
    """A2: a record is a course iff the key ``course_title`` is present (even null)."""
    is_course = F.array_contains(F.col("_keys"), key)
    return records.filter(~is_course), records.filter(is_course)


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    """A3: UNION ALL by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def write_landing(records: DataFrame, path: str, source_col: str = "source", keys_col: str = "_keys") -> None:
    """JSON lines in one folder per source, replacing only the sources written.

    The lines are read back by ``read_landing(path, pattern=LANDED)``: null
    fields stay present and the source stays a field.  Where ``keys_col`` is
    there, a record holds just the keys it lists (as ``parse_landing`` found
    them), so that absent keys stay absent.
    """
    fields = [c for c in records.columns if c != keys_col]
    options = {"ignoreNullFields": "false"}
    if keys_col in records.columns:
        entries = F.array(*[F.struct(F.lit(c).alias("k"), F.to_json(F.struct(F.col(c).alias("v")), options).alias("v")) for c in fields])
        present = F.filter(entries, lambda e: F.array_contains(F.col(keys_col), e["k"]))
        # each entry is {"v":...}: its value goes behind the key's name
        line = F.concat(F.lit("{"), F.array_join(F.transform(present, lambda e: F.concat(
            F.lit('"'), e["k"], F.lit('":'), F.substring(e["v"], F.lit(6), F.length(e["v"]) - 6))), ","), F.lit("}"))
    else:
        line = F.to_json(F.struct(*fields), options)
    (records.select(line.alias("value"), F.col(source_col).alias("landed_source"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("landed_source").text(path))
