"""Snapshots clustered for lookups.

Files that hold neighbouring values of the facet columns have narrow min/max
statistics, so a filter that reaches the Parquet scan skips most files and row
groups.  Rows are ranged over files by the facet columns, in the order given
(the one asked for most first), and sorted by them inside each file; equal
values may lie in several files, so one frequent facet is not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The facets of the BI lookups; the key spreads equal facets over files.
FACETS = ("location", "work_setup", "source", "job_type", "experience_level")


def publish_clustered(df: DataFrame, path: str, facets: Sequence[str] = FACETS, key: str = "job_url", files: int | None = None) -> str:
    """Write ``df`` to a new folder, ranged and sorted by the facets (``files`` files, or as Spark plans)."""
    by = [*facets, key]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("error").parquet(path)
    return path


def read_clustered(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def files_with(df: DataFrame) -> DataFrame:
    """How many rows each file gives to a lookup: ``file, n_rows`` (files without a hit are absent)."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
