"""Snapshots kept in hash buckets of their key.

A bucketed table tells Spark how its files are partitioned, so a join or an
aggregation on the key reads the snapshot without a shuffle; only the other side is
moved, into as many partitions as there are buckets.  The number of buckets is
the caller's: about the size of the table by 256 MB, the same for every
version.  Files lie at a path of the caller's; the session's catalog only
holds the description, so that any session can read them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def publish_bucketed(df: DataFrame, path: str, key: str = "job_url", buckets: int = 16) -> str:
    """Write ``df`` to a new folder in buckets of ``key``, as it is partitioned: rows that already
    are in buckets (a bucketed snapshot that was updated) are not shuffled, and new rows add a few files."""
    name = f"jobsight_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    return path


def read_bucketed(spark: SparkSession, path: str, schema: StructType, key: str = "job_url", buckets: int = 16) -> DataFrame:
    """The snapshot at ``path``, written by ``publish_bucketed`` with the same key and number of buckets."""
    name = f"jobsight_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
