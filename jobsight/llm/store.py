"""Written intermediate tables in the folder that all executors share.

Lineage is cut by writing a table under ``spark.checkpoint.dir`` and reading it
back: the files survive lost executors, and a table read from files carries no
partitioning, so the exchanges of a later join stay open to AQE's skew split.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "spark.checkpoint.dir"

#: Where the written tables lie.
_folders: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a private folder is set for local sessions (tests);
    any other master raises, since its executors would not share one.
    """
    set_dir = spark.sparkContext.getCheckpointDir()  # a folder of its own below the configured one
    found = spark.conf.get(KEY, None) or set_dir
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {KEY} to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="jobsight-llm-")
    spark.conf.set(KEY, made)
    return made


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder; return the table read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the files of written tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(_folders.pop(df))
        path.getFileSystem(conf).delete(path, True)


def sampled(hashed: Column, most: int, n: int) -> Column:
    """Whether a row is in a sample of about ``most`` of ``n`` rows by its 64-bit hash; all are if there are no more.

    The hash is compared with a share of its whole range, so the expected size holds at any ``n``.
    """
    return F.lit(True) if n <= most else hashed < F.lit((most << 64) // n - (1 << 63))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
