"""Warehouse snapshots on plain files.

Layout under ``root``::

    v=<run>/<table>-<unique>/part-*.parquet   a new folder for every write
    _manifest/seq=<n>/part-*.json             (table, path, run_id, batch_id) rows

A run writes its tables to new folders first and its manifest last, as one
small Spark write.  Readers take the highest ``seq``.  Nothing a reader may
hold is ever overwritten, and a committed run id is not applied again.  One
load runs at a time: concurrent loads need a table format with transactions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import WAREHOUSE
from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as columns under the shared checkpoint folder, and read back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(
            "table string, path string, run_id string, batch_id long, seq long"
        ).json(root.rstrip("/") + "/_manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _entries(manifest: DataFrame) -> dict:
    """The table -> path map of the latest run among the manifest's rows, plus its metadata."""
    latest = manifest.agg(F.max("seq").alias("seq")).first()["seq"]
    if latest is None:
        return {}
    rows = manifest.filter(F.col("seq") == latest).collect()  # one row per table (four)
    return {r["table"]: r["path"] for r in rows} | {
        "_seq": latest, "_run_id": rows[0]["run_id"], "_batch_id": rows[0]["batch_id"]}


def current_manifest(spark: SparkSession, root: str) -> dict:
    """The table -> path map of the latest committed run, plus its metadata."""
    m = _manifest(spark, root)
    return {} if m is None else _entries(m)


def committed(spark: SparkSession, root: str, run_id: str) -> dict:
    """The manifest that ``run_id`` committed, empty if it has not."""
    m = _manifest(spark, root)
    return {} if m is None else _entries(m.filter(F.col("run_id") == run_id))


def read_snapshot(spark: SparkSession, root: str, table: str,
                  columns: list[str] | None = None) -> DataFrame:
    """The current state of ``table``; empty with the table schema if none."""
    paths = current_manifest(spark, root)
    schema = WAREHOUSE[table]
    if table in paths:
        df = spark.read.schema(schema).parquet(paths[table])
    else:
        df = spark.createDataFrame([], schema)
    return df.select(*columns) if columns else df


def publish_snapshot(df: DataFrame, path: str) -> str:
    """Write one table version to a new folder."""
    df.write.mode("error").parquet(path)
    return path


def table_path(root: str, run_id: str, table: str) -> str:
    """A folder that no earlier write has used."""
    return f"{root.rstrip('/')}/v={run_id}/{table}-{uuid.uuid4().hex}"


def publish_all(spark: SparkSession, root: str, tables: dict[str, DataFrame], run_id: str,
                batch_id: int | None = None) -> dict:
    """Write all tables of a run, then commit them together with one manifest.

    A value of ``tables`` may be a path the caller already wrote with
    ``publish_snapshot(df, table_path(...))``, so later tables can be derived
    from the written state instead of recomputing it.
    """
    root = root.rstrip("/")
    previous = current_manifest(spark, root)
    entries = []
    for name, df in tables.items():
        if isinstance(df, str):  # already written by the caller (see table_path)
            path = df
        else:
            path = table_path(root, run_id, name)
            publish_snapshot(df, path)
        entries.append((name, path, run_id, batch_id))
    # Tables the run did not touch keep their previous version.
    for name, path in previous.items():
        if not name.startswith("_") and name not in tables:
            entries.append((name, path, run_id, batch_id))
    seq = (previous.get("_seq") or 0) + 1
    man = spark.createDataFrame(entries, "table string, path string, run_id string, batch_id long")
    man.coalesce(1).write.mode("error").json(f"{root}/_manifest/seq={seq}")
    return current_manifest(spark, root)

