"""Raw API payloads and HTML pages as tables (A4, A5).

Fetching is out of scope: a crawler (or a test) lands responses as rows of
``raw_payloads`` / ``pages``; the normalisers read those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_PAYLOADS


def read_payloads(spark: SparkSession, path: str, kind: str | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """A4: the ``raw_payloads`` table; the ``kind`` filter reaches the scan."""
    df = spark.read.format(fmt).schema(RAW_PAYLOADS).load(path) if fmt != "parquet" \
        else spark.read.parquet(path)
    if kind is not None:
        df = df.filter(F.col("kind") == kind)
    return df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A5: raw HTML pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def payloads_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Small helper for tests: rows of (source, kind, url, status, body, fetched_at, seq)."""
    return spark.createDataFrame(rows, RAW_PAYLOADS)
