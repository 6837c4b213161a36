"""Record filters.

D2/D3 live with the page operators, D6 with the lifecycle and D7 with the
insights; all are plain ``filter`` calls that Catalyst pushes as far down as
the columns allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_falsy, py_strip


def has_key(df: DataFrame) -> Column:
    """D1 predicate: a record with a truthy ``platform`` needs ``url``; others need ``job_url``."""
    platform = F.col("platform") if "platform" in df.columns else F.lit(None).cast("string")
    url = F.col("url") if "url" in df.columns else F.lit(None).cast("string")
    job_url = F.col("job_url") if "job_url" in df.columns else F.lit(None).cast("string")
    return F.when(~is_falsy(platform), ~is_falsy(url)).otherwise(~is_falsy(job_url))


def drop_keyless(records: DataFrame) -> DataFrame:
    """Drop records without their key (the item pipeline's drop)."""
    return records.filter(has_key(records))


def filter_json_type(items: DataFrame, item: str = "item", key: str = "@type",
                     value: str = "JobPosting") -> DataFrame:
    """Keep JSON objects whose ``key`` equals ``value`` (lists go through ``explode`` first)."""
    return items.filter(F.get_json_object(F.col(item), f"$['{key}']") == value)


def drop_incomplete(records: DataFrame, required: Sequence[str] = ("job_url",),
                    blank_is_missing: bool = True) -> DataFrame:
    """Drop cards or records missing any ``required`` field (blank counts as missing)."""
    cond = F.lit(True)
    for c in required:
        col = F.col(c)
        cond = cond & (~is_falsy(py_strip(col)) if blank_is_missing else col.isNotNull())
    return records.filter(cond)
