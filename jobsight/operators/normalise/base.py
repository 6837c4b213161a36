"""Shared pieces of the normalisers: the 18-field job record and JSON helpers.

A payload row is one fetched response (``raw_payloads``: source, kind, url,
status, body, fetched_at, seq).  Normalisers parse the body with ``from_json``
(polymorphic values declared as strings and read with ``get_json_object``),
explode the postings with their position, and project the canonical record.
A posting whose fields do not parse gets nulls and defaults, never an error:
one bad posting cannot stop a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import age_bucket, days_between, days_later, parse_text_ts
from ...functions.text import is_falsy
from ...schemas import COURSE_FIELDS, JOB_FIELDS

ORDER_COLS = ["source", "seq", "item_pos"]


def s(x) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def jget(c, path: str) -> Column:
    """``get_json_object`` that yields null for non-objects."""
    return F.get_json_object(c if isinstance(c, Column) else F.col(c), path)


def or_default(c: Column, default) -> Column:
    """``x or default`` for text (null and '' fall back)."""
    return F.when(is_falsy(c), s(default)).otherwise(c)


def explode_items(payloads: DataFrame, path: str | None, item: str = "item") -> DataFrame:
    """Explode the JSON array at ``path`` of each body into one row per posting.

    ``path=None`` means the body itself is the array.  Items stay JSON text.
    """
    arr = F.col("body") if path is None else F.get_json_object("body", path)
    items = F.from_json(arr, "array<string>")
    return payloads.select("source", "seq", "fetched_at",
                           F.posexplode(F.coalesce(items, F.array().cast("array<string>"))).alias("item_pos", item))


def item_fields(item, *fields: str) -> Column:
    """The named members of an object's text, parsed at once into a struct of texts.

    Members that are no texts stay JSON; all are null for anything but an object.
    """
    return F.from_json(item if isinstance(item, Column) else F.col(item), ", ".join(f"`{f}` string" for f in fields))


def explode_fields(payloads: DataFrame, path: str | None, *fields: str) -> DataFrame:
    """``explode_items`` with the named members of each posting as the struct ``j``.

    They are parsed inside the exploded array, where no later filter can repeat the parsing.
    """
    arr = F.col("body") if path is None else F.get_json_object("body", path)
    items = F.transform(F.from_json(arr, "array<string>"), lambda x: item_fields(x, *fields))
    return payloads.select("source", "seq", "fetched_at",
                           F.posexplode(F.coalesce(items, F.array().cast(item_type(fields)))).alias("item_pos", "j"))


def item_type(fields) -> str:
    return "array<struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">>"


class JobRecord:
    """The 18 landed job fields of one source, computed in stages.

    Stage one evaluates every source rule once as a column; the next parse
    ``last_seen`` and count its days; the last adds the fields derived from them
    (end date, job age), so that nothing is re-evaluated inside each of them.
    """

    def __init__(self, now: Column, fields: dict):
        self.now = now
        self.fields = fields

    def emit(self, df: DataFrame, prefix: dict) -> DataFrame:
        raw = {k: s(v) for k, v in self.fields.items()}
        raw.setdefault("last_seen", self.now)
        s1 = df.select(*[c.alias(n) for n, c in prefix.items()], self.now.alias("_now"),
                       *[v.alias("_r_" + k) for k, v in raw.items()])
        last = F.col("_r_last_seen")
        now = F.col("_now")
        s1 = s1.withColumn("_last", parse_text_ts(last)).withColumn("_days", days_between(parse_text_ts(now), F.col("_last")))
        vals = {
            "first_seen": now,
            "base_salary": F.lit("0"),
            "job_level": F.lit("N/A"),
            "is_active": F.lit("True"),
            "job_apply_end_date": days_later("_last"),
            "job_age": F.when(is_falsy(now) | is_falsy(last), F.lit("unknown")).otherwise(age_bucket("_days")),
        }
        vals.update({k: F.col("_r_" + k) for k in raw})
        return s1.select(*prefix.keys(), *[s(vals.get(name, F.lit(None).cast("string"))).cast("string").alias(name)
                                           for name in JOB_FIELDS])


def job_record(now: Column, **f) -> JobRecord:
    """The 18 landed job fields, with the shared defaults of all sources.

    ``first_seen`` is the run time; ``job_age`` is derived from first and last
    sighting as the item pipeline does for every record.
    """
    return JobRecord(now, f)


def emit(df: DataFrame, prefix: dict, rec: JobRecord) -> DataFrame:
    """Select ``prefix`` columns (name -> Column) and the job record."""
    return rec.emit(df, prefix)


def course_record(now: Column, **f) -> list[Column]:
    vals = {"scraped_at": now, "job_age": F.lit("unknown")}
    vals.update(f)
    return [s(vals.get(name, F.lit(None).cast("string"))).cast("string").alias(name) for name in COURSE_FIELDS]


def keep_order(df: DataFrame, rec: JobRecord) -> DataFrame:
    return rec.emit(df, {c: F.col(c) for c in ORDER_COLS})
