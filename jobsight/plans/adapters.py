"""Posting-shaped views of the driver tables.

The driver's tables hold no job postings, so these adapters turn them into
noisy posting, sighting, course and landing-line tables.  Every adapter is a
plain projection/join of the whole input table, so its size grows with it,
and each has a twin SQL text in ``plans/oracle.py`` that DuckDB runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.payloads import read_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(x: Column, mapping: list, default) -> Column:
    out = None
    for k, v in mapping:
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(x == k, v) if out is None else out.when(x == k, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d)


# The posting adapter's noisy titles, locations and setups.
TITLES = ["Data  Engineer <b>Python</b>", "Thai Teacher", "Backend Developer (Java)",
          "Data Analyst SQL / Power BI", "JavaScript<br>React", "N/A",
          "Database Admin PostgreSQL", "Sales Lead"]
PRIORITY_SETUP = [("1-URGENT", "Partially remote"), ("2-HIGH", "WFO"), ("3-MEDIUM", "n/a"),
                  ("4-NOT SPECIFIED", "Remote (WFH)")]
SETUP_DEFAULT = "field work"


def postings(spark: SparkSession, sf_dir: str, url_by: str = "order") -> DataFrame:
    """Orders as job postings: one row per order, ~10% of urls repeated.

    ``url_by='customer'`` keys the url on the customer instead, which turns
    the orders of one customer into repeated sightings of one posting (the
    lifecycle view).  Join strategies are left to Spark.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("o_orderkey")
    if url_by == "customer":
        url = F.concat(F.lit("https://jobs.example/c/"), F.col("o_custkey").cast("string"))
    else:
        shift = F.when((k % 10 == 0) & (k > 0), F.lit(1)).otherwise(F.lit(0))
        url = F.concat(F.lit("https://jobs.example/"), (k - shift).cast("string"))
    cust = F.col("o_custkey")
    return j.select(
        k.alias("pos"),
        url.alias("job_url"),
        _case(k % 8, list(enumerate(TITLES[:-1])), TITLES[-1]).alias("job_title"),
        F.col("c_name").alias("company"),
        _case(cust % 6, [(0, "Jakarta Selatan"), (1, "kota bandung"), (2, "N/A"), (3, ""),
                         (4, "west-java d.k.i")], F.lower("n_name")).alias("job_location"),
        _case(k % 4, [(0, F.col("c_mktsegment")), (1, "N/A")], F.lit(None).cast("string")).alias("job_department"),
        _case(F.col("o_orderpriority"), PRIORITY_SETUP, SETUP_DEFAULT).alias("work_arrangement"),
        _case(k % 5, [(0, "0"), (1, "Rp 5.000.000"), (2, "")],
              F.floor("o_totalprice").cast("bigint").cast("string")).alias("base_salary"),
        F.col("o_orderstatus").alias("job_board"),
        F.col("o_orderdate").alias("seen_at"),
    )


# The course adapter's titles and descriptions.
COURSE_TITLES = ["Intro to Python <i>and</i> SQL", "Machine Learning with TensorFlow",
                 "Excel for Analysts", "N/A", "Cloud Basics: AWS, GCP", "Web Apps in JavaScript"]
COURSE_DESCS = ["Docker and Kubernetes", "pandas, PySpark", None, "Power BI dashboards",
                "Git basics; node.js"]


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as course records: titles repeat (F2), ~1/7 of urls repeat."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.col("p_partkey")
    shift = F.when((k % 7 == 0) & (k > 0), F.lit(1)).otherwise(F.lit(0))
    title = F.concat(_case(k % 6, list(enumerate(COURSE_TITLES[:-1])), COURSE_TITLES[-1]),
                     F.lit(" #"), F.col("p_size").cast("string"))
    desc = _case(k % 5, [(i, d if d is not None else F.col("p_name"))
                         for i, d in enumerate(COURSE_DESCS[:-1])], COURSE_DESCS[-1])
    return p.select(
        k.alias("pos"),
        title.alias("course_title"),
        desc.alias("desc"),
        F.col("p_type").alias("level"),
        F.col("p_brand").alias("platform"),
        F.concat(F.lit("https://courses.example/"), (k - shift).cast("string")).alias("url"),
        F.col("p_size").alias("size"),
    )


def landing_lines(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Events as landed JSON lines: jobs, courses and malformed lines.

    ``error`` events become truncated lines, ``view`` events JSON arrays,
    ``signup`` events course records (one with an explicit null title), the
    rest job records whose urls repeat (every 50th one is blank).  ``where``
    chooses the events of one day's landing.
    """
    e = table(spark, sf_dir, "events").filter(where).select("event_id", "user_id", "event_type", "value")
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id")
    cents = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    job = F.concat(
        F.lit('{"job_title": "'), F.col("event_type"), F.lit(' analyst <b>SQL</b>", "job_url": "'),
        F.when(eid % 50 == 0, F.lit("")).otherwise(F.concat(F.lit("https://jobs.example/e/"), (eid % 5000).cast("string"))),
        F.lit('", "job_board": "'), F.upper("event_type"),
        F.lit('", "base_salary": "'), cents, F.lit('", "job_location": "Jakarta"}'))
    course = F.concat(
        F.lit('{"course_title": '),
        F.when(F.col("user_id") % 10 == 0, F.lit("null")).otherwise(F.concat(F.lit('"Course '), uid, F.lit('"'))),
        F.lit(', "platform": "P'), (F.col("user_id") % 3).cast("string"),
        F.lit('", "url": "https://courses.example/u/'), uid, F.lit('", "desc": "Python and Excel"}'))
    line = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"job_title": "broken '), uid))
            .when(F.col("event_type") == "view", F.concat(F.lit('["'), uid, F.lit('"]')))
            .when(F.col("event_type") == "signup", course)
            .otherwise(job))
    return e.select(
        F.lit("events").alias("file_path"), F.lit(0).cast("bigint").alias("block_start"),
        eid.alias("pos"), line.alias("value"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet")
