"""BI questions over the warehouse tables.

All are aggregates with partial (map-side) aggregation; top-k uses
``orderBy().limit()``, which Spark plans as TakeOrderedAndProject (a bounded
heap per task, no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_skills(skills: DataFrame, n: int = 10, jobs: DataFrame | None = None,
               active_only: bool = False, id_col: str = "job_id") -> DataFrame:
    """skills by number of owners, ties by name; ``skills`` holds each (owner, skill) pair once."""
    if active_only and jobs is not None:
        skills = skills.join(jobs.filter("is_active").select(id_col), id_col, "left_semi")
    agg = skills.groupBy("skill_name").agg(F.count(id_col).alias("job_count"))
    return agg.orderBy(F.desc("job_count"), F.asc("skill_name")).limit(n)


def jobs_by_source(jobs: DataFrame) -> DataFrame:
    """total and active postings per source."""
    return jobs.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(F.col("is_active")).alias("active_jobs"))


def top_companies(jobs: DataFrame, n: int = 10) -> DataFrame:
    """companies by posting count, ties by name; unknown companies skipped."""
    agg = (jobs.filter(F.col("company_name").isNotNull())
           .groupBy("company_name").agg(F.count(F.lit(1)).alias("job_count")))
    return agg.orderBy(F.desc("job_count"), F.asc("company_name")).limit(n)


def salary_distribution(jobs: DataFrame, width: int = 5_000_000) -> DataFrame:
    """postings per salary band; 0 means unknown and is skipped."""
    band = (F.floor(F.col("salary_avg") / F.lit(width)) * F.lit(width)).cast("bigint")
    return (jobs.filter(F.col("salary_avg") > 0)
            .groupBy(band.alias("band_start")).agg(F.count(F.lit(1)).alias("job_count")))


#: Rank error of the quantile sketch, as one in this many rows.
ACCURACY = 10_000


def salary_summary(jobs: DataFrame) -> DataFrame:
    """min, median, mean and max of known salaries (one row), exact and in one lazy plan.

    A quantile sketch gives two salaries that the middle ranks must lie between
    (twice its rank error away from the middle on either side).  A second
    pass counts the rows below and the rows per salary in between, some
    4 in 10,000 of all, and the running counts of those few meet the middle ranks.
    If the sketch kept less than it promises, the query fails rather than give another median.
    """
    known = jobs.filter(F.col("salary_avg") > 0).select(F.col("salary_avg").cast("double").alias("s"))
    sketch = known.agg(F.percentile_approx("s", [0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY], ACCURACY).alias("q"))
    lo, hi = (sketch.select(F.element_at("q", k)).scalar() for k in (1, 2))
    total = known.agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.sum("s").alias("sum"),
                      F.count_if(F.col("s") < lo).alias("below"))
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    inside = known.filter((F.col("s") >= lo) & (F.col("s") <= hi)).groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    n, below = total.select("n").scalar(), total.select("below").scalar()
    upto = inside.select("s", (F.sum("c").over(Window.orderBy("s")) + below).alias("upto"), n.alias("n"))
    middle = upto.agg(F.min(F.when(F.col("upto") >= low, F.col("s"))).alias("a"), F.min(F.when(F.col("upto") >= high, F.col("s"))).alias("b"))
    a, b = middle.select("a").scalar(), middle.select("b").scalar()
    held = (F.col("n") == 0) | ((F.col("below") < low) & b.isNotNull())
    return total.select(
        F.col("n").cast("bigint").alias("n"), F.round("lo", 2).alias("min_salary"),
        F.when(held, F.round((a + b) / 2, 2)).otherwise(F.raise_error(F.lit("the sketch does not hold the median")).cast("double")).alias("median_salary"),
        F.round(F.col("sum") / F.col("n"), 2).alias("mean_salary"), F.round("hi", 2).alias("max_salary"))


def skills_gap(job_skills: DataFrame, course_skills: DataFrame) -> DataFrame:
    """F8: per skill, jobs asking (demand), courses teaching (supply), and the gap.

    Both inputs hold each (owner, skill) pair once (F3), so rows are counted.
    """
    demand = job_skills.groupBy("skill_name").agg(F.count("job_id").alias("demand"))
    supply = course_skills.groupBy("skill_name").agg(F.count("course_id").alias("supply"))
    both = demand.join(supply, "skill_name", "full_outer")
    d = F.coalesce("demand", F.lit(0)).cast("bigint")
    s = F.coalesce("supply", F.lit(0)).cast("bigint")
    return both.select("skill_name", d.alias("demand"), s.alias("supply"), (d - s).alias("gap"))


def facet_counts(jobs: DataFrame, dim: str) -> DataFrame:
    """postings per value of one dimension."""
    return jobs.groupBy(F.col(dim).alias("value")).agg(F.count(F.lit(1)).alias("job_count"))


def source_yield(records: DataFrame, source: str = "source", route: str = "route") -> DataFrame:
    """rows per source and extraction route in a run."""
    return records.groupBy(source, route).agg(F.count(F.lit(1)).alias("n_rows"))


def facet_filter(jobs: DataFrame, source=None, location=None, job_type=None, work_setup=None,
                 experience_level=None, salary_min=None, salary_max=None,
                 scraped_from=None, scraped_to=None, skill=None, skills: DataFrame | None = None) -> DataFrame:
    """The lookups the warehouse indexes serve, as pushed-down filters."""
    cond = F.lit(True)
    for col, val in (("source", source), ("location", location), ("job_type", job_type),
                     ("work_setup", work_setup), ("experience_level", experience_level)):
        if val is not None:
            cond = cond & (F.col(col).isin(list(val)) if isinstance(val, (list, tuple, set)) else F.col(col) == val)
    if salary_min is not None:
        cond = cond & (F.col("salary_avg") >= salary_min)
    if salary_max is not None:
        cond = cond & (F.col("salary_avg") <= salary_max)
    if scraped_from is not None:
        cond = cond & (F.col("scraped_at") >= F.lit(scraped_from).cast("timestamp_ntz"))
    if scraped_to is not None:
        cond = cond & (F.col("scraped_at") < F.lit(scraped_to).cast("timestamp_ntz"))
    out = jobs.filter(cond)
    if skill is not None and skills is not None:
        out = out.join(skills.filter(F.col("skill_name") == skill).select("job_id"), "job_id", "left_semi")
    return out
