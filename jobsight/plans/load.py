"""The daily load: landing lines to the four warehouse tables.

Order follows the reference load: dedup on raw keys, clean text, classify,
check, upsert jobs, close stale rows, insert courses, then append skill pairs
for the batch's members.  Records without their key are dropped before the
dedup shuffle (D1).  The parsed records and the classified batch are written
once as Parquet under the shared checkpoint folder, since several steps read
them and each needs few of their columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import classify_frame
from ..functions.text import clean_text, null_if_na, search_text
from ..operators.dedup import dedup_courses, dedup_jobs
from ..operators.filters import drop_keyless
from ..operators.lifecycle import close_stale, constraint_reasons, insert_courses, split_checked, upsert_jobs, written_checked
from ..operators.skills import append_skills, resolve_course_id, resolve_job_id
from ..schemas import SKILL_KEYWORDS, empty
from ..session import ensure_checkpoint_dir
from ..sources.landing import parse_landing, read_landing, route_records
from ..sources.snapshot import committed, publish_all, publish_snapshot, read_snapshot, table_path, written

ORDER = ("file_path", "block_start", "pos")


def with_pandas_missing(jobs: DataFrame) -> DataFrame:
    """Key-presence compatibility (trap T2) for the two fields where it shows.

    In the reference, records are unioned into one pandas frame: a key that
    some record of the batch has but this record lacks becomes NaN, which is
    truthy.  A missing location is then title-cased to 'Nan', and a missing
    department is kept as the category and nulled, instead of falling back to
    the title keywords.  Every other field ends the same as with null.  The
    batch's key presence is one aggregate row (two booleans).
    """
    if "_keys" not in jobs.columns:
        return jobs
    present = jobs.agg(*[F.max(F.array_contains("_keys", k)).alias(k)
                         for k in ("job_location", "job_department")]).collect()[0]  # one row
    out = jobs
    if present["job_location"]:
        out = out.withColumn("job_location", F.when(F.array_contains("_keys", "job_location"), F.col("job_location"))
                             .otherwise(F.lit("nan")))
    if present["job_department"]:
        out = out.withColumn("_dept_missing", ~F.array_contains("_keys", "job_department"))
    return out


def clean_job_batch(jobs: DataFrame, order: Sequence[str] = ORDER, pandas_missing: bool = False) -> DataFrame:
    """F1 then C5 then the warehouse projection (C7-C11, C8) of job records.

    ``pandas_missing=True`` reproduces the reference's treatment of keys
    missing from some records (see ``with_pandas_missing``); by default a
    missing key is the same as null.
    """
    if pandas_missing:
        jobs = with_pandas_missing(jobs)
    first = dedup_jobs(jobs, order=list(order))
    cols = [c for c in first.columns if c not in ("job_title", "desc")]
    desc = clean_text("desc") if "desc" in first.columns else F.lit("")
    cleaned = first.select(*cols, clean_text("job_title").alias("job_title"), desc.alias("desc"))
    cleaned = cleaned.withColumn("search_text", search_text("job_title", "desc"))
    extra = ["_dept_missing"] if "_dept_missing" in cleaned.columns else []
    out = classify_frame(cleaned, keep=["search_text", *order, *extra])
    if extra:
        out = out.withColumn("job_category", F.when(F.col("_dept_missing"), F.lit(None).cast("string"))
                             .otherwise(F.col("job_category")))
    return out.select(
        "job_title", "company_name", "location", "source", "job_url", "salary_avg", "salary_ok", "job_category",
        "experience_level", "work_setup", "job_type", "search_text", *order)


def clean_course_batch(courses: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """F2 then C5 of course records, with the warehouse projection."""
    first = dedup_courses(courses, order=list(order))
    cleaned = (first.withColumn("course_title", clean_text("course_title"))
               .withColumn("desc", clean_text("desc")))
    return cleaned.select(
        null_if_na("course_title").alias("course_title"),
        null_if_na("platform").alias("platform"),
        "url",
        search_text("course_title", "desc").alias("search_text"),
        *order)


def daily_load(spark: SparkSession, landing_path: str, root: str, as_of: str, run_id: str,
               keywords: Sequence[str] = SKILL_KEYWORDS, strict: bool = False, days: int = 3,
               pandas_missing: bool = False) -> dict:
    """One run of the load; returns the new manifest (and rejects under '_rejects')."""
    return load_lines(spark, read_landing(spark, landing_path), root, as_of, run_id, keywords, strict, days,
                      pandas_missing=pandas_missing)


def load_lines(spark: SparkSession, lines: DataFrame, root: str, as_of: str, run_id: str,
               keywords: Sequence[str] = SKILL_KEYWORDS, strict: bool = False, days: int = 3,
               batch_id: int | None = None, pandas_missing: bool = False) -> dict:
    """The load over landing lines ``(value, file_path, block_start, pos)``.

    ``batch_id`` is stored with the manifest, so a stream that replays a
    micro-batch after a failure can tell that it was already committed.
    """
    done = committed(spark, root, run_id)
    if done:
        return done  # a run is applied once
    ensure_checkpoint_dir(spark)
    records = written(drop_keyless(parse_landing(lines)), "records")
    if records.isEmpty():
        return {}  # no record with a key: nothing changes
    jobs_raw, courses_raw = route_records(records)

    # classified, checked and written in one pass, and read twice: for the postings and for their skills
    batch = constraint_reasons(clean_job_batch(jobs_raw, pandas_missing=pandas_missing), check_unique=False)  # F1 made the key unique
    good, rejects = split_checked(written_checked(batch, "job_vacancies", strict))
    current = read_snapshot(spark, root, "job_vacancies")
    jobs = close_stale(upsert_jobs(current, good, as_of, id_order=ORDER), as_of, days)

    # titles are unique (F2), urls need not be: G3 keeps the first of each
    courses_batch = constraint_reasons(clean_course_batch(courses_raw), "courses", check_unique=False)
    cgood, crejects = split_checked(written_checked(courses_batch, "courses", strict))
    courses = insert_courses(read_snapshot(spark, root, "courses"), cgood, as_of)

    # Write the two owner tables first and read them back: the skill pairs
    # must see exactly the ids that were published.
    jobs_path = publish_snapshot(jobs, table_path(root, run_id, "job_vacancies"))
    courses_path = publish_snapshot(courses, table_path(root, run_id, "courses"))
    jobs = spark.read.parquet(jobs_path)
    courses = spark.read.parquet(courses_path)

    job_skills = append_skills(read_snapshot(spark, root, "job_skills"),
                               resolve_job_id(good.select("job_url", "search_text"), jobs),
                               "search_text", "job_id", keywords)
    course_skills = append_skills(read_snapshot(spark, root, "course_skills"),
                                  resolve_course_id(cgood.select("course_title", "search_text"), courses),
                                  "search_text", "course_id", keywords)
    out = publish_all(spark, root, {"job_vacancies": jobs_path, "courses": courses_path,
                                    "job_skills": job_skills, "course_skills": course_skills}, run_id, batch_id)
    out["_rejects"] = rejects.unionByName(crejects, allowMissingColumns=True)
    return out


def bootstrap(spark: SparkSession, root: str, run_id: str = "init") -> dict:
    """Warehouse bootstrap: four empty tables."""
    return publish_all(spark, root, {t: empty(spark, t) for t in
                                     ("job_vacancies", "job_skills", "courses", "course_skills")}, run_id)
