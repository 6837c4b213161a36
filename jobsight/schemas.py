"""Record and warehouse schemas, and the default skill dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

# The default skill dictionary, matched case-insensitively on
# word boundaries and reported with this spelling.
SKILL_KEYWORDS: list[str] = [
    "Python", "SQL", "PostgreSQL", "Airflow", "Docker", "Kubernetes",
    "Machine Learning", "FastAPI", "Flask", "Pandas", "PySpark",
    "Tableau", "AWS", "GCP", "Java", "React", "Excel", "Hadoop",
    "Spark", "Git", "Power BI", "MongoDB", "Kafka", "Golang",
    "TypeScript", "JavaScript", "Node.js", "Django", "TensorFlow",
]

# Landed job record: 18 text fields, all nullable.
JOB_FIELDS: list[str] = [
    "job_title", "job_location", "job_department", "job_url", "first_seen",
    "base_salary", "job_type", "job_level", "job_apply_end_date", "last_seen",
    "is_active", "company", "company_url", "job_board", "job_board_url",
    "job_age", "work_arrangement", "desc",
]

# Landed course record: 5 to 10 text fields.
COURSE_FIELDS: list[str] = [
    "course_title", "desc", "level", "platform", "url", "scraped_at",
    "job_age", "duration", "rating", "students",
]

RECORD_FIELDS: list[str] = JOB_FIELDS + [f for f in COURSE_FIELDS if f not in JOB_FIELDS]

JOB_RECORD = T.StructType([T.StructField(f, T.StringType(), True) for f in JOB_FIELDS])
COURSE_RECORD = T.StructType([T.StructField(f, T.StringType(), True) for f in COURSE_FIELDS])
RECORD = T.StructType([T.StructField(f, T.StringType(), True) for f in RECORD_FIELDS])

JOB_VACANCIES = T.StructType([
    T.StructField("job_id", T.LongType(), False),
    T.StructField("job_title", T.StringType(), False),
    T.StructField("company_name", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("job_url", T.StringType(), False),
    T.StructField("salary_avg", T.DecimalType(15, 2), True),
    T.StructField("job_category", T.StringType(), True),
    T.StructField("experience_level", T.StringType(), True),
    T.StructField("work_setup", T.StringType(), True),
    T.StructField("job_type", T.StringType(), True),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
    T.StructField("last_seen", T.TimestampNTZType(), True),
    T.StructField("is_active", T.BooleanType(), True),
    T.StructField("closed_at", T.TimestampNTZType(), True),
])

JOB_SKILLS = T.StructType([
    T.StructField("job_id", T.LongType(), False),
    T.StructField("skill_name", T.StringType(), False),
])

COURSES = T.StructType([
    T.StructField("course_id", T.LongType(), False),
    T.StructField("course_title", T.StringType(), False),
    T.StructField("platform", T.StringType(), True),
    T.StructField("url", T.StringType(), False),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
])

COURSE_SKILLS = T.StructType([
    T.StructField("course_id", T.LongType(), False),
    T.StructField("skill_name", T.StringType(), False),
])

WAREHOUSE = {
    "job_vacancies": JOB_VACANCIES,
    "job_skills": JOB_SKILLS,
    "courses": COURSES,
    "course_skills": COURSE_SKILLS,
}

# Column length limits of the warehouse (VARCHAR(n)); overlong is a reject.
LENGTH_LIMITS = {
    "job_vacancies": {"job_title": 255, "company_name": 255, "location": 255, "source": 50,
                      "job_category": 100, "experience_level": 50, "work_setup": 50, "job_type": 100},
    "courses": {"course_title": 255, "platform": 255},
    "job_skills": {"skill_name": 100},
    "course_skills": {"skill_name": 100},
}

RAW_PAYLOADS = T.StructType([
    T.StructField("source", T.StringType(), True),
    T.StructField("kind", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("status", T.IntegerType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("fetched_at", T.TimestampNTZType(), True),
    T.StructField("seq", T.LongType(), True),
])


def empty(spark, table: str):
    """Warehouse bootstrap: an empty DataFrame with the table's schema."""
    return spark.createDataFrame([], WAREHOUSE[table])
