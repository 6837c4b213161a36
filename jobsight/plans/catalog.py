"""Registered queries: one per operator of the inventory, over the driver tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``SQL[name]`` is the
DuckDB twin used by the correctness gate (absent for rows-only checks).
Every query reads whole tables; limits appear only where top-k is the feature.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import classify as K
from ..functions import dates as D
from ..functions import text as X
from ..operators import dedup, filters, lifecycle, pages as P, skills
from ..operators.normalise import catalog as normalise_catalog
from ..schemas import JOB_VACANCIES, RECORD, SKILL_KEYWORDS
from ..session import scratch_path
from ..sources.bucketed import publish_bucketed, read_bucketed
from ..sources.clustered import publish_clustered, read_clustered
from ..sources.landing import parse_landing, route_records, union_sources
from ..sources.snapshot import written
from . import adapters as A
from . import insights as I
from . import oracle as O
from .load import clean_course_batch

QUERIES: dict = {}
SQL: dict = {}

NOW = "2026-04-29 06:00:00"          # the run timestamp used by 'or now' rules
AS_OF = "2001-08-01 00:00:00"         # end of the sighting history
BUCKETS = 16
DOC_WORDS = ["the", "of", "and", "der", "que", "la", "von"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def P_(spark, sf):
    return A.postings(spark, sf)


def S_(spark, sf):
    return A.postings(spark, sf, url_by="customer")


P_SQL = "(" + O.postings_sql() + ")"
S_SQL = "(" + O.postings_sql("customer") + ")"
C_SQL = "(" + O.courses_sql() + ")"
L_SQL = "(" + O.landing_sql() + ")"


def classified(df: DataFrame) -> DataFrame:
    # C5 first, as its own projection: the cleaned title feeds several rules
    # and the search text, and must not be re-evaluated inside each of them.
    cols = [c for c in df.columns if c not in ("job_title",)]
    cleaned = df.select(*cols, X.clean_text("job_title").alias("job_title"),
                        X.clean_text("job_department").alias("_dept_clean"))
    cleaned = cleaned.withColumn("search_text", X.search_text("job_title", "_dept_clean"))
    return K.classify_frame(cleaned, keep=["pos", "seen_at", "search_text"]).select(
        "pos", "seen_at", "job_title", "company_name", "location", "source", "job_url", "salary_avg", "salary_ok",
        "job_category", "experience_level", "work_setup", "job_type", "search_text")


CLS_P = "(" + O.classified_sql(P_SQL) + ")"
CLS_S = "(" + O.classified_sql(S_SQL) + ")"
FIRST_P = f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY pos) AS rn FROM {P_SQL}) WHERE rn = 1)"


CLS_FIRST = "(" + O.classified_sql(FIRST_P) + ")"


# ------------------------------------------------------------------ adapters / A

@register("postings_adapter", f"SELECT * FROM {P_SQL}")
def _postings(spark, sf):
    return P_(spark, sf)


@register("parse_landing", f"""SELECT pos, value->>'job_title' AS job_title, value->>'job_url' AS job_url,
  value->>'course_title' AS course_title, value->>'platform' AS platform, value->>'url' AS url,
  value->>'base_salary' AS base_salary, value->>'job_board' AS job_board
FROM {L_SQL} WHERE json_valid(value) AND json_type(value) = 'OBJECT'""")
def _parse_landing(spark, sf):
    recs = parse_landing(A.landing_lines(spark, sf))
    return recs.select("pos", "job_title", "job_url", "course_title", "platform", "url", "base_salary", "job_board")


@register("route_records", f"""SELECT pos, CASE WHEN list_contains(json_keys(value), 'course_title') THEN 'course' ELSE 'job' END AS kind
FROM {L_SQL} WHERE json_valid(value) AND json_type(value) = 'OBJECT'""")
def _route(spark, sf):
    jobs, courses = route_records(parse_landing(A.landing_lines(spark, sf)))
    return jobs.select("pos", F.lit("job").alias("kind")).unionByName(
        courses.select("pos", F.lit("course").alias("kind")))


@register("union_sources", f"""SELECT pos, 'orders' AS origin, job_url, NULL AS url, job_title, NULL AS course_title FROM {P_SQL}
UNION ALL SELECT pos, 'part' AS origin, NULL AS job_url, url, NULL AS job_title, course_title FROM {C_SQL}""")
def _union(spark, sf):
    a = P_(spark, sf).select("pos", F.lit("orders").alias("origin"), "job_url", "job_title")
    b = A.courses(spark, sf).select("pos", F.lit("part").alias("origin"), "url", "course_title")
    return union_sources([a, b]).select("pos", "origin", "job_url", "url", "job_title", "course_title")


@register("source_yield", f"""SELECT coalesce(value->>'job_board', value->>'platform') AS source,
  CASE WHEN list_contains(json_keys(value), 'course_title') THEN 'course' ELSE 'job' END AS route, count(*) AS n_rows
FROM {L_SQL} WHERE json_valid(value) AND json_type(value) = 'OBJECT' GROUP BY ALL""")
def _source_yield(spark, sf):
    recs = parse_landing(A.landing_lines(spark, sf))
    recs = recs.select(F.coalesce("job_board", "platform").alias("source"),
                       F.when(F.array_contains("_keys", "course_title"), "course").otherwise("job").alias("route"))
    return I.source_yield(recs)


@register("drop_keyless", f"""SELECT pos, value->>'job_url' AS job_url, value->>'url' AS url, value->>'platform' AS platform
FROM {L_SQL} WHERE json_valid(value) AND json_type(value) = 'OBJECT' AND CASE WHEN coalesce(value->>'platform', '') <> ''
  THEN coalesce(value->>'url', '') <> '' ELSE coalesce(value->>'job_url', '') <> '' END""")
def _drop_keyless(spark, sf):
    recs = parse_landing(A.landing_lines(spark, sf))
    return filters.drop_keyless(recs).select("pos", "job_url", "url", "platform")


@register("drop_incomplete", f"""SELECT pos, job_url, job_location, job_department FROM {P_SQL}
WHERE coalesce(trim(job_location), '') <> '' AND coalesce(trim(job_department), '') <> ''""")
def _drop_incomplete(spark, sf):
    p = P_(spark, sf).select("pos", "job_url", "job_location", "job_department")
    return filters.drop_incomplete(p, ["job_location", "job_department"])


@register("assign_ids_summary", f"""SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id
FROM {FIRST_P}""")
def _assign_ids_summary(spark, sf):
    ids = _assign_ids(spark, sf)
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("job_id").alias("n_ids"),
                   F.min("job_id").alias("min_id"), F.max("job_id").alias("max_id"))


# ------------------------------------------------------------------ text

@register("clean_string", f"SELECT pos, {O.clean_string('job_title')} AS title_c1, {O.clean_string('job_location')} AS location_c1 FROM {P_SQL}")
def _clean_string(spark, sf):
    return P_(spark, sf).select("pos", X.clean_string("job_title").alias("title_c1"),
                                X.clean_string("job_location").alias("location_c1"))


@register("strip_html", f"SELECT pos, {O.strip_html('job_title')} AS title_c2, {O.strip_html('job_department')} AS dept_c2 FROM {P_SQL}")
def _strip_html(spark, sf):
    return P_(spark, sf).select("pos", X.strip_html("job_title").alias("title_c2"),
                                X.strip_html("job_department").alias("dept_c2"))


@register("collapse_ws", f"""SELECT pos, {O.collapse_ws("(job_title || ', ' || job_location)", dash_commas=True)} AS role_c3,
  {O.collapse_ws('job_department')} AS dept_c3 FROM {P_SQL}""")
def _collapse_ws(spark, sf):
    return P_(spark, sf).select(
        "pos", X.collapse_ws(F.concat("job_title", F.lit(", "), "job_location"), dash_commas=True).alias("role_c3"),
        X.collapse_ws("job_department").alias("dept_c3"))


@register("comma_to_dash", f"""SELECT pos, {O.comma_to_dash("concat_ws(',', job_board, job_location, job_department)")} AS joined_c4,
  {O.comma_to_dash('job_department')} AS dept_c4,
  {O.comma_to_dash('job_location', title_case=True, blank_default='N/A')} AS location_c4d,
  {O.comma_to_dash('work_arrangement', drop_word='remote', blank_default='N/A')} AS setup_c4d FROM {P_SQL}""")
def _comma_to_dash(spark, sf):
    return P_(spark, sf).select(
        "pos", X.comma_to_dash(F.concat_ws(",", "job_board", "job_location", "job_department")).alias("joined_c4"),
        X.comma_to_dash("job_department").alias("dept_c4"),
        X.comma_to_dash("job_location", title=True, blank_default="N/A").alias("location_c4d"),
        X.comma_to_dash("work_arrangement", drop_word="remote", blank_default="N/A").alias("setup_c4d"))


@register("clean_text", f"SELECT pos, {O.clean_text('job_title')} AS title_c5, {O.clean_text('job_location')} AS location_c5 FROM {P_SQL}")
def _clean_text(spark, sf):
    return P_(spark, sf).select("pos", X.clean_text("job_title").alias("title_c5"),
                                X.clean_text("job_location").alias("location_c5"))


@register("clean_documents", f"""SELECT doc_id, {O.clean_text('text')} AS text_c5, {O.clean_string('text')} AS text_c1,
  {O.strip_html('text')} AS text_c2 FROM documents""")
def _clean_documents(spark, sf):
    """C5, C1 and C2 over whole document texts."""
    d = A.documents(spark, sf)
    return d.select("doc_id", X.clean_text("text").alias("text_c5"), X.clean_string("text").alias("text_c1"),
                    X.strip_html("text").alias("text_c2"))


@register("null_if_na", f"""SELECT pos, {O.null_if_na('job_location')} AS location_c7, {O.null_if_na('work_arrangement')} AS setup_c7,
  {O.null_if_na('job_department')} AS dept_c7 FROM {P_SQL}""")
def _null_if_na(spark, sf):
    return P_(spark, sf).select("pos", X.null_if_na("job_location").alias("location_c7"),
                                X.null_if_na("work_arrangement").alias("setup_c7"),
                                X.null_if_na("job_department").alias("dept_c7"))


@register("title_case", f"""SELECT pos, {O.title('job_location')} AS location_title, {O.title('company')} AS company_title,
  {O.title('work_arrangement')} AS setup_title, {O.capitalize('work_arrangement')} AS setup_cap FROM {P_SQL}""")
def _title_case(spark, sf):
    return P_(spark, sf).select("pos", X.py_title("job_location").alias("location_title"),
                                X.py_title("company").alias("company_title"),
                                X.py_title("work_arrangement").alias("setup_title"),
                                X.py_capitalize("work_arrangement").alias("setup_cap"))


@register("absolutize_url", """SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://site.example' || href END AS abs_url,
  split_part(url, '?', 1) AS page_url FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)""")
def _absolutize(spark, sf):
    pg = A.pages(spark, sf)
    links = pg.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("href"))
    return links.select("page_id", "href", X.absolutize_url("href", "https://site.example").alias("abs_url"),
                        X.strip_query("url").alias("page_url"))


@register("first_truthy", f"SELECT pos, coalesce(nullif(job_department, ''), nullif(job_location, ''), nullif(company, '')) AS first_value FROM {P_SQL}")
def _first_truthy(spark, sf):
    return P_(spark, sf).select("pos", X.first_truthy("job_department", "job_location", "company").alias("first_value"))


@register("search_text", f"SELECT pos, {O.search_text(O.clean_text('job_title'), O.clean_text('job_department'))} AS search_text FROM {P_SQL}")
def _search_text(spark, sf):
    return P_(spark, sf).select("pos", X.search_text(X.clean_text("job_title"), X.clean_text("job_department")).alias("search_text"))


# ------------------------------------------------------------------ classification

@register("parse_salary", f"SELECT pos, base_salary, {O.parse_salary('base_salary')} AS salary_avg, {O.salary_ok('base_salary')} AS salary_ok FROM {P_SQL}")
def _parse_salary(spark, sf):
    return P_(spark, sf).select("pos", "base_salary", K.parse_salary("base_salary").alias("salary_avg"),
                                K.salary_is_numeric("base_salary").alias("salary_ok"))


@register("standardize_location", f"SELECT pos, {O.null_if_na(O.location('job_location'))} AS location FROM {P_SQL}")
def _location(spark, sf):
    raw = P_(spark, sf).select("pos", K.standardize_location("job_location").alias("_loc"))
    return raw.select("pos", X.null_if_na("_loc").alias("location"))


@register("standardize_category", f"SELECT pos, {O.null_if_na(O.category('job_department', O.clean_text('job_title')))} AS job_category FROM {P_SQL}")
def _category(spark, sf):
    p = P_(spark, sf).select("pos", "job_department", X.clean_text("job_title").alias("_t"))
    raw = p.select("pos", K.standardize_category("job_department", "_t").alias("_c"))
    return raw.select("pos", X.null_if_na("_c").alias("job_category"))


@register("standardize_work_setup", f"SELECT pos, {O.work_setup('work_arrangement')} AS work_setup FROM {P_SQL}")
def _work_setup(spark, sf):
    return P_(spark, sf).select("pos", K.standardize_work_setup("work_arrangement").alias("work_setup"))


@register("infer_arrangement", f"""SELECT pos,
  CASE WHEN contains(lower(coalesce(job_title, '')), 'remote') OR contains(lower(coalesce(work_arrangement, '')), 'remote') THEN 'Remote'
       WHEN contains(lower(coalesce(job_title, '')), 'hybrid') OR contains(lower(coalesce(work_arrangement, '')), 'hybrid') THEN 'Hybrid'
       ELSE 'On-site' END AS arrangement,
  CASE WHEN contains(coalesce(work_arrangement, ''), 'WFO') THEN 'Remote' ELSE 'On-site' END AS arrangement_cs,
  CASE WHEN pos % 3 = 0 THEN 'Remote' WHEN pos % 2 = 0 THEN 'Hybrid' ELSE 'On-site' END AS arrangement_flags
FROM {P_SQL}""")
def _arrangement(spark, sf):
    return P_(spark, sf).select(
        "pos", K.infer_arrangement(["job_title", "work_arrangement"]).alias("arrangement"),
        K.infer_arrangement(["work_arrangement"], rules=[("WFO", "Remote")], lower=False).alias("arrangement_cs"),
        K.infer_arrangement_flags(F.col("pos") % 3 == 0, F.col("pos") % 2 == 0).alias("arrangement_flags"))


# ------------------------------------------------------------------ dates

def ISO_SPARK():
    return F.date_format("seen_at", "yyyy-MM-dd'T'HH:mm:ss")

ISO_SQL = "strftime(seen_at, '%Y-%m-%dT%H:%M:%S')"
def TXT_SPARK():
    return F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss")

TXT_SQL = f"strftime(seen_at, {O.TS_FMT})"
ISO_PARSE_SQL = ("strftime(try_strptime(regexp_replace({x}, '([T ][0-9]{{2}}(:[0-9]{{2}}){{0,2}}(\\.[0-9]+)?)(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$', '\\1'), "
                 "['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d']), " + O.TS_FMT + ")")


def _iso_input_spark():
    k = F.col("pos")
    tail = F.when(k % 3 == 0, F.lit("Z")).when(k % 3 == 1, F.lit("+07:00")).otherwise(F.lit(""))
    return F.when(k % 11 == 0, F.lit("garbage")).when(k % 17 == 0, F.lit("")).otherwise(F.concat(ISO_SPARK(), tail))


ISO_INPUT_SQL = (f"CASE WHEN pos % 11 = 0 THEN 'garbage' WHEN pos % 17 = 0 THEN '' ELSE {ISO_SQL} || "
                 "CASE pos % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+07:00' ELSE '' END END")


@register("format_date", f"""SELECT pos, x, CASE WHEN {O.falsy('x')} THEN 'N/A' ELSE coalesce({ISO_PARSE_SQL.format(x='x')}, x) END AS formatted
FROM (SELECT pos, {ISO_INPUT_SQL} AS x FROM {P_SQL})""")
def _format_date(spark, sf):
    return P_(spark, sf).select("pos", _iso_input_spark().alias("x")).select("pos", "x", D.format_date("x").alias("formatted"))


@register("iso_or_now", f"""SELECT pos, x, CASE WHEN {O.falsy('x')} THEN '{NOW}' ELSE coalesce({ISO_PARSE_SQL.format(x='x')}, '{NOW}') END AS last_seen
FROM (SELECT pos, {ISO_INPUT_SQL} AS x FROM {P_SQL})""")
def _iso_or_now(spark, sf):
    return (P_(spark, sf).select("pos", _iso_input_spark().alias("x"))
            .select("pos", "x", D.iso_or_now("x", F.lit(NOW)).alias("last_seen")))


@register("iso_seconds_or_input", f"""SELECT pos, x, CASE WHEN {O.falsy('x')} THEN '' ELSE
  coalesce(strftime(try_strptime(split_part(x, '.', 1), '%Y-%m-%dT%H:%M:%S'), {O.TS_FMT}), x) END AS last_seen
FROM (SELECT pos, CASE WHEN pos % 13 = 0 THEN '' ELSE {ISO_SQL} || CASE pos % 3 WHEN 0 THEN '.123Z' WHEN 1 THEN 'Z' ELSE '' END END AS x FROM {P_SQL})""")
def _iso_seconds(spark, sf):
    k = F.col("pos")
    tail = F.when(k % 3 == 0, F.lit(".123Z")).when(k % 3 == 1, F.lit("Z")).otherwise(F.lit(""))
    x = F.when(k % 13 == 0, F.lit("")).otherwise(F.concat(ISO_SPARK(), tail))
    return P_(spark, sf).select("pos", x.alias("x")).select("pos", "x", D.iso_seconds_or_input("x").alias("last_seen"))


@register("long_date_or_now", f"""SELECT pos, x, CASE WHEN {O.falsy('x')} THEN '{NOW}' ELSE
  coalesce(strftime(try_strptime(x, '%B %d, %Y'), {O.TS_FMT}), '{NOW}') END AS posted
FROM (SELECT pos, CASE WHEN pos % 7 = 0 THEN '' WHEN pos % 11 = 0 THEN 'soon' ELSE strftime(seen_at, '%B %-d, %Y') END AS x FROM {P_SQL})""")
def _long_date(spark, sf):
    k = F.col("pos")
    x = F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit("soon")).otherwise(F.date_format("seen_at", "MMMM d, yyyy"))
    return P_(spark, sf).select("pos", x.alias("x")).select("pos", "x", D.long_date_or_now("x", F.lit(NOW)).alias("posted"))


@register("millis_or_now", f"""SELECT pos, coalesce(strftime(epoch_ms(ms), {O.TS_FMT}), '{NOW}') AS last_seen
FROM (SELECT pos, CASE WHEN pos % 9 = 0 THEN NULL ELSE pos * 3600000 + pos % 1000 END AS ms FROM {P_SQL})""")
def _millis(spark, sf):
    k = F.col("pos")
    ms = F.when(k % 9 == 0, F.lit(None)).otherwise(k * 3600000 + k % 1000)
    return P_(spark, sf).select("pos", D.millis_or_now(ms, F.lit(NOW)).alias("last_seen"))


@register("apply_end_date", f"""SELECT pos, x, coalesce(strftime(try_strptime(x, '%Y-%m-%d %H:%M:%S') + INTERVAL 30 DAY, {O.TS_FMT}), 'N/A') AS end_date
FROM (SELECT pos, CASE WHEN pos % 6 = 0 THEN 'N/A' ELSE {TXT_SQL} END AS x FROM {P_SQL})""")
def _end_date(spark, sf):
    x = F.when(F.col("pos") % 6 == 0, F.lit("N/A")).otherwise(TXT_SPARK())
    return P_(spark, sf).select("pos", x.alias("x")).select("pos", "x", D.apply_end_date("x").alias("end_date"))


@register("job_age", f"""SELECT pos, CASE WHEN a IS NULL OR b IS NULL THEN 'unknown'
  WHEN dd <= 1 THEN 'new' WHEN dd <= 7 THEN 'hot' WHEN dd <= 15 THEN 'recent' WHEN dd <= 21 THEN 'aging'
  WHEN dd <= 30 THEN 'old' ELSE 'expired' END AS job_age
FROM (SELECT pos, a, b, floor(abs(epoch(b) - epoch(a)) / 86400) AS dd FROM (
  SELECT pos, try_strptime(first_seen, '%Y-%m-%d %H:%M:%S') AS a, try_strptime(last_seen, '%Y-%m-%d %H:%M:%S') AS b FROM (
    SELECT pos, {TXT_SQL} AS first_seen,
      CASE WHEN pos % 13 = 0 THEN 'unknown text' ELSE strftime(seen_at + to_days(CAST(pos % 40 AS INTEGER)) + to_hours(CAST(pos % 24 AS INTEGER)), {O.TS_FMT}) END AS last_seen
    FROM {P_SQL})))""")
def _job_age(spark, sf):
    k = F.col("pos")
    shifted = F.col("seen_at") + F.make_dt_interval((k % 40).cast("int"), (k % 24).cast("int"))
    last = F.when(k % 13 == 0, F.lit("unknown text")).otherwise(F.date_format(shifted, "yyyy-MM-dd HH:mm:ss"))
    return P_(spark, sf).select("pos", D.job_age(TXT_SPARK(), last).alias("job_age"))


# ------------------------------------------------------------------ dedup, keywords

@register("dedup_jobs", f"SELECT * FROM {FIRST_P}")
def _dedup_jobs(spark, sf):
    p = P_(spark, sf)
    return dedup.dedup_jobs(p, order=["pos"])


@register("dedup_courses", f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY course_title ORDER BY pos) AS rn FROM {C_SQL}) WHERE rn = 1")
def _dedup_courses(spark, sf):
    c = A.courses(spark, sf)
    return dedup.dedup_courses(c, order=["pos"])


E3_SQL = f"SELECT c.pos, c.job_url, kw.skill_name FROM {CLS_P} c, {O.keyword_values()} WHERE regexp_matches(c.search_text, kw.pat)"


@register("match_keywords", E3_SQL)
def _match_keywords(spark, sf):
    return skills.match_keywords(classified(P_(spark, sf)).select("pos", "job_url", "search_text"),
                                 "search_text", keep=["pos", "job_url"])


@register("match_keywords_documents", f"""SELECT d.doc_id, kw.skill_name FROM documents d, {O.unicode_keyword_values(DOC_WORDS)}
WHERE regexp_matches(lower(d.text), kw.pat)""")
def _match_documents(spark, sf):
    docs = A.documents(spark, sf).select("doc_id", F.lower("text").alias("t"))
    return skills.match_keywords(docs, "t", DOC_WORDS, keep=["doc_id"])


def benchmark_dictionary(spark, sf):
    """A dictionary Spark derives from ``benchmark``: long words and word pairs."""
    b = A.table(spark, sf, "benchmark").select(F.lower("text").alias("t"))
    words = b.select(F.explode(F.regexp_extract_all("t", F.lit(r"(?U)\w{5,}"), 0)).alias("keyword"))
    pairs = b.select(F.explode(F.regexp_extract_all("t", F.lit(r"(?U)\w+ \w+"), 0)).alias("keyword"))
    return words.unionByName(pairs).distinct()


WCLASS = r"[\p{L}\p{Mn}\p{Mc}\p{Me}\p{Nd}\p{Nl}\p{Pc}]"


@register("match_keywords_dictionary", f"""WITH dict AS (
  SELECT DISTINCT w AS skill_name FROM (
    SELECT unnest(regexp_extract_all(lower(text), '{WCLASS}{{5,}}')) AS w FROM benchmark
    UNION ALL SELECT unnest(regexp_extract_all(lower(text), '{WCLASS}+ {WCLASS}+')) AS w FROM benchmark)),
runs AS (SELECT doc_id, regexp_extract_all(lower(text), '{WCLASS}+') AS t, regexp_extract_all(lower(text), '[^{WCLASS[1:-1]}]+') AS s,
  CASE WHEN regexp_matches(lower(text), '^[^{WCLASS[1:-1]}]') THEN 1 ELSE 0 END AS off FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(t) AS g FROM runs
  UNION SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || s[i + off] || t[i + 1])) AS g FROM runs)
SELECT doc_id, skill_name FROM grams JOIN dict ON g = skill_name""")
def _match_dictionary(spark, sf):
    docs = A.documents(spark, sf).select("doc_id", F.lower("text").alias("t"))
    return skills.match_keywords_join(docs, "t", benchmark_dictionary(spark, sf), keep=["doc_id"])


@register("distinct_pairs", f"SELECT DISTINCT job_url, skill_name FROM ({E3_SQL})")
def _distinct_pairs(spark, sf):
    return dedup.distinct_pairs(_match_keywords(spark, sf), ["job_url", "skill_name"])


TOP_SQL = f"""SELECT skill_name, count(DISTINCT job_url) AS job_count FROM (
  SELECT c.job_url, kw.skill_name FROM {CLS_FIRST} c, {O.keyword_values()}
  WHERE regexp_matches(c.search_text, kw.pat)) GROUP BY skill_name ORDER BY job_count DESC, skill_name LIMIT 10"""


def top_skills_flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: top skills among distinct postings (F1 -> C5 -> E3 -> F4)."""
    first = dedup.dedup_jobs(P_(spark, sf), order=["pos"])
    pairs = skills.match_keywords(classified(first), "search_text", keep=["job_url"])
    return I.top_skills(pairs, n=10, id_col="job_url")


register("top_skills", TOP_SQL)(top_skills_flagship)


# ------------------------------------------------------------------ batch + constraints

BATCH_SQL = f"""SELECT job_title, company_name, location, source, job_url, salary_avg, salary_ok, job_category,
  experience_level, work_setup, job_type FROM {CLS_FIRST}"""


@register("clean_job_batch", BATCH_SQL)
def _clean_batch(spark, sf):
    first = dedup.dedup_jobs(P_(spark, sf), order=["pos"])
    return classified(first).drop("pos", "seen_at", "search_text")


REASON_SQL = """concat_ws(';',
  CASE WHEN job_title IS NULL THEN 'job_title_null' END, CASE WHEN job_url IS NULL THEN 'job_url_null' END,
  CASE WHEN length(company_name) > 255 THEN 'company_name_too_long' END,
  CASE WHEN NOT salary_ok THEN 'salary_not_numeric' END,
  CASE WHEN salary_ok AND salary_avg IS NULL THEN 'salary_out_of_range' END{more})"""


@register("check_constraints", f"""SELECT * FROM (SELECT *, {REASON_SQL.format(more='')} AS reject_reason FROM ({BATCH_SQL}))""")
def _check(spark, sf):
    """Accepted rows (no reason) and rejects, in one pass."""
    return lifecycle.constraint_reasons(_clean_batch(spark, sf), "job_vacancies", check_unique=False)


@register("check_constraints_unique", f"""SELECT job_url, pos, {REASON_SQL.format(more=", CASE WHEN n > 1 THEN 'duplicate_key' END")} AS reject_reason
FROM (SELECT *, count(*) OVER (PARTITION BY job_url) AS n FROM {CLS_P})""")
def _check_unique(spark, sf):
    """The same on postings that were not deduplicated: rows of a repeated url are refused."""
    checked = lifecycle.constraint_reasons(classified(P_(spark, sf)), "job_vacancies")
    return checked.select("job_url", "pos", "reject_reason")


# ------------------------------------------------------------------ lifecycle

def sightings(spark, sf):
    return classified(S_(spark, sf))


@register("replay_closed_form", f"SELECT * FROM {O.closed_form_sql(CLS_S, AS_OF)}")
def _closed_form(spark, sf):
    return lifecycle.replay_closed_form(sightings(spark, sf), AS_OF)


# the history is replayed in three spans of days, each merged into the state before it
SPANS = ["1995-01-01", "1998-06-01"]


@register("replay_incremental", f"SELECT * FROM {O.closed_form_sql(CLS_S, AS_OF)}")
def _replay_incremental(spark, sf):
    s = sightings(spark, sf)
    day = F.to_date("seen_at")
    cuts = [None, *[F.lit(d).cast("date") for d in SPANS], None]
    state = None
    for a, b in zip(cuts, cuts[1:]):
        span = s.filter((F.lit(True) if a is None else day >= a) & (F.lit(True) if b is None else day < b))
        step = lifecycle.interval_state(span)
        state = step if state is None else lifecycle.merge_states(state, step)
    return lifecycle.state_at(state, AS_OF)


JOB_OUT = ["job_title", "company_name", "location", "source", "job_url", "salary_avg", "job_category",
           "experience_level", "work_setup", "job_type", "scraped_at", "last_seen", "is_active", "closed_at"]
# all sightings: those before the cut make the state, the others the batch
G1_CUT, G1_END = "2000-01-01 00:00:00", "2002-01-01 00:00:00"
G1_STATE = O.closed_form_sql(f"(SELECT * FROM {CLS_S} WHERE seen_at < TIMESTAMP '{G1_CUT}')", "1999-12-31 00:00:00")
G1_BATCH = (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY pos) AS rn FROM {CLS_S} "
            f"WHERE seen_at >= TIMESTAMP '{G1_CUT}' AND seen_at < TIMESTAMP '{G1_END}') WHERE rn = 1)")


def _g1_upsert_sql(state: str = G1_STATE, batch: str = G1_BATCH, as_of: str = G1_END) -> str:
    now = f"TIMESTAMP '{as_of}'"
    cols = []
    for c in JOB_OUT:
        if c == "job_url":
            cols.append("coalesce(c.job_url, b.job_url) AS job_url")
        elif c in ("job_title", "salary_avg", "work_setup"):
            cols.append(f"CASE WHEN b.job_url IS NOT NULL THEN b.{c} ELSE c.{c} END AS {c}")
        elif c in O.BATCH_COLS:
            cols.append(f"CASE WHEN c.job_url IS NOT NULL THEN c.{c} ELSE b.{c} END AS {c}")
        elif c == "scraped_at":
            cols.append(f"CASE WHEN c.job_url IS NOT NULL THEN c.scraped_at ELSE {now} END AS scraped_at")
        elif c == "last_seen":
            cols.append(f"CASE WHEN b.job_url IS NOT NULL THEN {now} ELSE c.last_seen END AS last_seen")
        elif c == "is_active":
            cols.append("CASE WHEN b.job_url IS NOT NULL THEN TRUE ELSE c.is_active END AS is_active")
        elif c == "closed_at":
            cols.append("c.closed_at AS closed_at")
    return f"SELECT {', '.join(cols)} FROM {state} c FULL OUTER JOIN {batch} b ON c.job_url = b.job_url"


def _close_sql(src: str, as_of: str, days: int = 3) -> str:
    stale = (f"(last_seen < CAST(CAST(TIMESTAMP '{as_of}' AS DATE) - {days} AS TIMESTAMP) AND is_active)")
    rest = [c for c in JOB_OUT if c not in ("is_active", "closed_at")]
    return (f"SELECT {', '.join(rest)}, CASE WHEN {stale} THEN FALSE ELSE is_active END AS is_active, "
            f"CASE WHEN {stale} THEN TIMESTAMP '{as_of}' ELSE closed_at END AS closed_at FROM ({src})")


def _g1_state(spark, sf):
    s = sightings(spark, sf)
    state = lifecycle.replay_closed_form(s.filter(F.col("seen_at") < F.lit(G1_CUT).cast("timestamp_ntz")),
                                         "1999-12-31 00:00:00")
    return state.withColumn("job_id", F.lit(None).cast("long"))


@register("upsert_jobs", _close_sql(_g1_upsert_sql(), G1_END))
def _upsert(spark, sf):
    s = sightings(spark, sf)
    state = lifecycle.assign_ids(_g1_state(spark, sf).drop("job_id"), "job_id", 0, order=["job_url"])
    win = s.filter((F.col("seen_at") >= F.lit(G1_CUT).cast("timestamp_ntz")) &
                   (F.col("seen_at") < F.lit(G1_END).cast("timestamp_ntz")))
    batch = dedup.first_per_key(win, "job_url", ["pos"])
    out = lifecycle.close_stale(lifecycle.upsert_jobs(state, batch, G1_END), G1_END)
    return out.select(*JOB_OUT)


@register("upsert_jobs_bucketed", _close_sql(_g1_upsert_sql(), G1_END))
def _upsert_bucketed(spark, sf):
    """The same on a snapshot published in buckets of its key."""
    path = scratch_path(spark, f"bucketed-{uuid.uuid4().hex}")
    state = lifecycle.assign_ids(_g1_state(spark, sf).drop("job_id"), "job_id", 0, order=["job_url"])
    publish_bucketed(state.select(*lifecycle.JOB_COLS), path, buckets=BUCKETS)
    current = read_bucketed(spark, path, JOB_VACANCIES, buckets=BUCKETS)
    win = sightings(spark, sf).filter((F.col("seen_at") >= F.lit(G1_CUT).cast("timestamp_ntz")) &
                                      (F.col("seen_at") < F.lit(G1_END).cast("timestamp_ntz")))
    batch = dedup.first_per_key(win, "job_url", ["pos"])
    out = lifecycle.close_stale(lifecycle.upsert_jobs(current, batch, G1_END), G1_END)
    return out.select(*JOB_OUT)


# a state over all sightings that ran last some days before the run that closes
AS_OF_STATE, AS_OF_CLOSE = "1998-08-01 00:00:00", "1998-08-06 10:00:00"


@register("close_stale", _close_sql(f"SELECT * FROM {O.closed_form_sql(CLS_S, AS_OF_STATE)}", AS_OF_CLOSE))
def _close(spark, sf):
    state = lifecycle.replay_closed_form(sightings(spark, sf), AS_OF_STATE)
    return lifecycle.close_stale(state, AS_OF_CLOSE).select(*JOB_OUT)


@register("stale_predicate", f"""SELECT pos, job_url, (seen_at < CAST(CAST(TIMESTAMP '2001-07-15 10:00:00' AS DATE) - 3 AS TIMESTAMP)) AS stale
FROM {S_SQL}""")
def _stale(spark, sf):
    s = S_(spark, sf)
    return s.select("pos", "job_url", lifecycle.stale_predicate("seen_at", F.lit(True), "2001-07-15 10:00:00").alias("stale"))


@register("assign_ids", f"SELECT job_url, pos, row_number() OVER (ORDER BY source, pos) AS job_id FROM (SELECT *, job_board AS source FROM {FIRST_P})")
def _assign_ids(spark, sf):
    """Ids of the distinct posting urls in the order of (source, position), as files land by source."""
    first = dedup.dedup_jobs(P_(spark, sf), order=["pos"]).select("job_url", "pos", "job_board")
    return lifecycle.assign_ids(first, "job_id", 0, order=["job_board", "pos"], compact=True).select("job_url", "pos", "job_id")


# ------------------------------------------------------------------ courses

def _course_batch(spark, sf, where=None):
    c = A.courses(spark, sf)
    if where is not None:
        c = c.filter(where)
    c = c.withColumn("file_path", F.lit("part")).withColumn("block_start", F.lit(0))
    return clean_course_batch(c)


def _c_batch_sql(where: str = "TRUE") -> str:
    return f"""(SELECT {O.null_if_na(O.clean_text('course_title'))} AS course_title, {O.null_if_na('platform')} AS platform,
  coalesce(url, '') AS url, {O.search_text(O.clean_text('course_title'), O.clean_text('"desc"'))} AS search_text, pos
FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY course_title ORDER BY pos) AS rn
  FROM {C_SQL} WHERE {where}) WHERE rn = 1))"""


C_BATCH_SQL = _c_batch_sql()
C_GOOD_SQL = f"(SELECT * FROM {C_BATCH_SQL} WHERE course_title IS NOT NULL)"
# Two daily course batches: small parts first, then larger ones (sizes 21-30 in both).
DAY1, DAY2 = "size <= 30", "size > 20"


def _first_url_sql(where: str) -> str:
    return (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS rn "
            f"FROM (SELECT * FROM {_c_batch_sql(where)} WHERE course_title IS NOT NULL)) WHERE rn = 1)")


@register("insert_courses", f"""SELECT course_title, platform, url, TIMESTAMP '2026-04-01' AS scraped_at FROM {_first_url_sql(DAY1)}
UNION ALL SELECT course_title, platform, url, TIMESTAMP '2026-04-02' AS scraped_at FROM {_first_url_sql(DAY2)} n
WHERE NOT EXISTS (SELECT 1 FROM {_first_url_sql(DAY1)} o WHERE o.url = n.url)""")
def _insert_courses(spark, sf):
    empty = spark.createDataFrame([], "course_id long, course_title string, platform string, url string, scraped_at timestamp_ntz")
    state = empty
    for as_of, where in (("2026-04-01", DAY1), ("2026-04-02", DAY2)):
        good, _ = lifecycle.check_constraints(_course_batch(spark, sf, where), "courses", check_unique=False)
        state = lifecycle.insert_courses(state, good, as_of, order=["pos"])
    return state.select("course_title", "platform", "url", "scraped_at")


@register("resolve_course_id", f"""SELECT b.course_title, i.course_id FROM {C_GOOD_SQL} b
JOIN (SELECT {O.clean_text('course_title')} AS course_title, max(pos) AS course_id FROM {C_SQL} GROUP BY 1) i ON b.course_title = i.course_title""")
def _resolve_course(spark, sf):
    good, _ = lifecycle.check_constraints(_course_batch(spark, sf), "courses", check_unique=False)
    stored = A.courses(spark, sf).select(X.clean_text("course_title").alias("course_title"), F.col("pos").alias("course_id"))
    return skills.resolve_course_id(good.select("course_title"), stored).select("course_title", "course_id")


@register("resolve_job_id", f"""SELECT p.pos, p.job_url, f.pos AS job_id FROM {P_SQL} p JOIN {FIRST_P} f ON p.job_url = f.job_url""")
def _resolve_job(spark, sf):
    jobs = dedup.dedup_jobs(P_(spark, sf), order=["pos"]).select("job_url", F.col("pos").alias("job_id"))
    return skills.resolve_job_id(P_(spark, sf).select("pos", "job_url"), jobs).select("pos", "job_url", "job_id")


# ------------------------------------------------------------------ set operators

PAIRS_SQL = (f"(SELECT DISTINCT c.pos AS job_id, c.seen_at, kw.skill_name FROM {CLS_FIRST} c, {O.keyword_values()} "
             "WHERE regexp_matches(c.search_text, kw.pat))")
# Yesterday's pairs are those of postings first seen before the cut; today's
# batch holds the postings seen since half a year earlier (an overlap).
PAIR_CUT, PAIR_FROM = "1998-01-01", "1997-07-01"


def _pairs(spark, sf):
    first = classified(dedup.dedup_jobs(P_(spark, sf), order=["pos"]))
    return first, skills.match_keywords(first.withColumnRenamed("pos", "job_id"), "search_text", keep=["job_id", "seen_at"])


def _ts_lit(x: str):
    return F.lit(x).cast("timestamp_ntz")


@register("insert_absent", f"""SELECT job_id, skill_name FROM {PAIRS_SQL} WHERE seen_at < TIMESTAMP '{PAIR_CUT}'
UNION ALL SELECT job_id, skill_name FROM {PAIRS_SQL} n WHERE seen_at >= TIMESTAMP '{PAIR_FROM}' AND NOT EXISTS (
  SELECT 1 FROM {PAIRS_SQL} o WHERE o.seen_at < TIMESTAMP '{PAIR_CUT}' AND o.job_id = n.job_id AND o.skill_name = n.skill_name)""")
def _insert_absent(spark, sf):
    _, pairs = _pairs(spark, sf)
    old = dedup.distinct_pairs(pairs.filter(F.col("seen_at") < _ts_lit(PAIR_CUT)))
    new = dedup.distinct_pairs(pairs.filter(F.col("seen_at") >= _ts_lit(PAIR_FROM)))
    return lifecycle.insert_absent(old, new, ["job_id", "skill_name"])


@register("append_skills", f"""SELECT job_id, skill_name FROM {PAIRS_SQL} WHERE seen_at < TIMESTAMP '{PAIR_CUT}'
UNION ALL SELECT job_id, skill_name FROM {PAIRS_SQL} n WHERE seen_at >= TIMESTAMP '{PAIR_FROM}' AND NOT EXISTS (
  SELECT 1 FROM {PAIRS_SQL} o WHERE o.seen_at < TIMESTAMP '{PAIR_CUT}' AND o.job_id = n.job_id AND o.skill_name = n.skill_name)""")
def _append_skills(spark, sf):
    first, pairs = _pairs(spark, sf)
    existing = dedup.distinct_pairs(pairs.filter(F.col("seen_at") < _ts_lit(PAIR_CUT)))
    owners = first.withColumnRenamed("pos", "job_id").filter(F.col("seen_at") >= _ts_lit(PAIR_FROM))
    return skills.append_skills(existing, owners, "search_text", "job_id")


@register("cascade_delete", f"""SELECT job_id, skill_name FROM {PAIRS_SQL} s WHERE EXISTS (SELECT 1 FROM {FIRST_P} f WHERE f.pos = s.job_id AND f.seen_at < TIMESTAMP '1998-01-01')""")
def _cascade(spark, sf):
    first, pairs = _pairs(spark, sf)
    parents = first.filter(F.col("seen_at") < F.lit("1998-01-01").cast("timestamp_ntz")).select(F.col("pos").alias("job_id"))
    return lifecycle.cascade_delete(dedup.distinct_pairs(pairs), parents, "job_id")


@register("orphan_check", f"""SELECT job_id, skill_name FROM {PAIRS_SQL} s WHERE NOT EXISTS (SELECT 1 FROM {FIRST_P} f WHERE f.pos = s.job_id AND f.seen_at < TIMESTAMP '1998-01-01')""")
def _orphans(spark, sf):
    first, pairs = _pairs(spark, sf)
    parents = first.filter(F.col("seen_at") < F.lit("1998-01-01").cast("timestamp_ntz")).select(F.col("pos").alias("job_id"))
    return lifecycle.orphan_check(dedup.distinct_pairs(pairs), parents, "job_id")


# ------------------------------------------------------------------ insights

W_SQL = f"(SELECT * FROM {O.closed_form_sql(CLS_S, AS_OF)})"


def warehouse_jobs(spark, sf, columns=None):
    return lifecycle.replay_closed_form(sightings(spark, sf), AS_OF, columns=columns)


@register("jobs_by_source", f"SELECT source, count(*) AS total_jobs, CAST(count_if(is_active) AS BIGINT) AS active_jobs FROM {W_SQL} GROUP BY source")
def _by_source(spark, sf):
    return I.jobs_by_source(warehouse_jobs(spark, sf, ["source", "is_active"]))


@register("top_companies", f"""SELECT company_name, count(*) AS job_count FROM {W_SQL} WHERE company_name IS NOT NULL
GROUP BY company_name ORDER BY job_count DESC, company_name LIMIT 10""")
def _top_companies(spark, sf):
    return I.top_companies(warehouse_jobs(spark, sf, ["company_name"]), 10)


@register("salary_distribution", f"""SELECT CAST(floor(salary_avg / 5000) * 5000 AS BIGINT) AS band_start, count(*) AS job_count
FROM {W_SQL} WHERE salary_avg > 0 GROUP BY 1""")
def _salary_dist(spark, sf):
    return I.salary_distribution(warehouse_jobs(spark, sf, ["salary_avg"]), width=5000)


@register("salary_summary", f"""SELECT count(*) AS n, round(min(CAST(salary_avg AS DOUBLE)), 2) AS min_salary,
  round(quantile_cont(CAST(salary_avg AS DOUBLE), 0.5), 2) AS median_salary, round(avg(CAST(salary_avg AS DOUBLE)), 2) AS mean_salary,
  round(max(CAST(salary_avg AS DOUBLE)), 2) AS max_salary FROM {W_SQL} WHERE salary_avg > 0""")
def _salary_summary(spark, sf):
    return I.salary_summary(warehouse_jobs(spark, sf, ["salary_avg"]))


@register("skills_gap", f"""WITH d AS (SELECT kw.skill_name, count(DISTINCT c.job_url) AS demand FROM {CLS_S} c, {O.keyword_values()}
    WHERE regexp_matches(c.search_text, kw.pat) GROUP BY 1),
  s AS (SELECT kw.skill_name, count(DISTINCT c.url) AS supply FROM {C_GOOD_SQL} c, {O.keyword_values()}
    WHERE regexp_matches(c.search_text, kw.pat) GROUP BY 1)
SELECT coalesce(d.skill_name, s.skill_name) AS skill_name, coalesce(demand, 0) AS demand, coalesce(supply, 0) AS supply,
  coalesce(demand, 0) - coalesce(supply, 0) AS gap FROM d FULL OUTER JOIN s ON d.skill_name = s.skill_name""")
def _skills_gap(spark, sf):
    demand = dedup.distinct_pairs(skills.match_keywords(sightings(spark, sf), "search_text", keep=["job_url"])
                                  .withColumnRenamed("job_url", "job_id"))
    good, _ = lifecycle.check_constraints(_course_batch(spark, sf), "courses", check_unique=False)
    supply = dedup.distinct_pairs(skills.match_keywords(good, "search_text", keep=["url"])
                                  .withColumnRenamed("url", "course_id"), ["course_id", "skill_name"])
    return I.skills_gap(demand, supply)


for _dim in ("location", "work_setup", "job_category", "source"):
    def _mk(dim):
        def fn(spark, sf):
            return I.facet_counts(warehouse_jobs(spark, sf, [dim]), dim)
        return fn
    register(f"facet_counts_{_dim}", f"SELECT {_dim} AS value, count(*) AS job_count FROM {W_SQL} GROUP BY 1")(_mk(_dim))


@register("facet_filter", f"""SELECT * FROM {W_SQL} WHERE location = 'DKI Jakarta' AND work_setup IN ('Hybrid', 'Onsite')
  AND salary_avg >= 1000 AND salary_avg <= 300000 AND scraped_at >= TIMESTAMP '1996-01-01'""")
def _facet_filter(spark, sf):
    return facet_lookup(warehouse_jobs(spark, sf))


def facet_lookup(jobs):
    return I.facet_filter(jobs, location="DKI Jakarta", work_setup=["Hybrid", "Onsite"],
                          salary_min=1000, salary_max=300000, scraped_from="1996-01-01")


@register("facet_filter_published", f"""SELECT * FROM {W_SQL} WHERE location = 'DKI Jakarta' AND work_setup IN ('Hybrid', 'Onsite')
  AND salary_avg >= 1000 AND salary_avg <= 300000 AND scraped_at >= TIMESTAMP '1996-01-01'""")
def _facet_filter_published(spark, sf):
    """The same lookup on the published snapshot, clustered by its facets: the filters reach the scan."""
    path = scratch_path(spark, f"clustered-{uuid.uuid4().hex}")
    publish_clustered(warehouse_jobs(spark, sf), path)
    return facet_lookup(read_clustered(spark, path))


def _detailed(spark, sf):
    """The warehouse rows with a job type by the url's number and a level by the salary."""
    jobs = warehouse_jobs(spark, sf)
    n = F.regexp_extract("job_url", "([0-9]+)$", 1).cast("long")
    return jobs.withColumns({
        "job_type": A._case(n % 3, [(0, "Full-time"), (1, "Contract")], F.lit(None).cast("string")),
        "experience_level": F.when(F.col("salary_avg") > 150000, "Senior").when(F.col("salary_avg") > 0, "Junior")})


D_SQL = f"""(SELECT * REPLACE (CASE CAST(regexp_extract(job_url, '([0-9]+)$', 1) AS BIGINT) % 3 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Contract' END AS job_type,
  CASE WHEN salary_avg > 150000 THEN 'Senior' WHEN salary_avg > 0 THEN 'Junior' END AS experience_level) FROM {W_SQL})"""

for _dim in ("job_type", "experience_level"):
    def _mk2(dim):
        def fn(spark, sf):
            return I.facet_counts(_detailed(spark, sf), dim)
        return fn
    register(f"facet_counts_{_dim}", f"SELECT {_dim} AS value, count(*) AS job_count FROM {D_SQL} GROUP BY 1")(_mk2(_dim))

S_PAIRS_SQL = (f"(SELECT DISTINCT c.job_url, kw.skill_name FROM {CLS_S} c, {O.keyword_values()} WHERE regexp_matches(c.search_text, kw.pat))")


def _sighting_pairs(spark, sf):
    return dedup.distinct_pairs(skills.match_keywords(sightings(spark, sf), "search_text", keep=["job_url"]), ["job_url", "skill_name"])


@register("facet_filter_details", f"""SELECT * FROM {D_SQL} j WHERE job_type IN ('Contract') AND experience_level = 'Senior'
  AND EXISTS (SELECT 1 FROM {S_PAIRS_SQL} p WHERE p.job_url = j.job_url AND p.skill_name = 'SQL')""")
def _facet_details(spark, sf):
    """Job type, level and skill."""
    pairs = _sighting_pairs(spark, sf).withColumnRenamed("job_url", "job_id")
    jobs = _detailed(spark, sf).withColumn("job_id", F.col("job_url"))
    return I.facet_filter(jobs, job_type=["Contract"], experience_level="Senior", skill="SQL", skills=pairs).drop("job_id")


@register("top_skills_active", f"""SELECT skill_name, count(*) AS job_count FROM {S_PAIRS_SQL} p
WHERE job_url IN (SELECT job_url FROM {O.closed_form_sql(CLS_S, AS_OF_STATE)} WHERE is_active)
GROUP BY skill_name ORDER BY job_count DESC, skill_name LIMIT 10""")
def _top_skills_active(spark, sf):
    """F4 among the postings that are open."""
    jobs = lifecycle.replay_closed_form(sightings(spark, sf), AS_OF_STATE, columns=["job_url", "is_active"])
    return I.top_skills(_sighting_pairs(spark, sf), n=10, jobs=jobs, active_only=True, id_col="job_url")


# G8 step by step: the runs of four days spread over the whole history, each with all sightings since the last
RUNS = ["1994-01-01", "1996-01-01", "1996-01-03", "2002-01-01"]
R_SIGHT_SQL = (f"(SELECT * REPLACE (CASE " + " ".join(f"WHEN seen_at < TIMESTAMP '{d}' THEN TIMESTAMP '{d}'" for d in RUNS)
               + f" END AS seen_at) FROM {CLS_S})")


@register("replay", f"SELECT * FROM {O.closed_form_sql(R_SIGHT_SQL, RUNS[-1] + ' 00:00:00')}")
def _replay(spark, sf):
    """G8 as a fold of dated runs; its twin is the closed form over the same runs."""
    s = written(sightings(spark, sf), "sightings")
    batches, low = [], None
    for day in RUNS:
        window = F.col("seen_at") < _ts_lit(day)
        window = window if low is None else window & (F.col("seen_at") >= _ts_lit(low))
        batches.append((f"{day} 00:00:00", dedup.first_per_key(s.filter(window), "job_url", ["pos"])))
        low = day
    # runs without records still close, on the day the closed form names
    extra = [(f"{d} 00:00:00", None) for d in ("1994-01-05", "1996-01-05", "1996-01-07")]
    state = lifecycle.replay(spark.createDataFrame([], JOB_VACANCIES), [*batches, *extra])
    return state.select(*JOB_OUT)


# ------------------------------------------------------------------ the daily load end to end (§3.1)

LOAD_AS_OF = "2026-04-29 06:00:00"


def _load_events(spark, sf):
    """Run the whole load on the events landing lines into a fresh warehouse
    under the session's checkpoint folder; returns the warehouse root."""
    import uuid

    from ..session import scratch_path
    from .load import bootstrap, load_lines
    root = scratch_path(spark, f"warehouse-{uuid.uuid4().hex}")
    bootstrap(spark, root)
    load_lines(spark, A.landing_lines(spark, sf), root, LOAD_AS_OF, "r1")
    return root


# D1 on a landed line
KEYED_SQL = ("CASE WHEN coalesce(value->>'platform', '') <> '' THEN coalesce(value->>'url', '') <> '' "
             "ELSE coalesce(value->>'job_url', '') <> '' END")


def _load_course_sql() -> str:
    t = O.clean_text("value->>'course_title'")
    desc = """value->>'desc'"""
    title = f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY value->>'course_title' ORDER BY pos) AS rn FROM {L_SQL} " \
            f"WHERE json_valid(value) AND json_type(value) = 'OBJECT' AND list_contains(json_keys(value), 'course_title') AND {KEYED_SQL}) WHERE rn = 1)"
    rows = f"""SELECT {O.null_if_na(t)} AS course_title, {O.null_if_na("value->>'platform'")} AS platform, value->>'url' AS url,
  {O.search_text(t, O.clean_text(desc))} AS search_text, pos FROM {title}"""
    return (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS rn FROM ({rows}) "
            "WHERE course_title IS NOT NULL) WHERE rn = 1)")


def _load_job_sql(lines: str = L_SQL) -> str:
    t = O.clean_text("value->>'job_title'")
    cols = f"""{O.null_if_na(t)} AS job_title, {O.null_if_na("value->>'company'")} AS company_name,
  {O.null_if_na(O.location("value->>'job_location'"))} AS location, {O.null_if_na("value->>'job_board'")} AS source,
  value->>'job_url' AS job_url, {O.parse_salary("value->>'base_salary'")} AS salary_avg,
  {O.salary_ok("value->>'base_salary'")} AS salary_ok,
  {O.null_if_na(O.category("value->>'job_department'", t))} AS job_category,
  {O.null_if_na("value->>'job_level'")} AS experience_level, {O.work_setup("value->>'work_arrangement'")} AS work_setup,
  {O.null_if_na("value->>'job_type'")} AS job_type,
  {O.search_text(t, O.clean_text("value->>'desc'"))} AS search_text"""
    first = (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY value->>'job_url' ORDER BY pos) AS rn "
             f"FROM {lines} WHERE json_valid(value) AND json_type(value) = 'OBJECT' "
             f"AND NOT list_contains(json_keys(value), 'course_title') AND {KEYED_SQL}) WHERE rn = 1)")
    sal = "value->>'base_salary'"
    good = f"{O.null_if_na(t)} IS NOT NULL AND {O.salary_ok(sal)} AND {O.parse_salary(sal)} IS NOT NULL"
    return f"(SELECT {cols} FROM {first} WHERE {good})"


@register("daily_load_jobs", f"""SELECT job_title, company_name, location, source, job_url, salary_avg, job_category,
  experience_level, work_setup, job_type, TIMESTAMP '{LOAD_AS_OF}' AS scraped_at, TIMESTAMP '{LOAD_AS_OF}' AS last_seen,
  TRUE AS is_active, CAST(NULL AS TIMESTAMP) AS closed_at FROM {_load_job_sql()}""")
def _daily_load_jobs(spark, sf):
    from ..sources.snapshot import read_snapshot
    root = _load_events(spark, sf)
    return read_snapshot(spark, root, "job_vacancies").drop("job_id")


# Two days' landings that overlap: what only the first holds closes on the second, what both hold is refreshed, the rest is new.
LOAD_DAYS = [("2026-04-24 06:00:00", "value < 60"), (LOAD_AS_OF, "value >= 30")]
LOAD_DAY_SQL = [_load_job_sql(f"({O.landing_sql()} WHERE events.{where})") for _, where in LOAD_DAYS]
LOAD_STATE_SQL = (f"(SELECT *, TIMESTAMP '{LOAD_DAYS[0][0]}' AS scraped_at, TIMESTAMP '{LOAD_DAYS[0][0]}' AS last_seen, TRUE AS is_active, "
                  f"CAST(NULL AS TIMESTAMP) AS closed_at FROM {LOAD_DAY_SQL[0]})")


def _load_two_days(spark, sf):
    """The load onto a warehouse that holds the day before: the root of the warehouse after both."""
    from .load import bootstrap, load_lines
    root = scratch_path(spark, f"warehouse-{uuid.uuid4().hex}")
    bootstrap(spark, root)
    for as_of, where in LOAD_DAYS:
        load_lines(spark, A.landing_lines(spark, sf, where), root, as_of, f"day-{as_of[:10]}")
    return root


@register("daily_load_second_jobs", _close_sql(_g1_upsert_sql(LOAD_STATE_SQL, LOAD_DAY_SQL[1], LOAD_AS_OF), LOAD_AS_OF))
def _daily_load_second_jobs(spark, sf):
    from ..sources.snapshot import read_snapshot
    return read_snapshot(spark, _load_two_days(spark, sf), "job_vacancies").select(*JOB_OUT)


@register("daily_load_second_skills", " UNION ".join(
    f"SELECT j.job_url, kw.skill_name FROM {j} j, {O.keyword_values()} WHERE regexp_matches(j.search_text, kw.pat)" for j in LOAD_DAY_SQL))
def _daily_load_second_skills(spark, sf):
    """Pairs of the first day stay, those of the second are added."""
    from ..sources.snapshot import read_snapshot
    root = _load_two_days(spark, sf)
    jobs = read_snapshot(spark, root, "job_vacancies", ["job_id", "job_url"])
    return read_snapshot(spark, root, "job_skills").join(jobs, "job_id").select("job_url", "skill_name")


@register("daily_load_skills", f"""SELECT DISTINCT j.job_url, kw.skill_name FROM {_load_job_sql()} j, {O.keyword_values()}
WHERE regexp_matches(j.search_text, kw.pat)""")
def _daily_load_skills(spark, sf):
    from ..sources.snapshot import read_snapshot
    root = _load_events(spark, sf)
    jobs = read_snapshot(spark, root, "job_vacancies", ["job_id", "job_url"])
    return read_snapshot(spark, root, "job_skills").join(jobs, "job_id").select("job_url", "skill_name")


@register("daily_load_courses", f"SELECT course_title, platform, url, TIMESTAMP '{LOAD_AS_OF}' AS scraped_at FROM {_load_course_sql()}")
def _daily_load_courses(spark, sf):
    from ..sources.snapshot import read_snapshot
    return read_snapshot(spark, _load_events(spark, sf), "courses").drop("course_id")


@register("daily_load_course_skills", f"""SELECT DISTINCT c.url, kw.skill_name FROM {_load_course_sql()} c, {O.keyword_values()}
WHERE regexp_matches(c.search_text, kw.pat)""")
def _daily_load_course_skills(spark, sf):
    from ..sources.snapshot import read_snapshot
    root = _load_events(spark, sf)
    courses = read_snapshot(spark, root, "courses", ["course_id", "url"])
    return read_snapshot(spark, root, "course_skills").join(courses, "course_id").select("url", "skill_name")


@register("landing_round_trip", f"""SELECT pos, value->>'job_title' AS job_title, value->>'job_url' AS job_url,
  value->>'course_title' AS course_title, value->>'platform' AS platform, list_contains(json_keys(value), 'course_title') AS is_course
FROM {L_SQL} WHERE json_valid(value) AND json_type(value) = 'OBJECT'""")
def _landing_round_trip(spark, sf):
    """A6 then A1 and A2 on files: landed records are read back with their keys."""
    import uuid

    from ..session import scratch_path
    from ..sources.landing import LANDED, read_landing, write_landing
    records = parse_landing(A.landing_lines(spark, sf)).drop("file_path", "block_start")
    path = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    # the position rides along as a field of its own
    keyed = (records.withColumnRenamed("pos", "line_pos").withColumn("_keys", F.concat("_keys", F.array(F.lit("line_pos"))))
             .withColumn("landed_from", F.coalesce("job_board", "platform")))
    write_landing(keyed, path, source_col="landed_from")
    back = parse_landing(read_landing(spark, path, pattern=LANDED), schema=StructType([*RECORD.fields, StructField("line_pos", StringType())]))
    jobs, courses = route_records(back)
    cols = ["job_title", "job_url", "course_title", "platform"]
    return (jobs.withColumn("is_course", F.lit(False)).unionByName(courses.withColumn("is_course", F.lit(True)))
            .select(F.col("line_pos").cast("long").alias("pos"), *cols, "is_course"))


# ------------------------------------------------------------------ pages

for _name, (_fn, _sql) in P.catalog().items():
    register(_name, _sql)(_fn)

for _name, (_fn, _sql) in normalise_catalog().items():
    register(_name, _sql)(_fn)
