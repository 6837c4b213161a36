"""DuckDB SQL twins of the adapters and column rules, for the correctness gate.

These strings are only run by the external checker (DuckDB) against the same
parquet tables; Spark never executes them.  Each helper returns an SQL
expression with the semantics of the matching Column function, restricted to
the ASCII inputs the adapters produce (RE2 ``\\s``/``\\b`` are ASCII).
"""

from __future__ import annotations

from ..functions.classify import (CATEGORY_DEFAULT, CATEGORY_RULES, LOCATION_RULES,
                                  WORK_SETUP_RULES, WORK_SETUP_UNKNOWN)
from ..schemas import SKILL_KEYWORDS
from .adapters import COURSE_DESCS, COURSE_TITLES, PRIORITY_SETUP, SETUP_DEFAULT, TITLES

TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def falsy(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), "
            f"lambda s: upper(s[1]) || lower(s[2:])), '')")


def capitalize(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def clean_string(x: str) -> str:
    body = ws(f"replace(replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), chr(10), ' '), chr(13), '')")
    return f"(CASE WHEN {falsy(x)} THEN 'N/A' ELSE coalesce(nullif({body}, ''), 'N/A') END)"


def strip_html(x: str) -> str:
    return f"(CASE WHEN {falsy(x)} THEN '' ELSE {strip(f'regexp_replace({x}, {q("<[^>]+>")}, {q(" ")}, {q("g")})')} END)"


def collapse_ws(x: str, default: str = "N/A", dash_commas: bool = False) -> str:
    body = f"replace({x}, ', ', ' - ')" if dash_commas else x
    return f"(CASE WHEN {falsy(x)} THEN {q(default)} ELSE {ws(body)} END)"


def comma_to_dash(x: str, null_default: str = "N/A", title_case: bool = False,
                  drop_word: str | None = None, blank_default: str | None = None) -> str:
    body = f"replace({strip(x)}, ',', ' -')"
    if title_case:
        body = title(body)
    elif drop_word:
        body = strip(f"replace({body}, {q(drop_word)}, '')")
    body = ws(body)
    if blank_default is not None:
        body = f"coalesce(nullif({body}, ''), {q(blank_default)})"
    return f"(CASE WHEN {x} IS NULL THEN {q(null_default)} ELSE {body} END)"


def clean_text(x: str) -> str:
    return f"(CASE WHEN {falsy(x)} THEN 'N/A' ELSE {ws(f'regexp_replace({x}, {q("<[^>]+>")}, {q("")}, {q("g")})')} END)"


def null_if_na(x: str) -> str:
    return f"(CASE WHEN {x} = '' OR upper({strip(x)}) = 'N/A' THEN NULL ELSE {x} END)"


FLOAT_RE2 = (r"^\s*[+-]?(?:(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.(?:\d(?:_?\d)*))"
             r"(?:[eE][+-]?\d(?:_?\d)*)?|(?i:nan|inf|infinity))\s*$")


def salary_ok(x: str) -> str:
    return f"({falsy(x)} OR regexp_full_match({x}, {q(FLOAT_RE2)}))"


def parse_salary(x: str) -> str:
    num = f"TRY_CAST(TRY_CAST(replace({strip(x)}, '_', '') AS DOUBLE) AS DECIMAL(15,2))"
    return (f"(CASE WHEN {falsy(x)} THEN CAST(0 AS DECIMAL(15,2)) "
            f"WHEN regexp_full_match({x}, {q(FLOAT_RE2)}) THEN {num} ELSE NULL END)")


def _contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def location(x: str) -> str:
    parts = [f"WHEN {falsy(x)} THEN NULL"]
    parts += [f"WHEN contains(lower({x}), {q(w)}) THEN {q(label)}" for w, label in LOCATION_RULES]
    return f"(CASE {' '.join(parts)} ELSE {title(x)} END)"


def category(dept: str, title_col: str) -> str:
    low = f"lower(coalesce({title_col}, 'None'))"
    parts = [f"WHEN NOT {falsy(dept)} AND upper({dept}) <> 'N/A' THEN {dept}"]
    parts += [f"WHEN {_contains_any(low, words)} THEN {q(label)}" for words, label in CATEGORY_RULES]
    return f"(CASE {' '.join(parts)} ELSE {q(CATEGORY_DEFAULT)} END)"


def work_setup(x: str) -> str:
    parts = [f"WHEN {falsy(x)} OR upper({strip(x)}) = 'N/A' THEN {q(WORK_SETUP_UNKNOWN)}"]
    parts += [f"WHEN {_contains_any(f'lower({x})', words)} THEN {q(label)}" for words, label in WORK_SETUP_RULES]
    return f"(CASE {' '.join(parts)} ELSE {title(x)} END)"


def search_text(t: str, d: str) -> str:
    return f"lower(coalesce({t}, 'None') || ' ' || coalesce({d}, 'None'))"


def keyword_values(keywords=SKILL_KEYWORDS) -> str:
    return "(VALUES " + ", ".join(f"({q(k)}, {q(chr(92) + 'b' + chr(92) + 'Q' + k.lower() + chr(92) + 'E' + chr(92) + 'b')})"
                                  for k in keywords) + ") AS kw(skill_name, pat)"


def unicode_keyword_values(keywords) -> str:
    """Word boundaries spelled with Unicode classes (RE2's ``\\b`` is ASCII-only)."""
    nw = r"[^\p{L}\p{N}_]"
    return "(VALUES " + ", ".join(
        f"({q(k)}, {q('(^|' + nw + ')' + chr(92) + 'Q' + k.lower() + chr(92) + 'E(' + nw + '|$)')})"
        for k in keywords) + ") AS kw(skill_name, pat)"


def _case_sql(x: str, mapping, default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {k} THEN {v}" for k, v in mapping) + f" ELSE {default} END"


def postings_sql(url_by: str = "order") -> str:
    if url_by == "customer":
        url = "'https://jobs.example/c/' || CAST(o_custkey AS STRING)"
    else:
        url = ("'https://jobs.example/' || CAST(o_orderkey - CASE WHEN o_orderkey % 10 = 0 AND "
               "o_orderkey > 0 THEN 1 ELSE 0 END AS STRING)")
    titles = _case_sql("o_orderkey % 8", [(i, q(t)) for i, t in enumerate(TITLES[:-1])], q(TITLES[-1]))
    setups = _case_sql("o_orderpriority", [(q(k), q(v)) for k, v in PRIORITY_SETUP], q(SETUP_DEFAULT))
    return f"""SELECT o_orderkey AS pos, {url} AS job_url,
  {titles} AS job_title,
  c_name AS company,
  CASE o_custkey % 6 WHEN 0 THEN 'Jakarta Selatan' WHEN 1 THEN 'kota bandung' WHEN 2 THEN 'N/A'
    WHEN 3 THEN '' WHEN 4 THEN 'west-java d.k.i' ELSE lower(n_name) END AS job_location,
  CASE o_orderkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'N/A' ELSE NULL END AS job_department,
  {setups} AS work_arrangement,
  CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'Rp 5.000.000' WHEN 2 THEN ''
    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS base_salary,
  o_orderstatus AS job_board, o_orderdate AS seen_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def courses_sql() -> str:
    titles = _case_sql("p_partkey % 6", [(i, q(t)) for i, t in enumerate(COURSE_TITLES[:-1])], q(COURSE_TITLES[-1]))
    descs = _case_sql("p_partkey % 5", [(i, q(d) if d is not None else "p_name")
                                        for i, d in enumerate(COURSE_DESCS[:-1])], q(COURSE_DESCS[-1]))
    return f"""SELECT p_partkey AS pos, {titles} || ' #' || CAST(p_size AS STRING) AS course_title,
  {descs} AS "desc", p_type AS level, p_brand AS platform,
  'https://courses.example/' || CAST(p_partkey - CASE WHEN p_partkey % 7 = 0 AND p_partkey > 0 THEN 1 ELSE 0 END AS STRING) AS url,
  p_size AS size
FROM part"""


def landing_sql() -> str:
    uid = "CAST(user_id AS STRING)"
    job = ("'{\"job_title\": \"' || event_type || ' analyst <b>SQL</b>\", \"job_url\": \"' || "
           "CASE WHEN event_id % 50 = 0 THEN '' ELSE 'https://jobs.example/e/' || CAST(event_id % 5000 AS STRING) END || "
           "'\", \"job_board\": \"' || upper(event_type) || "
           "'\", \"base_salary\": \"' || CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) || "
           "'\", \"job_location\": \"Jakarta\"}'")
    course = (f"'{{\"course_title\": ' || CASE WHEN user_id % 10 = 0 THEN 'null' ELSE '\"Course ' || {uid} || '\"' END || "
              f"', \"platform\": \"P' || CAST(user_id % 3 AS STRING) || '\", \"url\": \"https://courses.example/u/' || "
              f"{uid} || '\", \"desc\": \"Python and Excel\"}}'")
    return f"""SELECT 'events' AS file_path, CAST(0 AS BIGINT) AS block_start, event_id AS pos,
  CASE WHEN event_type = 'error' THEN '{{"job_title": "broken ' || {uid}
       WHEN event_type = 'view' THEN '["' || {uid} || '"]'
       WHEN event_type = 'signup' THEN {course}
       ELSE {job} END AS value
FROM events"""


def classified_sql(src: str) -> str:
    """Warehouse projection of posting rows (C5, C7-C11, C8) as a SELECT over ``src``."""
    t = clean_text("job_title")
    return f"""SELECT pos, seen_at,
  {null_if_na(t)} AS job_title,
  {null_if_na('company')} AS company_name,
  {null_if_na(location('job_location'))} AS location,
  {null_if_na('job_board')} AS source,
  coalesce(job_url, '') AS job_url,
  {parse_salary('base_salary')} AS salary_avg,
  {salary_ok('base_salary')} AS salary_ok,
  {null_if_na(category('job_department', t))} AS job_category,
  CAST(NULL AS VARCHAR) AS experience_level,
  {work_setup('work_arrangement')} AS work_setup,
  CAST(NULL AS VARCHAR) AS job_type,
  {search_text(t, clean_text('job_department'))} AS search_text
FROM {src}"""


BATCH_COLS = ["job_title", "company_name", "location", "source", "job_url", "salary_avg",
              "job_category", "experience_level", "work_setup", "job_type"]


def closed_form_sql(src: str, as_of: str, days: int = 3) -> str:
    """State after daily runs up to ``as_of`` over classified sightings ``src``."""
    cols = ", ".join(c for c in BATCH_COLS if c != "job_url")
    first = ", ".join(f"f.{c}" if c not in ("job_title", "salary_avg", "work_setup") else f"l.{c}"
                      for c in BATCH_COLS if c != "job_url")
    end = f"CAST(TIMESTAMP {q(as_of)} AS DATE)"
    return f"""(WITH s AS (SELECT *, CAST(seen_at AS DATE) AS d FROM {src}),
  pd AS (SELECT job_url, d, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY job_url, d ORDER BY pos) AS rn FROM s) WHERE rn = 1),
  g AS (SELECT *, lead(d) OVER (PARTITION BY job_url ORDER BY d) AS nxt FROM pd),
  k AS (SELECT job_url, min(d) AS d0, max(d) AS d1,
          max(CASE WHEN coalesce(nxt, {end} + 1) > d + {days + 1} AND d + {days + 1} <= {end} THEN d + {days + 1} END) AS closed
        FROM g GROUP BY job_url)
SELECT f.job_url AS job_url, {first.replace('f.job_title', 'l.job_title')},
  CAST(k.d0 AS TIMESTAMP) AS scraped_at, CAST(k.d1 AS TIMESTAMP) AS last_seen,
  k.d1 >= {end} - {days} AS is_active, CAST(k.closed AS TIMESTAMP) AS closed_at
FROM k JOIN pd f ON f.job_url = k.job_url AND f.d = k.d0 JOIN pd l ON l.job_url = k.job_url AND l.d = k.d1)"""
