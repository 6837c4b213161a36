"""DuckDB twins of the normaliser queries.

The Spark side renders orders as payloads and parses them back; these SQL
texts compute the expected records straight from the orders join, so a
match shows that every field survived rendering, parsing and the source
rules.  Only the external checker runs them.
"""

from __future__ import annotations

from ...plans import oracle as O
from ...plans.adapters import TITLES

NOW = "2026-04-29 06:00:00"
FIELDS = ["job_title", "job_location", "job_department", "job_url", "first_seen", "base_salary", "job_type",
          "job_level", "job_apply_end_date", "last_seen", "is_active", "company", "company_url", "job_board",
          "job_board_url", "job_age", "work_arrangement", "desc"]
COURSE = ["course_title", "desc", "level", "platform", "url", "scraped_at", "job_age", "duration", "rating", "students"]

_TITLE = "CASE o_orderkey % 8 " + " ".join(f"WHEN {i} THEN {O.q(t)}" for i, t in enumerate(TITLES[:-1])) \
    + f" ELSE {O.q(TITLES[-1])} END"

ORD = f"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  c_custkey, c_name, c_mktsegment, n_name, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
  strftime(o_orderdate, {O.TS_FMT}) AS txt, CAST(floor(o_orderkey / 20) AS BIGINT) AS seq,
  CAST(row_number() OVER (PARTITION BY floor(o_orderkey / 20) ORDER BY o_orderkey) - 1 AS INTEGER) AS item_pos,
  {_TITLE} AS title, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS salary
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


#: What a title of the page fixtures begins with, decoded.
LEAD = "CASE WHEN o_orderkey % 4 = 0 THEN 'R&D – équipe ' ELSE '' END"


def end_date(x: str) -> str:
    return f"coalesce(strftime(try_strptime({x}, '%Y-%m-%d %H:%M:%S') + INTERVAL 30 DAY, {O.TS_FMT}), 'N/A')"


def age(first: str, last: str) -> str:
    a = f"try_strptime({first}, '%Y-%m-%d %H:%M:%S')"
    b = f"try_strptime({last}, '%Y-%m-%d %H:%M:%S')"
    dd = f"floor(abs(epoch({b}) - epoch({a})) / 86400)"
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN 'unknown' WHEN {dd} <= 1 THEN 'new' WHEN {dd} <= 7 THEN 'hot' "
            f"WHEN {dd} <= 15 THEN 'recent' WHEN {dd} <= 21 THEN 'aging' WHEN {dd} <= 30 THEN 'old' ELSE 'expired' END)")


def record_sql(source: str, f: dict, where: str = "", src: str = ORD, pos: str = "item_pos") -> str:
    last = f.get("last_seen", f"'{NOW}'")
    vals = {"first_seen": f"'{NOW}'", "base_salary": "'0'", "job_level": "'N/A'", "is_active": "'True'",
            "last_seen": last, "job_apply_end_date": end_date(last), "job_age": age(f"'{NOW}'", last)}
    vals.update(f)
    cols = ", ".join(f"CAST({vals.get(n, 'NULL')} AS VARCHAR) AS \"{n}\"" for n in FIELDS)
    return f"SELECT '{source}' AS source, seq, {pos} AS item_pos, {cols} FROM {src} {where}"


def dealls() -> str:
    return record_sql("dealls", {
        "job_title": O.collapse_ws("title", dash_commas=True),
        "job_location": "lower(n_name) || ', Indonesia'",
        "job_department": "CASE WHEN o_orderkey % 3 = 0 THEN "
                          + O.title("replace(lower(c_mktsegment) || '-team', '-', ' ')") + " ELSE 'N/A' END",
        "job_url": "'https://dealls.com/role/job-' || CAST(o_orderkey AS VARCHAR)",
        "base_salary": "CASE WHEN salary = '0' THEN '0' ELSE salary END",
        "job_type": "'Full-time, Contract'",
        "job_level": "CASE o_orderkey % 8 WHEN 7 THEN 'Postgraduate' WHEN 6 THEN 'Graduate' WHEN 5 THEN 'Undergraduate' ELSE 'Junior/Mid-Level' END",
        "last_seen": "txt",
        "is_active": "CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END",
        "company": "c_name", "company_url": "'https://dealls.com/company/' || CAST(c_custkey AS VARCHAR)",
        "job_board": "'Dealls'", "job_board_url": "'https://dealls.com/'",
        "work_arrangement": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Remote' WHEN '2-HIGH' THEN 'Hybrid' ELSE 'On-site' END",
        "desc": "title || ' ' || c_mktsegment",
    })


def kalibrr() -> str:
    return record_sql("kalibrr", {
        "job_title": O.collapse_ws("title"),
        "job_location": "lower(n_name) || ', Jawa'",
        "job_department": "c_mktsegment",
        "job_url": "'https://www.kalibrr.com/c/' || CAST(c_custkey AS VARCHAR) || '/jobs/' || CAST(o_orderkey AS VARCHAR)",
        "base_salary": "CASE WHEN o_orderkey % 2 = 0 AND salary <> '0' THEN salary ELSE '0' END",
        "job_type": "'Full time'",
        "job_level": "CASE o_orderkey % 4 WHEN 0 THEN 'High School' WHEN 1 THEN 'Bachelor' WHEN 2 THEN 'Master' ELSE 'Junior/Mid-Level' END",
        "last_seen": "txt", "job_apply_end_date": "txt",
        "company": "c_name", "company_url": "'https://www.kalibrr.com/c/' || CAST(c_custkey AS VARCHAR)",
        "job_board": "'Kalibrr'", "job_board_url": "'https://www.kalibrr.com/'",
        "work_arrangement": "CASE WHEN o_orderkey % 5 = 0 THEN 'Remote' WHEN o_orderkey % 3 = 0 THEN 'Hybrid' ELSE 'On-site' END",
        "desc": "title || ' ' || c_mktsegment || ' Use  SQL Python'",
    })


def karir() -> str:
    company = "c_name || ', Tbk'"
    return record_sql("karir", {
        "job_title": O.comma_to_dash("title"),
        "job_location": O.comma_to_dash("lower(n_name)"),
        "job_department": "c_mktsegment || ' - IT'",
        "job_url": "'https://karir.com/opportunities/' || CAST(o_orderkey AS VARCHAR)",
        "base_salary": "CASE WHEN salary = '0' THEN '0' ELSE salary END",
        "job_type": "'Full-time'", "job_level": "'Staff'",
        "last_seen": "iso || 'Z'",
        "job_apply_end_date": "CASE WHEN o_orderkey % 2 = 0 THEN txt ELSE '' END",
        "company": O.comma_to_dash(company),
        "job_board": "'Karir.com'", "job_board_url": "'https://karir.com/'",
        "work_arrangement": "'On-site'",
        "desc": f"title || ' ' || c_mktsegment || ' IT ' || {company}",
    })


def greenhouse(flip: bool = True) -> str:
    title = O.collapse_ws("title")
    if flip:
        return record_sql("greenhouse", {
            "job_title": title, "job_location": O.collapse_ws("lower(n_name)"),
            "job_department": O.collapse_ws("c_mktsegment"),
            "job_url": "CASE WHEN o_orderkey % 2 = 0 THEN 'https://boards.example/j/' ELSE 'https://boards.greenhouse.io/flip/jobs/' END || CAST(o_orderkey AS VARCHAR)",
            "job_type": "'Full-time'", "last_seen": "txt", "company": "'Flip'", "job_board": "'Flip Careers'",
            "work_arrangement": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Remote' WHEN '2-HIGH' THEN 'Hybrid' ELSE 'On-site' END",
            "desc": f"{title} || ' ' || c_mktsegment || ' ' || CASE o_orderpriority WHEN '1-URGENT' THEN 'Fully remote team' WHEN '2-HIGH' THEN 'Hybrid office' ELSE 'Office' END || repeat(' lorem ipsum', 30) || ' Python'",
        })
    return record_sql("greenhouse", {
        "job_title": title, "job_location": O.collapse_ws("lower(n_name)"),
        "job_department": O.collapse_ws("c_mktsegment"),
        "job_url": "CASE WHEN o_orderkey % 2 = 0 THEN 'https://boards.example/j/' || CAST(o_orderkey AS VARCHAR) ELSE '' END",
        "job_type": "'Full-time'", "company": "'Vidio'", "job_board": "'Vidio Careers'",
        "work_arrangement": "'On-site'", "desc": f"{title} || ' ' || c_mktsegment",
    })


def lever() -> str:
    loc = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Remote' WHEN '2-HIGH' THEN 'Jakarta (Hybrid)' ELSE 'Jakarta' END"
    return record_sql("lever", {
        "job_title": O.collapse_ws("title"), "job_location": loc, "job_department": "c_mktsegment",
        "job_url": "'https://jobs.lever.example/' || CAST(o_orderkey AS VARCHAR)", "job_type": "'Full-time'",
        "last_seen": "txt", "company": "'Mekari'", "job_board": "'Mekari Careers'",
        "work_arrangement": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Remote' WHEN '2-HIGH' THEN 'Hybrid' ELSE 'On-site' END",
        "desc": f"{O.collapse_ws('title')} || ' ' || c_mktsegment || ' Full-time ' || c_mktsegment",
    })


def jibe() -> str:
    return record_sql("jibe", {
        "job_title": "title", "job_location": "lower(n_name)", "job_department": "c_mktsegment",
        "job_url": "'https://careers.softwareone.com/en/jobs/' || CAST(o_orderkey AS VARCHAR)",
        "job_type": "'Full time'", "last_seen": "txt", "company": "c_name",
        "job_board": "'SoftwareOne Careers'",
        "work_arrangement": "CASE o_orderkey % 3 WHEN 0 THEN 'Remote' WHEN 1 THEN 'Hybrid' ELSE 'On-site' END",
        "desc": "title || ' ' || c_mktsegment || CASE o_orderkey % 3 WHEN 0 THEN ' Remote friendly' WHEN 1 THEN ' Hybrid desk' ELSE ' Office' END || ' SQL'",
    })


def koltiva() -> str:
    return record_sql("koltiva", {
        "job_title": O.comma_to_dash("lower(title)", title_case=True, blank_default="N/A"),
        "job_location": O.comma_to_dash("n_name", blank_default="N/A") + " || ' - Indonesia'",
        "job_department": O.comma_to_dash("c_mktsegment", blank_default="N/A"),
        "job_url": "'https://career.koltiva.com/list-job/job-' || CAST(o_orderkey AS VARCHAR)",
        "job_type": "'Full-time'", "job_level": "'Staff'",
        "job_apply_end_date": "strftime(o_orderdate, '%Y-%m-%d')",
        "company": "'Koltiva'", "job_board": "'Koltiva Careers'",
        "work_arrangement": "CASE WHEN o_orderkey % 4 = 0 THEN 'Remote' ELSE 'On-site' END",
        "desc": "lower(title) || ' ' || c_mktsegment || ' ' || CASE WHEN o_orderkey % 4 = 0 THEN 'Work-from-home, laptop' ELSE 'laptop' END",
    })


def ld_json() -> str:
    return record_sql("jobstreet", {
        "job_title": O.clean_string("title"), "job_location": O.clean_string("lower(n_name)"),
        "job_department": "'N/A'", "job_url": "'https://id.jobstreet.example/job/' || CAST(o_orderkey AS VARCHAR)",
        "job_type": "'Full time'", "last_seen": "txt", "job_apply_end_date": "txt",
        "company": O.clean_string("c_name"), "job_board": "'Jobstreet'", "job_board_url": "'https://id.jobstreet.com'",
        "work_arrangement": "'On-site'", "desc": "'SQL' || repeat(' lorem ipsum', 30) || ' Python'",
    }, where="WHERE o_orderkey % 9 <> 0", pos="0 AS block_pos, item_pos")


def next_data() -> str:
    title = O.clean_string("title")
    dept = "CASE WHEN o_orderkey % 3 = 2 THEN lower(c_mktsegment) ELSE c_mktsegment END"
    return record_sql("jobstreet", {
        "job_title": title, "job_location": O.clean_string("lower(n_name)"),
        "job_department": O.clean_string(f"({dept})"),
        "job_url": "'https://id.jobstreet.com/job/' || CAST(o_orderkey AS VARCHAR)",
        "job_type": "'Full-time'", "last_seen": "txt", "job_apply_end_date": f"'{NOW}'",
        "company": O.clean_string("c_name"), "job_board": "'Jobstreet'", "job_board_url": "'https://id.jobstreet.com'",
        "work_arrangement": "'On-site'", "desc": f"{title} || ' ' || ({dept})",
    })


def job_cards() -> str:
    t = "trim(regexp_replace(title, '<[^>]+>', ' ', 'g'))"
    t = f"regexp_replace({t}, '\\s+', ' ', 'g')"
    return record_sql("mekari", {
        "job_title": t, "job_location": "'Indonesia'", "job_department": "'N/A'",
        "job_url": "'https://careers.example/o/' || CAST(o_orderkey AS VARCHAR)", "job_type": "'Full-time'",
        "company": "'Mekari'", "job_board": "'Mekari Careers'", "work_arrangement": "'On-site'",
        "desc": f"{t} || ' N/A'",
    })


def apollo() -> str:
    name = "CASE o_orderkey % 3 WHEN 0 THEN 'Python for Data' WHEN 1 THEN 'SQL Basics' ELSE 'Excel' END"
    cols = {"course_title": name, "desc": "CASE WHEN o_orderkey % 2 = 0 THEN 'Python, SQL' ELSE 'Learn fast' END",
            "platform": "'Coursera'", "url": "'https://www.coursera.org/learn/c' || CAST(o_orderkey AS VARCHAR)",
            "scraped_at": f"'{NOW}'", "job_age": "'unknown'"}
    sel = ", ".join(f"CAST({cols.get(n, 'NULL')} AS VARCHAR) AS \"{n}\"" for n in COURSE)
    return f"SELECT 'coursera' AS source, seq, {sel} FROM {ORD}"


def course_cards() -> str:
    first = (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey % 500 ORDER BY seq, item_pos) AS rn "
             f"FROM {ORD}) WHERE rn = 1)")
    cols = {"course_title": f"trim({LEAD} || regexp_replace(title, '<.*$', ''))", "desc": "'Belajar & kerja'", "level": "'Pemula'",
            "duration": "'N/A'", "rating": "'N/A'", "students": "'N/A'", "platform": "'Dicoding'",
            "url": "'https://www.dicoding.com/academies/' || CAST(o_orderkey % 500 AS VARCHAR)",
            "scraped_at": f"'{NOW}'", "job_age": "'unknown'"}
    sel = ", ".join(f"CAST({cols.get(n, 'NULL')} AS VARCHAR) AS \"{n}\"" for n in COURSE)
    return f"SELECT 'dicoding' AS source, seq, CAST(item_pos * 2 AS INTEGER) AS item_pos, {sel} FROM {first}"


def board_sizes() -> str:
    return f"SELECT seq, CAST(count(*) AS INTEGER) AS n_postings FROM {ORD} GROUP BY seq"


def read_payloads() -> str:
    return f"SELECT 'lever' AS source, 'lever' AS kind, seq, CAST(count(*) AS INTEGER) AS n_items FROM {ORD} GROUP BY seq"


def extract_ld_json() -> str:
    return f"SELECT seq AS page_id, 0 AS block_pos, CAST(count(*) AS INTEGER) AS n_items, list(title ORDER BY item_pos) AS titles FROM {ORD} GROUP BY seq"


def ld_json_type_census() -> str:
    return f"SELECT 'JobPosting' AS ld_type, count(*) AS n_items FROM {ORD}"


def next_data_keys() -> str:
    n = "CAST(count(*) AS INTEGER)"
    return (f"SELECT seq AS page_id, 'initialCandidateExperimentalData' AS key, FALSE AS job_like, CAST(NULL AS INTEGER) AS n_items FROM {ORD} WHERE seq % 3 = 0 GROUP BY seq "
            f"UNION ALL SELECT seq, 'jobs', TRUE, {n} FROM {ORD} WHERE seq % 3 = 1 GROUP BY seq "
            f"UNION ALL SELECT seq, 'jobs', FALSE, 0 FROM {ORD} WHERE seq % 3 = 2 GROUP BY seq "
            f"UNION ALL SELECT seq, 'searchResults', FALSE, CAST(NULL AS INTEGER) FROM {ORD} WHERE seq % 3 = 2 GROUP BY seq")


def vidio_cards() -> str:
    raw = f"({LEAD} || regexp_replace(title, '<.*$', ''))"
    return record_sql("vidio", {
        "job_title": O.ws(raw), "job_location": "lower(n_name)", "job_department": "c_mktsegment",
        "job_url": "'https://www.vidio.com/careers/' || CAST(o_orderkey AS VARCHAR)", "job_type": "'Full-time'",
        "company": "'Vidio'", "company_url": "'https://www.vidio.com'", "job_board": "'Vidio Careers'",
        "work_arrangement": "'On-site'", "desc": f"{raw} || ' ' || c_mktsegment",
    }, where=f"WHERE {raw} <> 'N/A'")


def trakstar_cards() -> str:
    raw = f"({LEAD} || regexp_replace(title, '<.*$', ''))"
    return record_sql("mekari", {
        "job_title": O.ws(raw), "job_location": "lower(n_name)", "job_department": "c_mktsegment",
        "job_url": "'https://mekari.hire.trakstar.com/jobs/' || CAST(o_orderkey AS VARCHAR)", "job_type": "'Full-time'",
        "company": "'Mekari'", "job_board": "'Mekari Careers'",
        "work_arrangement": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Remote' ELSE 'On-site' END",
        "desc": f"{raw} || ' ' || c_mktsegment || ' Full-time'",
    })


def search_cards() -> str:
    name = f"{LEAD} || regexp_replace(title, '<[^>]*>', ' ', 'g')"
    t = O.clean_string(f"({name})")
    company = ("CASE o_orderkey % 3 WHEN 0 THEN " + O.clean_string("c_name") + " WHEN 1 THEN " + O.clean_string("lower(c_name)")
               + " ELSE 'Private Advertiser' END")
    return record_sql("jobstreet", {
        "job_title": t, "job_location": "CASE WHEN o_orderkey % 2 = 0 THEN " + O.clean_string("lower(n_name)") + " ELSE 'Indonesia' END",
        "job_department": "'N/A'", "job_url": "'https://id.jobstreet.com/id/job/' || CAST(o_orderkey AS VARCHAR)",
        "base_salary": "CASE WHEN o_orderkey % 4 = 0 THEN 'Rp ' || salary ELSE '0' END", "job_type": "'Full-time'",
        "job_apply_end_date": f"'{NOW}'", "company": f"({company})", "job_board": "'Jobstreet'",
        "job_board_url": "'https://id.jobstreet.com'", "job_age": "'0'", "work_arrangement": "'On-site'",
        "desc": f"{t} || ' ' || ({company})",
    }, where="WHERE o_orderkey % 5 <> 0")


PAGE_KEYS = f"(SELECT DISTINCT seq, 0 AS item_pos FROM {ORD})"


def title_pages() -> str:
    n = "CAST(seq AS VARCHAR)"
    return record_sql("techinasia", {
        "job_title": f"CASE seq % 3 WHEN 0 THEN 'R&D Engineer ' || {n} WHEN 1 THEN 'Role ' || {n} ELSE 'N/A' END",
        "job_location": "'N/A'", "job_department": "'N/A'", "job_url": f"'https://site.example/p/' || {n}", "job_type": "'N/A'",
        "company": f"CASE seq % 3 WHEN 0 THEN 'A&B Firm ' || {n} ELSE 'N/A' END", "company_url": "''", "job_board": "'Tech in Asia Jobs'",
        "job_board_url": "'https://www.techinasia.com/jobs'", "job_age": "'0'", "work_arrangement": "'N/A'",
        "desc": f"'About team ' || {n} || ' Use SQL < 3' || coalesce(' ' || spans, '')",
    }, src=f"(SELECT seq, 0 AS item_pos, {SPANS} AS spans FROM {ORD} GROUP BY seq)")


# texts of the cards' spans, in page order: job links of two kinds, and companies
SPANS = ("nullif(array_to_string(flatten(list(list_filter([CASE WHEN o_orderkey % 5 >= 3 THEN "
         + O.strip(f"({LEAD} || regexp_replace(title, '<[^>]*>', ' ', 'g'))") + " END, CASE WHEN o_orderkey % 3 = 1 THEN lower(c_name) END], "
         "lambda x: x IS NOT NULL) ORDER BY item_pos)), ' '), '')")


def has_next_data_rendered() -> str:
    return f"SELECT seq AS page_id, seq % 4 = 0 AS has_next_data FROM {PAGE_KEYS}"


def detect_ats_rendered() -> str:
    return (f"SELECT seq AS page_id, CASE seq % 3 WHEN 0 THEN ['greenhouse', 'lever'] WHEN 1 THEN ['recruitee'] "
            f"ELSE CAST([] AS VARCHAR[]) END AS vendors FROM {PAGE_KEYS}")


def harvest_titles_rendered() -> str:
    return (f"SELECT seq AS page_id, CASE WHEN seq % 4 = 0 THEN ['Posting number ' || CAST(seq AS VARCHAR)] ELSE CAST([] AS VARCHAR[]) END AS titles, "
            f"seq % 4 = 0 AS has___NEXT_DATA__, seq % 3 = 0 AS has_lever_co FROM {PAGE_KEYS}")


HREFS = (f"(SELECT seq AS page_id, item_pos, CASE o_orderkey % 5 WHEN 0 THEN '/jobs/search/' WHEN 1 THEN 'https://x.example/jobs/' "
         f"WHEN 2 THEN '/academies/' ELSE '/jobs/' END || CAST(o_orderkey % 700 AS VARCHAR) || '?a=1&b=A' AS href FROM {ORD})")


def filter_links_rendered() -> str:
    return (f"SELECT DISTINCT CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://www.techinasia.com' || href END AS link "
            f"FROM {HREFS} WHERE contains(href, '/jobs/') AND NOT contains(href, 'search')")


def filter_url_pattern_rendered() -> str:
    return (f"SELECT 'https://www.dicoding.com' || href AS link, page_id, item_pos FROM {HREFS} WHERE regexp_matches(href, '/academies/\\d+') "
            "QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, item_pos) = 1")


def link_harvest_rendered() -> str:
    return (f"SELECT page_id, CAST(len(l) AS INTEGER) AS n_links, l[1:3] AS samples FROM (SELECT page_id, "
            f"coalesce(list(href ORDER BY item_pos) FILTER (WHERE contains(href, '/jobs/')), CAST([] AS VARCHAR[])) AS l FROM {HREFS} GROUP BY page_id)")


def filter_json_type() -> str:
    return f"SELECT seq AS page_id, item_pos FROM {ORD}"


SQL = {
    "filter_links_rendered": filter_links_rendered, "filter_url_pattern_rendered": filter_url_pattern_rendered,
    "link_harvest_rendered": link_harvest_rendered,
    "normalise_search_cards": search_cards, "normalise_title_page": title_pages,
    "has_next_data_rendered": has_next_data_rendered, "detect_ats_rendered": detect_ats_rendered,
    "harvest_titles_rendered": harvest_titles_rendered,
    "filter_json_type": filter_json_type, "normalise_vidio_cards": vidio_cards, "normalise_trakstar_cards": trakstar_cards,
    "normalise_dealls": dealls, "normalise_kalibrr": kalibrr, "normalise_karir": karir,
    "normalise_greenhouse_flip": lambda: greenhouse(True), "normalise_greenhouse_vidio": lambda: greenhouse(False),
    "normalise_lever": lever, "normalise_jibe": jibe, "normalise_koltiva": koltiva,
    "normalise_ld_json": ld_json, "normalise_next_data": next_data, "normalise_apollo": apollo,
    "normalise_course_cards": course_cards, "normalise_job_cards": job_cards, "board_sizes": board_sizes,
    "read_payloads": read_payloads, "extract_ld_json": extract_ld_json, "ld_json_type_census": ld_json_type_census, "next_data_keys": next_data_keys,
}
