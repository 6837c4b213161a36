"""Landing files through the daily load."""

import json
import re

from pyspark.sql import functions as F

from jobsight.operators import skills as S
from jobsight.plans import insights as I
from jobsight.plans.load import bootstrap, daily_load
from jobsight.schemas import SKILL_KEYWORDS
from jobsight.sources.landing import LANDED, parse_landing, read_landing, route_records, union_sources, write_landing
from jobsight.sources.snapshot import current_manifest, read_snapshot


def job(url, title, **kw):
    rec = {"job_title": title, "job_url": url, "company": "Co", "job_location": "Jakarta Barat",
           "job_board": "Board", "base_salary": "0", "work_arrangement": "Hybrid", "desc": "We use Python and SQL"}
    rec.update(kw)
    return json.dumps(rec)


def write(path, name, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_read_parse_route(spark, tmp_path):
    land = tmp_path / "landing"
    write(land, "a_output.jl", [job("u1", "Data Engineer"), "not json", "[1, 2]", job("u1", "dup"),
                                json.dumps({"course_title": None, "platform": "P", "url": "c1"})])
    write(land, "b_output.jl", [job("u2", "Backend Developer")])
    (land / "ignore.txt").write_text("x\n")
    lines = read_landing(spark, str(land))
    recs = parse_landing(lines)
    jobs, courses = route_records(recs)
    assert lines.count() == 6 and recs.count() == 4
    assert jobs.count() == 3 and courses.count() == 1
    assert union_sources([jobs.select("job_url"), courses.select("url")]).count() == 4


def test_daily_load_end_to_end(spark, tmp_path):
    root = str(tmp_path / "wh")
    bootstrap(spark, root)
    land = tmp_path / "day1"
    write(land, "x_output.jl", [job("u1", "Data  Engineer <b>Python</b>"), job("u2", "N/A"),
                                job("u3", "Sales", base_salary="Rp 5.000.000"), job("u1", "Later dup"),
                                json.dumps({"course_title": "Intro <i>SQL</i>", "platform": "P", "url": "c1", "desc": "Excel"})])
    out = daily_load(spark, str(land), root, "2026-04-01 06:00:00", "r1")
    rejects = {r.job_url: r.reject_reason for r in out["_rejects"].collect()}
    assert rejects == {"u2": "job_title_null", "u3": "salary_not_numeric"}
    jobs = read_snapshot(spark, root, "job_vacancies")
    rows = {r.job_url: r for r in jobs.collect()}
    assert set(rows) == {"u1"} and rows["u1"].job_title == "Data Engineer Python"
    assert rows["u1"].location == "DKI Jakarta" and rows["u1"].work_setup == "Hybrid"
    skills = {r.skill_name for r in read_snapshot(spark, root, "job_skills").collect()}
    assert skills == {"Python", "SQL"}
    csk = {r.skill_name for r in read_snapshot(spark, root, "course_skills").collect()}
    assert csk == {"SQL", "Excel"}
    # day 2: no job rows but a course -> stale rows still close on a later day
    land2 = tmp_path / "day2"
    write(land2, "y_output.jl", [json.dumps({"course_title": "Other", "platform": "P", "url": "c2"})])
    daily_load(spark, str(land2), root, "2026-04-06 06:00:00", "r2")
    r = {x.job_url: x for x in read_snapshot(spark, root, "job_vacancies").collect()}["u1"]
    assert not r.is_active and str(r.closed_at) == "2026-04-06 06:00:00"
    assert current_manifest(spark, root)["_seq"] == 3
    gap = {x.skill_name: (x.demand, x.supply) for x in I.skills_gap(
        read_snapshot(spark, root, "job_skills"), read_snapshot(spark, root, "course_skills")).collect()}
    assert gap == {"Python": (1, 0), "SQL": (1, 1), "Excel": (0, 1)}


def test_write_landing_partitions(spark, tmp_path):
    lines = [json.dumps({"job_title": "T", "job_url": "u1", "job_board": "a"}),
             json.dumps({"job_title": None, "job_url": "u2", "job_board": "b"}),
             json.dumps({"course_title": None, "platform": "a", "url": 'c"1'})]
    write(tmp_path / "in", "x.jl", lines)
    records = parse_landing(read_landing(spark, str(tmp_path / "in"))).withColumn("from_source", F.coalesce("job_board", "platform"))
    out = str(tmp_path / "out")
    write_landing(records, out, source_col="from_source")
    write_landing(records.filter("from_source = 'b'"), out, source_col="from_source")  # the other source stays
    back = parse_landing(read_landing(spark, out, pattern=LANDED))
    jobs, courses = route_records(back)
    assert sorted((r.job_url, r.job_title, tuple(sorted(r._keys))) for r in jobs.collect()) == [
        ("u1", "T", ("job_board", "job_title", "job_url")), ("u2", None, ("job_board", "job_title", "job_url"))]
    assert [(r.url, r.course_title, tuple(sorted(r._keys))) for r in courses.collect()] == [
        ('c"1', None, ("course_title", "platform", "url"))]
    plain = spark.createDataFrame([("a", "u1", None), ("b", None, "c")], "source string, job_url string, course_title string")
    write_landing(plain, str(tmp_path / "plain"))
    kept = parse_landing(read_landing(spark, str(tmp_path / "plain"), pattern=LANDED))
    assert all("course_title" in r._keys for r in kept.collect()) and kept.count() == 2


def test_keywords_match_python_regex(spark):
    texts = ["senior java developer, javascript", "node.js and power bi", "pyspark/spark; git-hub",
             "machine learning engineer", "déjava", "golang_dev go lang", "excel+sql", "react."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = sorted((r.i, r.skill_name) for r in S.match_keywords(df, "t", keep=["i"]).collect())
    want = sorted((i, kw) for i, t in enumerate(texts) for kw in SKILL_KEYWORDS
                  if re.search(r"\b" + re.escape(kw.lower()) + r"\b", t))
    assert got == want


def test_top_skills_ties_and_limit(spark):
    pairs = spark.createDataFrame([(1, "SQL"), (2, "SQL"), (1, "AWS"), (3, "AWS"), (4, "Git")], "job_id long, skill_name string")
    got = [(r.skill_name, r.job_count) for r in I.top_skills(pairs, n=2).collect()]
    assert got == [("AWS", 2), ("SQL", 2)]


def test_token_join_equals_regex_and_python(spark):
    texts = ["asp.net and c++ devs", "node.js, node and power bi", "déjava java_ee java", "de la mer, de lamer",
             "a++b", "machine learning engineers"]
    kws = ["java", "node.js", ".net", "c++", "power bi", "de la", "++", "machine learning", "node", "java_ee"] + \
          [f"w{i}" for i in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = sorted((i, kw) for i, t in enumerate(texts) for kw in kws
                  if re.search(r"\b" + re.escape(kw.lower()) + r"\b", t))
    via_join = sorted((r.i, r.skill_name) for r in S.match_keywords_join(df, "t", kws, keep=["i"]).collect())
    via_regex = sorted((r.i, r.skill_name) for r in S.match_keywords(df, "t", kws, keep=["i"]).collect())
    assert via_join == want and via_regex == want
    table = spark.createDataFrame([(k,) for k in [*kws, "java", None]], "keyword string")
    via_df = sorted((r.i, r.skill_name) for r in S.match_keywords_join(df, "t", table, keep=["i"]).collect())
    assert via_df == want


def test_both_keyword_plans_agree_on_odd_keywords(spark):
    texts = ["le cafe\u0301 java", "cafe x", "java, java", "a.net b", "c++x c++", "x+y ++ a++b", "UP\u0130 stra\u00dfe", ""]
    kws = ["java", "java", "cafe\u0301", "cafe", ".net", "c++", "++", "+", "stra\u00dfe", "cafe\u0301 java"]
    df = spark.createDataFrame([(i, t.lower()) for i, t in enumerate(texts)], "i int, t string")
    a = sorted((r.i, r.skill_name) for r in S.match_keywords(df, "t", kws, keep=["i"]).collect())
    b = sorted((r.i, r.skill_name) for r in S.match_keywords_join(df, "t", kws, keep=["i"]).collect())
    assert a == b and (0, "cafe\u0301") in a and len(a) == len(set(a))


def test_load_loses_nothing_and_runs_once(spark, tmp_path):
    root = str(tmp_path / "wh")
    bootstrap(spark, root)
    course = lambda title, url: json.dumps({"course_title": title, "platform": "P", "url": url, "desc": "SQL"})
    land = tmp_path / "d1"
    write(land, "a.jl", [job("u1", "Data Engineer"), job(None, "No url"), job("", "Blank url"),
                         course("One", "c1"), course("Two", "c1"), course("Three", "c3")])
    first = daily_load(spark, str(land), root, "2026-04-01 06:00:00", "r1")
    assert first["_rejects"].count() == 0
    state = {t: sorted(map(str, read_snapshot(spark, root, t).collect()))
             for t in ("job_vacancies", "courses", "job_skills", "course_skills")}
    assert [r.job_url for r in read_snapshot(spark, root, "job_vacancies").collect()] == ["u1"]
    assert {(r.course_title, r.url) for r in read_snapshot(spark, root, "courses").collect()} == {("One", "c1"), ("Three", "c3")}
    assert len(state["course_skills"]) == 2
    again = daily_load(spark, str(land), root, "2026-04-09 06:00:00", "r1")
    assert again["_seq"] == first["_seq"]
    assert state == {t: sorted(map(str, read_snapshot(spark, root, t).collect())) for t in state}
    # the next day refreshes, closes and reopens over a warehouse that is not empty
    write(tmp_path / "d2", "a.jl", [job("u2", "New"), course("One again", "c1"), course("Four", "c4")])
    daily_load(spark, str(tmp_path / "d2"), root, "2026-04-06 06:00:00", "r2")
    write(tmp_path / "d3", "a.jl", [job("u1", "Back again")])
    daily_load(spark, str(tmp_path / "d3"), root, "2026-04-07 06:00:00", "r3")
    rows = {r.job_url: r for r in read_snapshot(spark, root, "job_vacancies").collect()}
    assert rows["u1"].is_active and rows["u1"].job_title == "Back again" and str(rows["u1"].closed_at) == "2026-04-06 06:00:00"
    assert len({r.job_id for r in rows.values()}) == 2
    assert sorted(r.course_title for r in read_snapshot(spark, root, "courses").collect()) == ["Four", "One", "Three"]


def test_pandas_missing_keys(spark, tmp_path):
    from jobsight.plans.load import clean_job_batch
    land = tmp_path / "m"
    write(land, "a_output.jl", [
        json.dumps({"job_title": "Data Engineer", "job_url": "a", "job_location": "Bandung", "job_department": "Ops"}),
        json.dumps({"job_title": "Data Engineer", "job_url": "b"}),
        json.dumps({"job_title": "Data Engineer", "job_url": "c", "job_location": None, "job_department": None})])
    jobs, _ = route_records(parse_landing(read_landing(spark, str(land))))
    plain = {r.job_url: (r.location, r.job_category) for r in clean_job_batch(jobs).collect()}
    compat = {r.job_url: (r.location, r.job_category) for r in clean_job_batch(jobs, pandas_missing=True).collect()}
    assert plain == {"a": ("Bandung", "Ops"), "b": (None, "Data Engineering"), "c": (None, "Data Engineering")}
    assert compat == {"a": ("Bandung", "Ops"), "b": ("Nan", None), "c": (None, "Data Engineering")}
