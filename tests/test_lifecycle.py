"""Three-day lifecycle cases and replay vs closed form."""

from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F

from jobsight.operators import lifecycle as L
from jobsight.schemas import empty

BATCH = "job_title string, company_name string, location string, source string, job_url string, " \
        "salary_avg decimal(15,2), job_category string, experience_level string, work_setup string, job_type string"


def batch(spark, rows):
    full = [(t, c, "DKI Jakarta", "Src", u, Decimal(s), "Other", None, w, None) for t, c, u, s, w in rows]
    return spark.createDataFrame(full, BATCH)


def state(df):
    return {r["job_url"]: r for r in df.collect()}


def test_new_then_refresh_keeps_company_and_closed_at(spark):
    cur = empty(spark, "job_vacancies")
    d1 = L.close_stale(L.upsert_jobs(cur, batch(spark, [("A", "Co1", "u1", 100, "Onsite")]), "2026-04-01 08:00:00"),
                       "2026-04-01 08:00:00")
    s1 = state(d1)["u1"]
    assert s1.is_active and s1.scraped_at == s1.last_seen and s1.closed_at is None and s1.job_id == 1
    d2 = L.upsert_jobs(d1, batch(spark, [("B", "Co2", "u1", 200, "Remote"), ("C", "Co3", "u2", 0, "Hybrid")]),
                       "2026-04-02 08:00:00")
    s2 = state(d2)
    assert s2["u1"].job_title == "B" and s2["u1"].company_name == "Co1" and float(s2["u1"].salary_avg) == 200
    assert s2["u1"].work_setup == "Remote" and str(s2["u1"].scraped_at) == "2026-04-01 08:00:00"
    assert s2["u1"].job_id == 1 and s2["u2"].job_id > 1


def test_stale_boundary_midnight_kept(spark):
    rows = [Row(last_seen="2026-04-07 00:00:00", is_active=True), Row(last_seen="2026-04-06 23:59:59", is_active=True),
            Row(last_seen="2026-04-01 00:00:00", is_active=False)]
    df = spark.createDataFrame(rows).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))
    got = [r[0] for r in df.select(L.stale_predicate("last_seen", "is_active", "2026-04-10 09:00:00")).collect()]
    assert got == [False, True, False]


def test_reopen_keeps_closed_at_and_empty_batch_closes(spark):
    cur = empty(spark, "job_vacancies")
    s = L.close_stale(L.upsert_jobs(cur, batch(spark, [("A", "Co", "u1", 1, "Onsite")]), "2026-04-01 00:00:00"),
                      "2026-04-01 00:00:00")
    s = L.close_stale(s, "2026-04-05 00:00:00")          # batch with no jobs: still closes
    assert not state(s)["u1"].is_active and str(state(s)["u1"].closed_at) == "2026-04-05 00:00:00"
    s = L.close_stale(L.upsert_jobs(s, batch(spark, [("A2", "Co", "u1", 1, "Onsite")]), "2026-04-06 00:00:00"),
                      "2026-04-06 00:00:00")
    r = state(s)["u1"]
    assert r.is_active and str(r.closed_at) == "2026-04-05 00:00:00" and r.job_title == "A2"


def test_replay_equals_closed_form(spark):
    days = ["2026-04-01", "2026-04-02", "2026-04-03", "2026-04-09", "2026-04-10", "2026-04-12", "2026-04-20"]
    seen = {"2026-04-01": ["u1", "u2", "u3"], "2026-04-02": ["u1"], "2026-04-03": ["u2"],
            "2026-04-09": ["u1", "u4"], "2026-04-10": [], "2026-04-12": ["u4", "u3"], "2026-04-20": ["u2"]}
    all_days = [f"2026-04-{d:02d}" for d in range(1, 24)]
    batches, sightings, pos = [], [], 0
    for d in all_days:
        urls = seen.get(d, [])
        rows = []
        for u in urls:
            pos += 1
            rows.append((f"T{pos}", "Co" + u, u, pos, "Onsite"))
            sightings.append((f"T{pos}", "Co" + u, "DKI Jakarta", "Src", u, Decimal(pos), "Other", None, "Onsite", None, d + " 00:00:00", pos))
        batches.append((d + " 00:00:00", batch(spark, rows) if rows else None))
    assert set(days) <= set(all_days)
    folded = L.replay(empty(spark, "job_vacancies"), batches)
    sdf = spark.createDataFrame(sightings, BATCH + ", seen_at string, pos long").withColumn(
        "seen_at", F.col("seen_at").cast("timestamp_ntz"))
    closed = L.replay_closed_form(sdf, "2026-04-23 00:00:00")
    cols = [c for c in closed.columns]
    a = sorted(tuple(r[c] for c in cols) for r in folded.select(*cols).collect())
    b = sorted(tuple(r[c] for c in cols) for r in closed.collect())
    assert a == b


def test_insert_courses_keeps_title(spark):
    cur = spark.createDataFrame([(1, "Old", "P", "c1", None)], "course_id long, course_title string, platform string, url string, scraped_at timestamp_ntz")
    b = spark.createDataFrame([("New", "P", "c1", 1), ("X", "P", "c2", 2), ("Y", "P", "c2", 3)],
                              "course_title string, platform string, url string, pos long")
    out = {r.url: r for r in L.insert_courses(cur, b, "2026-04-02", order=["pos"]).collect()}
    assert out["c1"].course_title == "Old" and out["c2"].course_title == "X" and out["c2"].course_id == 2


def test_constraints_and_set_ops(spark):
    df = spark.createDataFrame([(None, "u1", True, 1.0), ("A" * 300, "u2", True, 1.0), ("ok", "u3", False, None),
                                ("ok", "u4", True, 5.0), ("dup", "u4", True, 5.0)],
                               "job_title string, job_url string, salary_ok boolean, salary_avg double")
    good, bad = L.check_constraints(df, "job_vacancies")
    reasons = {r.job_url: r.reject_reason for r in bad.collect()}
    assert reasons["u1"] == "job_title_null" and reasons["u2"] == "job_title_too_long"
    assert reasons["u3"] == "salary_not_numeric" and reasons["u4"] == "duplicate_key" and good.count() == 0
    pairs = spark.createDataFrame([(1, "SQL"), (2, "AWS"), (9, "Git")], "job_id long, skill_name string")
    parents = spark.createDataFrame([(1,), (2,)], "job_id long")
    assert L.orphan_check(pairs, parents, "job_id").count() == 1
    assert L.cascade_delete(pairs, parents, "job_id").count() == 2
    merged = L.insert_absent(pairs, spark.createDataFrame([(1, "SQL"), (3, "SQL")], "job_id long, skill_name string"),
                             ["job_id", "skill_name"])
    assert merged.count() == 4


def test_ids_unique_both_modes(spark):
    df = spark.range(0, 1000).repartition(7).withColumn("k", F.col("id").cast("string"))
    a = L.assign_ids(df, "jid", 10, order=["k"])
    b = L.assign_ids(df, "jid", 10, order=["k"], compact=True)
    assert a.select("jid").distinct().count() == 1000 and a.agg(F.min("jid")).first()[0] >= 11
    ids = sorted(r[0] for r in b.select("jid").collect())
    assert ids == list(range(11, 1011))
