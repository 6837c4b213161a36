"""Bucketed snapshots: the upsert moves only the batch."""

import re

from jobsight.operators import lifecycle as L
from jobsight.schemas import JOB_VACANCIES, empty
from jobsight.session import scratch_path
from jobsight.sources.bucketed import publish_bucketed, read_bucketed

from test_lifecycle import batch, state


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_on_buckets(spark):
    old = [(f"T{i}", "Co", f"u{i}", i, "Onsite") for i in range(300)]
    path = scratch_path(spark, "bucketed-test")
    publish_bucketed(L.upsert_jobs(empty(spark, "job_vacancies"), batch(spark, old), "2026-04-01 08:00:00"), path, buckets=6)
    current = read_bucketed(spark, path, JOB_VACANCIES, buckets=6)
    assert current.count() == 300
    new = [(f"N{i}", "Other", f"u{i}", i + 1, "Remote") for i in range(250, 340)]
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        out = L.upsert_jobs(current, batch(spark, new), "2026-04-02 08:00:00")
        kept = plan_of(out.filter("job_id <= 300"))
        # one exchange of the batch into the snapshot's buckets, none above the snapshot's scan
        assert "Bucketed: true" in kept
        assert len(re.findall(r"Exchange hashpartitioning\(.*?, 6\)", kept)) == 1
        got = state(out)
    finally:
        spark.conf.set(conf, before)
    assert len(got) == 340 and got["u260"].job_title == "N260" and got["u260"].company_name == "Co"
    ids = {u: r.job_id for u, r in got.items()}
    assert sorted(ids.values()) == list(range(1, 341))
    # new urls follow each other in their order
    fresh = sorted(u for u in ids if ids[u] > 300)
    assert [ids[u] for u in fresh] == list(range(301, 341))
    # the next version is written from the updated one, and holds every row once
    second = path + "-2"
    publish_bucketed(out, second, buckets=6)
    again = read_bucketed(spark, second, JOB_VACANCIES, buckets=6)
    assert state(again).keys() == got.keys() and again.count() == 340
