"""Clustered snapshots: lookups reach the scan and find their rows in few files."""

from jobsight.plans.insights import facet_filter
from jobsight.session import scratch_path
from jobsight.sources.clustered import files_with, publish_clustered, read_clustered


def test_lookup_on_clustered_snapshot(spark):
    rows = [(f"u{i}", f"city{i % 20:02d}", ("Onsite", "Remote")[i % 2], f"s{i % 3}", "Contract", "Senior") for i in range(4000)]
    df = spark.createDataFrame(rows, "job_url string, location string, work_setup string, source string, job_type string, experience_level string")
    path = publish_clustered(df.repartition(5), scratch_path(spark, "clustered-test"), files=10)
    stored = read_clustered(spark, path)
    hit = facet_filter(stored, location="city07", work_setup="Remote")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(location)" in plan and "EqualTo(location,city07)" in plan and "EqualTo(work_setup,Remote)" in plan
    assert hit.count() == 200 and stored.count() == 4000
    assert files_with(hit).count() <= 2 < files_with(stored).count()
