"""Streaming ingestion: availableNow micro-batches fold into the warehouse once."""

import json

from jobsight.plans.load import bootstrap
from jobsight.sources.snapshot import current_manifest, read_snapshot
from jobsight.streaming.ingest import start


def test_available_now_stream(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    rec = {"job_title": "Data Engineer", "job_url": "s1", "company": "Co", "job_location": "Bandung",
           "job_board": "B", "base_salary": "10", "work_arrangement": "WFH", "desc": "Kafka and Spark"}
    (land / "a_output.jl").write_text(json.dumps(rec) + "\n")
    root = str(tmp_path / "wh")
    bootstrap(spark, root)
    q = start(spark, str(land), root, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    rows = read_snapshot(spark, root, "job_vacancies").collect()
    assert [r.job_url for r in rows] == ["s1"] and rows[0].work_setup == "Remote"
    assert {r.skill_name for r in read_snapshot(spark, root, "job_skills").collect()} == {"Kafka", "Spark"}
    seq = current_manifest(spark, root)["_seq"]
    q2 = start(spark, str(land), root, str(tmp_path / "ckpt"))   # nothing new: no new version
    q2.awaitTermination(300)
    assert current_manifest(spark, root)["_seq"] == seq


def test_new_checkpoint_does_not_skip(spark, tmp_path):
    """The batches of a second stream count from 0 again and are loaded all the same."""
    root = str(tmp_path / "wh")
    bootstrap(spark, root)
    for n in (1, 2):
        land = tmp_path / f"landing{n}"
        land.mkdir()
        (land / "a_output.jl").write_text(json.dumps({"job_title": f"T{n}", "job_url": f"s{n}", "base_salary": "1"}) + "\n")
        start(spark, str(land), root, str(tmp_path / f"ckpt{n}")).awaitTermination(300)
    assert sorted(r.job_url for r in read_snapshot(spark, root, "job_vacancies").collect()) == ["s1", "s2"]
