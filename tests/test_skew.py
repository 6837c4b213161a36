"""A key holding a third of all rows: results stay whole and plans pre-aggregate."""

from pyspark.sql import functions as F

from jobsight.operators import dedup, lifecycle
from jobsight.plans import insights as I


def hot(spark, n=3000):
    # one url carries a third of the rows, the rest are unique
    df = spark.range(n).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("job_url"),
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("job_title"))
    return df.repartition(8)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_hot_key(spark):
    df = hot(spark)
    out = dedup.first_per_key(df, "job_url", ["pos"])
    rows = {r.job_url: r for r in out.collect()}
    assert len(rows) == 2001 and rows["hot"].pos == 0 and rows["hot"].job_title == "T0"
    # partial aggregation runs before the shuffle, so the hot key leaves each map task as one row
    assert "partial_min_by" in plan_of(out)


def test_route_choice_and_constraints_hot_key(spark):
    df = hot(spark).withColumn("route", (F.col("pos") % 2) + 1)
    best = dedup.first_nonempty_route(df, "job_url")
    assert best.filter("job_url = 'hot'").count() == 500 and best.count() == 500 + 2000
    good, bad = lifecycle.check_constraints(df.withColumn("salary_ok", F.lit(True)).withColumn("salary_avg", F.lit(1.0)))
    assert bad.count() == 1000 and good.count() == 2000


def test_closed_form_hot_key_bounded_by_days(spark):
    base = hot(spark).withColumn("seen_at", (F.lit("2026-01-01").cast("date") + (F.col("pos") % 40).cast("int")).cast("timestamp_ntz"))
    cols = {c: F.lit(None).cast("string") for c in ["company_name", "location", "source", "job_category",
                                                     "experience_level", "work_setup", "job_type"]}
    s = base.select("*", *[v.alias(k) for k, v in cols.items()], F.lit(0).cast("decimal(15,2)").alias("salary_avg"))
    st = {r.job_url: r for r in lifecycle.replay_closed_form(s, "2026-03-01 00:00:00").collect()}
    assert len(st) == 2001 and not st["hot"].is_active and str(st["hot"].last_seen) == "2026-02-09 00:00:00"
    top = I.top_companies(s.withColumn("company_name", F.when(F.col("job_url") == "hot", "Big").otherwise(F.col("job_url"))), 1).collect()
    assert top[0].company_name == "Big" and top[0].job_count == 1000
