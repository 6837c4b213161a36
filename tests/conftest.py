import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobsight.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="jobsight-tests")
    yield s
    s.stop()


def one_col(spark, values, expr_fn, dtype="string"):
    """Evaluate ``expr_fn(col)`` on literal rows; returns results in input order."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    out = df.select("i", expr_fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]
