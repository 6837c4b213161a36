"""E7 with a running set of urls against a page-by-page reading."""

import random

from jobsight.operators import dedup


def brute(rows):
    """Pages of a run in order; a page's first route with an unseen url is emitted."""
    out, seen = [], {}
    for run, page in sorted({(r[0], r[1]) for r in rows}):
        have = seen.setdefault(run, set())
        for route in sorted({r[2] for r in rows if r[:2] == (run, page)}):
            n = 0
            for r in sorted((x for x in rows if x[:3] == (run, page, route)), key=lambda x: x[3]):
                if r[4] is not None and r[4] not in have:
                    have.add(r[4])
                    out.append(r)
                    n += 1
            if n:
                break
    return sorted(out)


def test_running_set(spark):
    rnd = random.Random(4)
    for pages, urls in ((12, 6), (25, 30), (40, 15)):
        rows = []
        for run in ("a", "b"):
            for page in range(pages):
                for route in rnd.sample([1, 2, 3], rnd.randrange(1, 4)):
                    for pos in range(rnd.randrange(0, 4)):
                        rows.append((run, page, route, pos, rnd.choice([None, *(f"u{rnd.randrange(urls)}" for _ in range(9))])))
        df = spark.createDataFrame(rows, "run string, page_seq int, route int, item_pos int, job_url string").repartition(3)
        assert sorted(map(tuple, dedup.first_new_route(df).collect())) == brute(rows)


def test_chain_of_pages(spark):
    """Each page's first route holds only the url that the page before takes."""
    rows = [("r", 0, 1, 0, "u0")] + [("r", p, k, 0, f"u{p - 1 if k == 1 else p}") for p in range(1, 9) for k in (1, 2)]
    df = spark.createDataFrame(rows, "run string, page_seq int, route int, item_pos int, job_url string")
    got = sorted(map(tuple, dedup.first_new_route(df).collect()))
    assert got == brute(rows) and len(got) == 9


def test_empty(spark):
    df = spark.createDataFrame([], "run string, page_seq int, route int, item_pos int, job_url string")
    assert dedup.first_new_route(df).collect() == []
