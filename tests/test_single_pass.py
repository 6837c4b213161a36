"""Costly rules are evaluated once per row: what the optimised plans and the tokenizer hold."""

from pyspark.sql import functions as F

from jobsight.functions.markup import TOKEN, canonical_markup
from jobsight.functions.text import py_strip
from jobsight.operators.normalise import api, html
from jobsight.operators.pages import json_items

def now():
    return F.lit("2026-04-29 06:00:00")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def payloads(spark, body):
    return spark.createDataFrame([("s", 0, None, body)], "source string, seq long, fetched_at timestamp_ntz, body string")


def pages(spark, text):
    return spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")


def test_postings_are_parsed_once(spark):
    body = '{"data": {"data": [{"position_name": "a,b", "slug": "x", "close_date": "2026-05-01T00:00:00Z"}, null, 3]}}'
    got = api.normalise_koltiva(payloads(spark, body), now())
    assert plan(got).count("get_json_object") == 1  # the list itself
    assert [(r["job_title"], r["job_apply_end_date"]) for r in got.orderBy("item_pos").collect()] == [
        ("A -B", "2026-05-01"), ("N/A", ""), ("N/A", "")]
    ld = html.normalise_ld_json(pages(spark, '<script type="application/ld+json">[{"@type":"JobPosting","url":"u","title":"t",'
                                             '"jobLocation":[{"address":{"addressLocality":"X"}}]}, 5]</script>'), now())
    assert "$.title" not in plan(ld)
    assert [(r["job_title"], r["job_location"]) for r in ld.collect()] == [("t", "X")]


def test_filters_repeat_no_rule(spark):
    page = pages(spark, '<div class="b-job"><a href="/careers/1"><h3>T &amp; U</h3></a></div><article><a href="/id/job/7">J</a></article>'
                        '<div class="js-card list-item"><h3>K</h3><a href="/jobs/1">x</a></div>')
    nxt = pages(spark, '<script id="__NEXT_DATA__">{"props":{"pageProps":{"jobs":[{"url":"/j","title":"N"},{"title":"no url"}]}}}</script>')
    for got, titles in ((html.normalise_vidio_cards(page, now()), ["T & U"]), (html.normalise_search_cards(page, now()), ["J"]),
                        (html.normalise_trakstar_cards(page, now()), ["K"]), (html.normalise_next_data(nxt, now()), ["N"])):
        filters = [x for x in plan(got).splitlines() if "Filter " in x]
        assert not any("from_json" in x or "Evaluator" in x or "regexp_extract(card" in x or "transform(" in x for x in filters), filters
        assert [r["job_title"] for r in got.collect()] == titles


def test_white_space_and_markup_take_short_ways(spark):
    one = pages(spark, "<ul>" + '<li> x<a class="n" href="/jobs/1">y</a></li> ' * 50 + "</ul>")
    assert "regexp" not in plan(one.select(py_strip("html"), json_items(F.col("html"))))
    row = one.select("html", canonical_markup("html").alias("c"), F.size(F.regexp_extract_all("html", F.lit(TOKEN), F.lit(0))).alias("n")).first()
    assert row["c"] == row["html"] and row["n"] == 3  # canonical tags go with the text before them
    odd = "<SCRIPT>a<b</SCRIPT><p>x<STYLE >y</style><img src=a/b disabled><a href='q\"<'>t</A  ><div class=\"x"
    assert pages(spark, odd).select(canonical_markup("html")).first()[0] == (
        '<script></script><p>x<style></style><img src="a/b" disabled=""><a href="q&quot;&lt;">t</a><div>')


def test_dictionary_pairs_need_no_regex_per_candidate(spark):
    words = ["Data Lake", "data lake", "lake", "data  lake", "big data lake", "c++", "c++ data", "x\n", "a b\n", "++", "data-lake", "é ö", "lake‍x"]
    texts = ["big data lake", "data  lake c++ x", "xdata lake", "data lakes", "data-lake é ö.", "a b\n c++data ++", "c++ data\nlake", None, "", "big data lake",
             "lake‍x data lake data lake"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    from jobsight.operators import skills
    want = sorted((r["id"], r["skill_name"]) for r in skills.match_keywords(docs, "t", words, keep=["id"]).collect())
    joined = skills.match_keywords_join(docs, "t", words, keep=["id"])
    assert sorted((r["id"], r["skill_name"]) for r in joined.collect()) == want
    two = skills.match_keywords_join(docs, "t", ["data lake", "é ö"], keep=["id"])
    assert (0, "data lake") in {(r["id"], r["skill_name"]) for r in two.collect()} and "array_intersect" in plan(two)
