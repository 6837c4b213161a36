"""Registered normaliser queries over payloads that Spark builds from ``orders``.

The driver tables hold no crawled payloads, so each query first renders the
orders (joined to customer and nation) as API responses or HTML pages of 20
postings each, grouped by ``o_orderkey div 20`` (a page never holds more than
20 rows, whatever the skew of any other column), then runs the normaliser.
The work of both steps grows with ``orders``.  ``oracle.py`` holds the DuckDB
twins, which compute the expected records straight from the orders join; unit
tests also compare each normaliser with hand-written payloads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...plans import adapters as A
from ...session import scratch_path
from ...sources.payloads import read_payloads
from ..filters import filter_json_type
from ..pages import (board_sizes, detect_ats, extract_ld_json, filter_links, filter_url_pattern, harvest_titles, has_next_data,
                     json_items, ld_json_type_census, link_harvest, next_data_keys)
from . import api, html
from .oracle import SQL

NOW = "2026-04-29 06:00:00"
PAGE = 20
# longer than any cut of the original crawler, with a skill at its end
FILLER = " lorem ipsum" * 30 + " Python"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                            "o_orderdate", "o_orderpriority")
    c = A.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("iso", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")))


def _title() -> Column:
    k = F.col("o_orderkey")
    return A._case(k % 8, list(enumerate(A.TITLES[:-1])), A.TITLES[-1])


def _marked(title: Column) -> Column:
    """A title as markup; one in four begins with character references (a name, a number, a hexadecimal number)."""
    return F.concat(F.when(F.col("o_orderkey") % 4 == 0, F.lit("R&amp;D &#8211; &#xE9;quipe ")).otherwise(F.lit("")), title)


def _href(path: Column) -> Column:
    """An href attribute in one of four spellings: double quotes, single quotes, upper case, none."""
    k = F.col("o_orderkey")
    return (F.when(k % 4 == 0, F.concat(F.lit(' href="'), path, F.lit('"')))
            .when(k % 4 == 1, F.concat(F.lit(" href='"), path, F.lit("'")))
            .when(k % 4 == 2, F.concat(F.lit(' HREF = "'), path, F.lit('"')))
            .otherwise(F.concat(F.lit(" data-n=1 href="), path)))


def _paged(df: DataFrame, item: Column) -> DataFrame:
    """(seq, items) with at most PAGE items per page, in key order."""
    page = F.floor(F.col("o_orderkey") / PAGE).alias("seq")
    g = df.select(page, F.struct(F.col("o_orderkey").alias("_k"), item.alias("v")).alias("e"))
    g = g.groupBy("seq").agg(F.sort_array(F.collect_list("e")).alias("es"))
    return g.select("seq", F.transform("es", lambda e: e["v"]).alias("items"))


def _payloads(spark, sf, item: Column, wrap, kind: str) -> DataFrame:
    g = _paged(_orders(spark, sf), item)
    return g.select(F.lit(kind).alias("source"), F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("url"),
                    F.lit(200).alias("status"), wrap(F.col("items")).alias("body"),
                    F.lit(None).cast("timestamp_ntz").alias("fetched_at"), F.col("seq").cast("long"))


def _pages(spark, sf, piece: Column, wrap) -> DataFrame:
    g = _paged(_orders(spark, sf), piece)
    return g.select(F.col("seq").alias("page_id"), F.concat(F.lit("https://site.example/p/"), F.col("seq").cast("string")).alias("url"),
                    wrap(F.col("items")).alias("html"))


def dealls_payloads(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(
        _title().alias("role"), F.col("c_mktsegment").alias("description"),
        F.concat(F.lit("job-"), k.cast("string")).alias("slug"),
        F.when(k % 3 == 0, F.concat(F.lower("c_mktsegment"), F.lit("-team"))).alias("categorySlug"),
        F.when(k % 2 == 0, F.concat("iso", F.lit(".000Z"))).alias("latestUpdatedAt"), F.col("iso").alias("createdAt"),
        F.when(F.col("o_orderstatus") == "O", "active").otherwise("closed").alias("status"),
        A._case(F.col("o_orderpriority"), [("1-URGENT", "remote"), ("2-HIGH", "hybrid")], "on-site").alias("workplaceType"),
        F.struct(F.lower("n_name").alias("name")).alias("city"), F.struct(F.lit("Indonesia").alias("name")).alias("country"),
        F.struct(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("slug")).alias("company"),
        F.array(F.lit("Full-time"), F.lit("Contract")).alias("employmentTypes"),
        F.struct(F.floor("o_totalprice").alias("start")).alias("salaryRange"),
        F.struct(F.array((k % 8).cast("int")).alias("lastEducations")).alias("candidatePreference"))
    return _payloads(spark, sf, item, lambda a: F.to_json(F.struct(F.struct(a.alias("docs"), F.lit(1).alias("page")).alias("data"))), "dealls")


def kalibrr_payloads(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(
        k.alias("id"), _title().alias("name"), F.col("c_mktsegment").alias("function"),
        F.lit("<p>Use <b>SQL</b></p>").alias("description"), F.lit("Python").alias("qualifications"),
        F.concat("iso", F.lit("Z")).alias("created_at"), F.concat("iso", F.lit("+07:00")).alias("application_end_date"),
        F.lit("Full time").alias("tenure"), F.when(k % 2 == 0, F.floor("o_totalprice")).alias("base_salary"),
        A._case(k % 4, [(0, 200), (1, 550), (2, 650)], 0).alias("education_level"),
        F.col("c_name").alias("company_name"), F.struct(F.col("c_custkey").cast("string").alias("code")).alias("company"),
        F.struct(F.struct(F.lower("n_name").alias("city"), F.lit("Jawa").alias("region")).alias("address_components")).alias("google_location"),
        (k % 5 == 0).alias("is_work_from_home"), (k % 3 == 0).alias("is_hybrid"))
    return _payloads(spark, sf, item, lambda a: F.to_json(F.struct(a.alias("jobs"))), "kalibrr")


def karir_payloads(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(
        k.alias("id"), _title().alias("job_position"), F.concat(F.col("c_name"), F.lit(", Tbk")).alias("company_name"),
        F.lower("n_name").alias("location"), F.array(F.col("c_mktsegment"), F.lit("IT")).alias("job_functions"),
        F.array(F.lit("Staff")).alias("job_levels"), F.floor("o_totalprice").alias("salary_lower"),
        F.concat("iso", F.lit("Z")).alias("posted_at"), F.when(k % 2 == 0, F.col("iso")).otherwise(F.lit("")).alias("expires_at"))
    return _payloads(spark, sf, item, lambda a: F.to_json(F.struct(F.struct(a.alias("opportunities")).alias("data"))), "karir")


def greenhouse_payloads(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(
        k.alias("id"), _title().alias("title"), F.concat("iso", F.lit("+07:00")).alias("updated_at"),
        F.when(k % 2 == 0, F.concat(F.lit("https://boards.example/j/"), k.cast("string"))).alias("absolute_url"),
        F.concat(A._case(F.col("o_orderpriority"), [("1-URGENT", "Fully remote team"), ("2-HIGH", "Hybrid office")], "Office"), F.lit(FILLER)).alias("content"),
        F.struct(F.lower("n_name").alias("name")).alias("location"),
        F.array(F.struct(F.col("c_mktsegment").alias("name"))).alias("departments"),
        F.array(F.struct(F.lower("n_name").alias("name"))).alias("offices"))
    return _payloads(spark, sf, item, lambda a: F.to_json(F.struct(a.alias("jobs"))), "greenhouse")


def lever_payloads(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(
        _title().alias("text"), F.concat(F.lit("https://jobs.lever.example/"), k.cast("string")).alias("hostedUrl"),
        (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1000).alias("createdAt"),
        F.struct(F.col("c_mktsegment").alias("department"),
                 A._case(F.col("o_orderpriority"), [("1-URGENT", "Remote"), ("2-HIGH", "Jakarta (Hybrid)")], "Jakarta").alias("location"),
                 F.lit("Full-time").alias("commitment"), F.col("c_mktsegment").alias("team")).alias("categories"))
    return _payloads(spark, sf, item, lambda a: F.to_json(a), "lever")


def jibe_payloads(spark, sf):
    k = F.col("o_orderkey")
    data = F.struct(
        k.alias("req_id"), _title().alias("title"), A._case(k % 3, [(0, "Remote friendly"), (1, "Hybrid desk")], "Office").alias("description"),
        F.lit("SQL").alias("qualifications"), F.array(F.col("c_mktsegment")).alias("tags2"),
        F.lower("n_name").alias("full_location"), F.lit("Full time").alias("employment_type"),
        F.col("c_name").alias("hiring_organization"),
        F.date_format("o_orderdate", "MMMM d, yyyy").alias("posted_date"))
    item = F.struct(data.alias("data"))
    return _payloads(spark, sf, item, lambda a: F.to_json(F.struct(a.alias("jobs"))), "jibe")


def koltiva_payloads(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(
        F.lower(_title()).alias("position_name"), F.col("c_mktsegment").alias("unitsec_name"),
        F.col("n_name").alias("unit_name"), F.lit("Indonesia").alias("country_name"),
        F.concat(F.lit("job-"), k.cast("string")).alias("slug"), F.lit("Contract Full-time").alias("work_period_name"),
        F.lit("Staff").alias("level_name"), F.concat("iso", F.lit("Z")).alias("close_date"),
        F.when(k % 4 == 0, F.lit("Work-from-home, laptop")).otherwise(F.lit("laptop")).alias("jobs_benefits_perks"))
    return _payloads(spark, sf, item, lambda a: F.to_json(F.struct(F.struct(a.alias("data")).alias("data"))), "koltiva")


def ld_pages(spark, sf):
    """JSON-LD lists; the script tag has other attributes too, every second place is a list."""
    k = F.col("o_orderkey")
    item = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), F.when(k % 9 != 0, F.concat(F.lit("https://id.jobstreet.example/job/"), k.cast("string"))).alias("url"),
        _title().alias("title"), F.concat("iso", F.lit("Z")).alias("datePosted"), F.col("iso").alias("validThrough"),
        F.lit("Full time").alias("employmentType"), F.lit("<p>SQL</p>" + FILLER).alias("description"),
        F.struct(F.col("c_name").alias("name")).alias("hiringOrganization")))
    place = F.to_json(F.struct(F.struct(F.lower("n_name").alias("addressLocality")).alias("address")))
    place = F.when(k % 2 == 0, F.concat(F.lit("["), place, F.lit("]"))).otherwise(place)
    item = F.concat(F.substring(item, F.lit(1), F.length(item) - 1), F.lit(', "jobLocation": '), place, F.lit("}"))
    tag = F.when(F.col("seq") % 2 == 0, F.lit('<script data-rh="true" type="application/ld+json">')).otherwise(
        F.lit('<script type="application/ld+json" id="x">'))
    return _pages(spark, sf, item, lambda a: F.concat(F.lit("<html>"), tag, F.lit("["), F.array_join(a, ","), F.lit("]</script></html>")))


def next_pages(spark, sf):
    """The jobs at each of the three paths in turn; an empty classification falls through to the categories."""
    k = F.col("o_orderkey")
    item = F.to_json(F.struct(
        F.concat(F.lit("/job/"), k.cast("string")).alias("jobUrl"), _title().alias("title"),
        F.struct(F.col("c_name").alias("description")).alias("advertiser"),
        F.struct(F.lower("n_name").alias("label")).alias("location"),
        F.array(F.struct(F.col("c_mktsegment").alias("name"))).alias("categories"),
        F.concat("iso", F.lit("Z")).alias("listingDate")))
    kind = F.when(k % 3 == 0, F.lit('""')).when(k % 3 == 1, F.lit("{}")).otherwise(
        F.to_json(F.struct(F.lower("c_mktsegment").alias("description"))))
    item = F.concat(F.substring(item, F.lit(1), F.length(item) - 1), F.lit(', "classification": '), kind, F.lit("}"))

    def wrap(a):
        jobs = F.concat(F.lit('{"jobs": ['), F.array_join(a, ","), F.lit("]}"))
        at = F.col("seq") % 3
        props = (F.when(at == 0, F.concat(F.lit('{"initialCandidateExperimentalData": '), jobs, F.lit("}")))
                 .when(at == 1, jobs).otherwise(F.concat(F.lit('{"jobs": [], "searchResults": '), jobs, F.lit("}"))))
        tag = F.when(F.col("seq") % 2 == 0, F.lit('<script id="__NEXT_DATA__" type="application/json">')).otherwise(
            F.lit('<script type="application/json" nonce="n" id="__NEXT_DATA__">'))
        return F.concat(F.lit("<html>"), tag, F.lit('{"props": {"pageProps": '), props, F.lit("}}</script></html>"))
    return _pages(spark, sf, item, wrap)


def posting_pages(spark, sf):
    """Search cards, vendor links, JSON titles and page titles of several kinds; one page in four has data for Next."""
    k = F.col("o_orderkey")
    key = k.cast("string")
    name = _marked(F.regexp_replace(_title(), "<[^>]*>", " "))
    link = (F.when(k % 5 == 0, F.lit(""))
            .when(k % 5 == 1, F.concat(F.lit('<a href="/id/job/other"><b>x</b></a><A data-x="a>b" HREF=\'/id/job/'), key,
                                       F.lit("?ref=cardTitle'>"), name, F.lit("</A>")))
            .when(k % 5 == 2, F.concat(F.lit('<a href="https://id.jobstreet.com/id/job/'), key, F.lit('?a=1"> </a><h2>'), name, F.lit("</h2>")))
            .otherwise(F.concat(F.lit("<a href=/id/job/"), key, F.lit("?a=1&amp;b=2><span>"), name, F.lit("</span></a>"))))
    company = (F.when(k % 3 == 0, F.concat(F.lit('<b data-automation="jobCompany">'), F.col("c_name"), F.lit("</b>")))
               .when(k % 3 == 1, F.concat(F.lit("<SPAN CLASS='x-company y'>"), F.lower("c_name"), F.lit("</SPAN>"))).otherwise(F.lit("")))
    place = F.when(k % 2 == 0, F.concat(F.lit("<i data-automation=jobLocation>"), F.lower("n_name"), F.lit("</i>"))).otherwise(F.lit(""))
    pay = F.when(k % 4 == 0, F.concat(F.lit('<i data-automation="jobSalary">Rp '), F.floor("o_totalprice").cast("string"), F.lit("</i>"))).otherwise(F.lit(""))
    piece = F.concat(F.when(k % 2 == 0, F.lit('<article data-testid="job-card">')).otherwise(F.lit("<ARTICLE data-testid='job-card'>")), link, company, place, pay, F.lit("</article>"))

    def wrap(a):
        n = F.col("seq")
        text = n.cast("string")
        title = (F.when(n % 3 == 0, F.concat(F.lit("R&amp;D Engineer "), text, F.lit(" at A&#38;B Firm "), text, F.lit(" - Tech in Asia")))
                 .when(n % 3 == 1, F.concat(F.lit("Role "), text, F.lit(" - Tech in Asia"))).otherwise(F.lit("")))
        vendor = (F.when(n % 3 == 0, F.lit('<a href="https://boards.greenhouse.io/x">g</a><a href="http://jobs.lever.co/y">l</a>'))
                  .when(n % 3 == 1, F.lit('<a href="https://x.recruitee.com/o">r</a>')).otherwise(F.lit("")))
        data = F.when(n % 4 == 0, F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">{"title": "Posting number '), text,
                                           F.lit('", "n": {"title": "x"}}</script>'))).otherwise(F.lit(""))
        return F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body><!-- <p>no</p> --><P class=x>About <b>team "), text, F.lit("</b> </P><span>Use SQL &lt; 3</span>"),
                        vendor, data, F.array_join(a, ""), F.lit('<footer><a href="/id/job/footer">f</a></footer></body></html>'))
    return _pages(spark, sf, piece, wrap)


def apollo_pages(spark, sf):
    k = F.col("o_orderkey")
    item = F.struct(F.concat(F.lit("hit:"), k.cast("string")).alias("key"), F.struct(
        F.lit("Search_ProductHit").alias("__typename"), A._case(k % 3, [(0, "Python for Data"), (1, "SQL Basics")], "Excel").alias("name"),
        F.concat(F.lit("/learn/c"), k.cast("string")).alias("url"),
        F.when(k % 2 == 0, F.array(F.lit("Python"), F.lit("SQL"))).otherwise(F.array().cast("array<string>")).alias("skills"),
        F.lit("Learn fast").alias("tagline")).alias("value"))
    return _pages(spark, sf, item, lambda a: F.concat(
        F.lit("<script>window.__APOLLO_STATE__ = "), F.to_json(F.map_from_entries(a)), F.lit(";</script>")))


def card_pages(spark, sf):
    k = F.col("o_orderkey")
    piece = F.concat(F.lit("<a"), _href(F.concat(F.lit("/academies/"), (k % 500).cast("string"))), F.lit("><h5>"), _marked(_title()),
                     F.lit("</h5><p>Belajar &amp; kerja</p><SPAN Class='level'>Pemula</SPAN></a><a href='/about'>About</a>"))
    return _pages(spark, sf, piece, lambda a: F.array_join(a, ""))


def job_card_pages(spark, sf):
    k = F.col("o_orderkey")
    piece = F.concat(F.lit('<div><a class="job" href="/o/'), k.cast("string"), F.lit('">'), _title(), F.lit("</a></div>"))
    return _pages(spark, sf, piece, lambda a: F.array_join(a, ""))


def vidio_pages(spark, sf):
    k = F.col("o_orderkey")
    piece = F.concat(F.when(k % 2 == 0, F.lit('<div class="b-job">')).otherwise(F.lit("<DIV id=j CLASS='b-job'>")), F.lit("<a"),
                     _href(F.concat(F.lit("/careers/"), k.cast("string"))), F.lit('><h3 class="b-job__name">'),
                     _marked(_title()), F.lit('</h3><span class="b-job__location">'), F.lower("n_name"),
                     F.lit('</span><span class="b-job__department">'), F.col("c_mktsegment"), F.lit("</span></a></div>"))
    return _pages(spark, sf, piece, lambda a: F.concat(
        F.lit("<html><body>"), F.array_join(a, ""), F.lit('<div class="b-job"><a><h2>No link</h2></a></div>'
                                                           '<footer><a href="/about"><h3>About</h3></a></footer></body></html>')))


def trakstar_pages(spark, sf):
    k = F.col("o_orderkey")
    setup = F.when(F.col("o_orderpriority") == "1-URGENT", "Remote").otherwise("On-site")
    piece = F.concat(
        F.when(k % 2 == 0, F.lit('<div class="js-card list-item">')).otherwise(F.lit("<Div class='js-card list-item' >")),
        F.when(k % 2 == 0, F.lit("<h3 class=js-job-list-opening-name>")).otherwise(F.lit("<h2>")), _marked(_title()),
        F.when(k % 2 == 0, F.lit("</h3>")).otherwise(F.lit("</h2><h3>Second</h3>")),
        F.lit('<div class="js-job-list-opening-loc">'), F.lower("n_name"),
        F.lit('</div><div class="col-md-4"><div class="rb-text-4">'), F.col("c_mktsegment"),
        F.lit('</div></div><div class="js-job-list-opening-meta"><span>Full-time</span><span>'), setup,
        F.lit("</span></div><a"), _href(F.concat(F.lit("/jobs/"), k.cast("string"))), F.lit(">Apply</a></div>"))
    return _pages(spark, sf, piece, lambda a: F.concat(
        F.lit("<html><body>"), F.array_join(a, ""), F.lit('<div class="js-card list-item"><h3>No link</h3></div>'
                                                           '<footer><a href="/about">About</a></footer></body></html>')))


def link_pages(spark, sf):
    """Links in every spelling, with references in their values, beside comments, scripts and elements that only look like links."""
    k = F.col("o_orderkey")
    path = F.concat(F.when(k % 5 == 0, F.lit("/jobs/search/")).when(k % 5 == 1, F.lit("https://x.example/jobs/")).when(k % 5 == 2, F.lit("/academies/")).otherwise(F.lit("/jobs/")),
                    (k % 700).cast("string"), F.lit("?a=1&amp;b=&#x41;"))
    piece = F.concat(F.lit("<li><a class='n'"), _href(path), F.lit('>x</a><!-- <a href="/jobs/hidden"> --><b data-href="/jobs/no">y</b></li>'))
    return _pages(spark, sf, piece, lambda a: F.concat(
        F.lit("<html><head><link href='/jobs/style.css'><script>var a = '<a href=\"/jobs/script\">';</script></head><ul>"), F.array_join(a, ""), F.lit("</ul></html>")))


def landed_payloads(spark, sf):
    """A4: two kinds of payloads landed as one table under the scratch folder, one kind read back."""
    path = scratch_path(spark, f"payloads-{uuid.uuid4().hex}")
    lever_payloads(spark, sf).unionByName(greenhouse_payloads(spark, sf)).write.parquet(path)
    return read_payloads(spark, path, kind="lever")


def catalog() -> dict:
    now = lambda: F.lit(NOW)
    queries = {
        "normalise_dealls": (lambda s, sf: api.normalise_dealls(dealls_payloads(s, sf), now()), None),
        "normalise_kalibrr": (lambda s, sf: api.normalise_kalibrr(kalibrr_payloads(s, sf), now()), None),
        "normalise_karir": (lambda s, sf: api.normalise_karir(karir_payloads(s, sf), now()), None),
        "normalise_greenhouse_flip": (lambda s, sf: api.normalise_greenhouse(greenhouse_payloads(s, sf), now()), None),
        "normalise_greenhouse_vidio": (lambda s, sf: api.normalise_greenhouse(
            greenhouse_payloads(s, sf), now(), company="Vidio", board="Vidio Careers", infer_from_content=False), None),
        "normalise_lever": (lambda s, sf: api.normalise_lever(lever_payloads(s, sf), now()), None),
        "normalise_jibe": (lambda s, sf: api.normalise_jibe(jibe_payloads(s, sf), now()), None),
        "normalise_koltiva": (lambda s, sf: api.normalise_koltiva(koltiva_payloads(s, sf), now()), None),
        "normalise_ld_json": (lambda s, sf: html.normalise_ld_json(ld_pages(s, sf), now()), None),
        "normalise_next_data": (lambda s, sf: html.normalise_next_data(next_pages(s, sf), now()), None),
        "normalise_apollo": (lambda s, sf: html.normalise_apollo(apollo_pages(s, sf), now()), None),
        "normalise_course_cards": (lambda s, sf: html.normalise_course_cards(card_pages(s, sf), now()), None),
        "normalise_job_cards": (lambda s, sf: html.normalise_job_cards(
            job_card_pages(s, sf), now(), "/o/", "https://careers.example", "Mekari", "Mekari Careers"), None),
        "normalise_vidio_cards": (lambda s, sf: html.normalise_vidio_cards(vidio_pages(s, sf), now()), None),
        "normalise_trakstar_cards": (lambda s, sf: html.normalise_trakstar_cards(trakstar_pages(s, sf), now()), None),
        "read_payloads": (lambda s, sf: landed_payloads(s, sf).select("source", "kind", "seq", F.json_array_length("body").alias("n_items")), None),
        "board_sizes": (lambda s, sf: board_sizes(greenhouse_payloads(s, sf)).select("seq", "n_postings"), None),
        "extract_ld_json": (lambda s, sf: extract_ld_json(ld_pages(s, sf)).select(
            "page_id", "block_pos", F.json_array_length("block").alias("n_items"),
            F.transform(json_items(F.col("block")), lambda x: F.get_json_object(x, "$.title")).alias("titles")), None),
        "normalise_search_cards": (lambda s, sf: html.normalise_search_cards(posting_pages(s, sf), now()), None),
        "normalise_title_page": (lambda s, sf: html.normalise_title_page(posting_pages(s, sf), now()), None),
        "has_next_data_rendered": (lambda s, sf: posting_pages(s, sf).select("page_id", has_next_data("html").alias("has_next_data")), None),
        "detect_ats_rendered": (lambda s, sf: detect_ats(posting_pages(s, sf)), None),
        "harvest_titles_rendered": (lambda s, sf: harvest_titles(posting_pages(s, sf), markers=["__NEXT_DATA__", "lever.co"]), None),
        "filter_links_rendered": (lambda s, sf: filter_links(link_pages(s, sf)), None),
        "filter_url_pattern_rendered": (lambda s, sf: filter_url_pattern(link_pages(s, sf)), None),
        "link_harvest_rendered": (lambda s, sf: link_harvest(link_pages(s, sf), marker="/jobs/", samples=3), None),
        "ld_json_type_census": (lambda s, sf: ld_json_type_census(ld_pages(s, sf)), None),
        "next_data_keys": (lambda s, sf: next_data_keys(next_pages(s, sf)), None),
        "filter_json_type": (lambda s, sf: filter_json_type(extract_ld_json(ld_pages(s, sf)).select(
            "page_id", F.posexplode(json_items(F.col("block"))).alias("item_pos", "item"))).select("page_id", "item_pos"), None),
    }
    return {name: (fn, SQL[name]() if name in SQL else None) for name, (fn, _) in queries.items()}
