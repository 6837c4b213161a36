"""H2-H5, H9 and B1-B16 on hand-written payloads and pages."""

import json

from pyspark.sql import functions as F

from jobsight.operators import pages as P
from jobsight.operators.normalise import api, html
from jobsight.sources.payloads import payloads_from_rows

NOW = "2026-04-29 06:00:00"
LD = ('<script type="application/ld+json">[{"@type": "JobPosting", "url": "https://x/1", "title": "Data  Analyst",'
      ' "datePosted": "2026-04-20T10:00:00+07:00", "hiringOrganization": {"name": "Acme"},'
      ' "jobLocation": {"address": {"addressRegion": "Jawa Barat"}}}, {"@type": "Organization"}]</script>'
      '<script type="application/ld+json">{"@type": "JobPosting", "title": "No url"}</script>')
ND = ('<script id="__NEXT_DATA__" type="application/json">{"props": {"pageProps": {"jobs": [],'
      ' "searchResults": {"jobs": [{"jobUrl": "/job/9", "title": "Dev", "location": {"label": "Jakarta"},'
      ' "classification": [{"name": "IT"}], "listingDate": "2026-04-01T00:00:00Z"}]}, "meta": {"a": 1}}}}</script>')


def pages_df(spark):
    return spark.createDataFrame([(1, "https://p/1", "<html>" + LD + "</html>"), (2, "https://p/2", ND)],
                                 "page_id long, url string, html string")


def test_ld_json_blocks_and_types(spark):
    pg = pages_df(spark)
    assert P.extract_ld_json(pg).count() == 2
    census = {r.ld_type: r.n_items for r in P.ld_json_type_census(pg).collect()}
    assert census == {"JobPosting": 2, "Organization": 1}
    recs = html.normalise_ld_json(pg, F.lit(NOW)).collect()
    assert len(recs) == 1
    r = recs[0]
    assert (r.job_title, r.company, r.job_location, r.last_seen) == ("Data Analyst", "Acme", "Jawa Barat", "2026-04-20 10:00:00")


def test_next_data(spark):
    pg = pages_df(spark)
    flags = {r.page_id: r.has_next_data for r in pg.select("page_id", P.has_next_data("html").alias("has_next_data")).collect()}
    assert flags == {1: False, 2: True}
    keys = {r.key: r.job_like for r in P.next_data_keys(pg).collect()}
    assert keys == {"jobs": False, "searchResults": False, "meta": False}
    r = html.normalise_next_data(pg, F.lit(NOW)).first()
    assert (r.job_url, r.job_location, r.job_department, r.last_seen) == (
        "https://id.jobstreet.com/job/9", "Jakarta", "IT", "2026-04-01 00:00:00")


def payload(spark, body, kind="k"):
    return payloads_from_rows(spark, [(kind, kind, None, 200, json.dumps(body), None, 1)])


def test_dealls(spark):
    body = {"data": {"docs": [
        {"role": "Data, Engineer", "slug": "de-1", "categorySlug": "data-science", "createdAt": "2026-04-01T10:00:00.000Z",
         "status": "active", "workplaceType": "REMOTE", "city": {"name": "Bandung"}, "company": {"name": "Co", "slug": "co"},
         "employmentTypes": ["Full-time", "Intern"], "salaryRange": {"start": 7000000},
         "candidatePreference": {"lastEducations": [5, 6]}},
        {"role": None, "slug": "x", "status": "closed", "city": "Jakarta", "employmentTypes": []}]}}
    rows = api.normalise_dealls(payload(spark, body), F.lit(NOW)).orderBy("item_pos").collect()
    a, b = rows
    assert (a.job_title, a.job_location, a.job_department, a.base_salary) == ("Data - Engineer", "Bandung, Indonesia", "Data Science", "7000000")
    assert (a.job_type, a.job_level, a.last_seen, a.is_active, a.work_arrangement) == (
        "Full-time, Intern", "Graduate", "2026-04-01 10:00:00", "True", "Remote")
    assert (b.job_title, b.job_location, b.job_type, b.job_level, b.is_active, b.last_seen) == (
        "N/A", "N/A, Indonesia", "N/A", "Junior/Mid-Level", "False", NOW)


def test_kalibrr_karir_koltiva_lever(spark):
    k = {"jobs": [{"id": 7, "name": "Analyst\nSQL", "company": {"code": "acme"}, "education_level": 550,
                   "google_location": {"address_components": {"city": "", "region": "Jawa"}},
                   "is_work_from_home": False, "is_hybrid": True, "created_at": "2026-04-02T01:02:03Z"}]}
    r = api.normalise_kalibrr(payload(spark, k), F.lit(NOW)).first()
    assert (r.job_title, r.job_url, r.job_level, r.job_location, r.work_arrangement, r.last_seen) == (
        "Analyst SQL", "https://www.kalibrr.com/c/acme/jobs/7", "Bachelor", "Jawa", "Hybrid", "2026-04-02 01:02:03")
    kr = {"data": {"opportunities": [{"id": 3, "job_position": "Dev, Ops", "job_functions": ["IT", "Ops"],
                                      "salary_lower": 5, "salary_upper": 9, "posted_at": "2026-04-28T03:02:00Z", "expires_at": ""}]}}
    r = api.normalise_karir(payload(spark, kr), F.lit(NOW)).first()
    assert (r.job_title, r.job_department, r.base_salary, r.last_seen, r.job_apply_end_date, r.job_level) == (
        "Dev - Ops", "IT - Ops", "5", "2026-04-28T03:02:00Z", "", "N/A")
    ko = {"data": {"data": [{"position_name": "data analyst", "work_period_name": "Contract Full Time",
                             "close_date": "2026-05-01T00:00:00", "jobs_benefits_perks": "Work-from-home"}]}}
    r = api.normalise_koltiva(payload(spark, ko), F.lit(NOW)).first()
    assert (r.job_title, r.job_type, r.job_apply_end_date, r.work_arrangement) == ("Data Analyst", "Full Time", "2026-05-01", "Remote")
    lv = [{"text": "QA", "hostedUrl": "https://l/1", "createdAt": 86400000, "categories": {"location": "Remote - ID"}}]
    r = api.normalise_lever(payload(spark, lv), F.lit(NOW)).first()
    assert (r.last_seen, r.work_arrangement, r.job_type, r.job_department) == ("1970-01-02 00:00:00", "Remote", "Full-time", "N/A")
    sizes = P.board_sizes(payload(spark, lv)).first().n_postings
    assert sizes == 1


def test_course_pages(spark):
    ap = ('<script>window.__APOLLO_STATE__ = {"a": {"__typename": "Search_ProductHit", "name": "ML", "url": "/learn/ml",'
          ' "skills": ["Python", "SQL"]}, "b": {"__typename": "Other"}, "c": 3};</script>')
    cards = ('<a href="/academies/12"><h5>Belajar Python</h5><p> Dasar </p><span class="level">Pemula</span></a>'
             '<a href="/academies/12"><h5>Dup</h5></a><a href="/about">x</a>')
    pg = spark.createDataFrame([(1, "u", ap), (2, "u", cards)], "page_id long, url string, html string")
    r = html.normalise_apollo(pg, F.lit(NOW)).first()
    assert (r.course_title, r.desc, r.url) == ("ML", "Python, SQL", "https://www.coursera.org/learn/ml")
    rows = html.normalise_course_cards(pg, F.lit(NOW)).collect()
    assert len(rows) == 1 and (rows[0].course_title, rows[0].desc, rows[0].level) == ("Belajar Python", "Dasar", "Pemula")


def test_filters_and_static_catalogue(spark):
    from jobsight.operators import filters as Fl
    recs = spark.createDataFrame([("P", "c1", None), ("P", "", "j"), (None, None, "j2"), ("", None, ""), (None, None, None)],
                                 "platform string, url string, job_url string")
    kept = [(r.platform, r.url, r.job_url) for r in Fl.drop_keyless(recs).collect()]
    assert kept == [("P", "c1", None), (None, None, "j2")]
    cards = spark.createDataFrame([("t", "u"), ("  ", "u"), ("t", None)], "job_title string, job_url string")
    assert Fl.drop_incomplete(cards, ["job_title", "job_url"]).count() == 1
    items = spark.createDataFrame([('{"@type": "JobPosting"}',), ('{"@type": "Place"}',), ("[]",)], "item string")
    assert Fl.filter_json_type(items).count() == 1
    cat = html.static_catalogue(spark, [{"course_title": "A", "url": "https://d/1"}, {"course_title": "B", "url": "https://d/2"}], NOW)
    rows = cat.collect()
    assert [r.platform for r in rows] == ["Dicoding", "Dicoding"] and rows[0].scraped_at == NOW


def test_card_cascades(spark):
    vidio = ('<ul><li class="job-item"><a href="/careers/7"><h3> QA  Lead </h3><span>Jakarta</span></a></li>'
             '<li class="job-item"><a href="/careers/8"><h3>N/A</h3></a></li>'
             '<li class="job-item"><a><h3>No link</h3></a></li></ul>')
    trak = ('<div class="js-card list-item"><h3>Ops</h3><div class="js-job-list-opening-meta"><span>Contract</span>'
            '<span>Hybrid</span></div><a href="https://x/job/1">Apply</a></div>'
            '<div class="js-card list-item"><h3>Missing href</h3></div>')
    pg = spark.createDataFrame([(1, "u", vidio), (2, "u", trak)], "page_id long, url string, html string")
    v = html.normalise_vidio_cards(pg, F.lit(NOW)).collect()
    assert [(r.job_title, r.job_url, r.job_location) for r in v if r.seq == 1] == [
        ("QA Lead", "https://www.vidio.com/careers/7", "Jakarta")]
    t = html.normalise_trakstar_cards(pg, F.lit(NOW)).orderBy("seq", "item_pos").collect()
    assert [(r.job_title, r.job_type, r.work_arrangement, r.job_url) for r in t if r.seq == 2] == [
        ("Ops", "Contract", "Hybrid", "https://x/job/1")]


def test_cards_end_at_their_own_tag_and_follow_document_order(spark):
    page = ('<div class="b-job"><a href="/careers/1"><h2>First</h2><h3>Second</h3></a></div>'
            '<div class="b-job"><a><div>inner</div><h3>No link</h3></a></div><footer><a href="/about">x</a></footer>')
    pg = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    rows = html.normalise_vidio_cards(pg, F.lit(NOW)).collect()
    assert [(r.job_title, r.job_url) for r in rows] == [("First", "https://www.vidio.com/careers/1")]


def test_script_attributes_in_any_order(spark):
    ld = '<script data-rh="true" type="application/ld+json">{"@type": "JobPosting", "url": "u", "description": "%s Python"}</script>' % ("x " * 300)
    pg = spark.createDataFrame([(1, "u", ld)], "page_id long, url string, html string")
    rows = html.normalise_ld_json(pg, F.lit(NOW)).collect()
    assert len(rows) == 1 and rows[0].desc.endswith("Python")
    assert not html.normalise_ld_json(pg, F.lit(NOW), desc_chars=300).first().desc.endswith("Python")


def test_search_card_and_title_page(spark):
    page = ('<title>Data Lead at Acme - Tech in Asia</title><article data-testid="job-card"><a href="/id/job/1?x=cardTitle"> <b>Lead</b></a>'
            '<span class="a company">Acme</span><i data-automation="jobSalary">Rp 5</i></article><p>One <i>two</i></p><span>three</span>')
    pg = spark.createDataFrame([(1, "https://p/1", page)], "page_id long, url string, html string")
    c = html.normalise_search_cards(pg, F.lit(NOW)).first()
    assert (c.job_title, c.job_url, c.company, c.base_salary, c.job_location) == (
        "N/A", "https://id.jobstreet.com/id/job/1", "Acme", "Rp 5", "Indonesia")  # the link's first text is blank, and no heading
    t = html.normalise_title_page(pg, F.lit(NOW)).first()
    assert (t.job_title, t.company, t.desc) == ("Data Lead", "Acme", "Acme One two three")
