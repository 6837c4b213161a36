"""Operators over a ``pages(page_id, url, html)`` table.

The reference inspects one rendered page at a time with CSS selectors; here
every rule is a native regex/JSON expression evaluated per row, so a table of
millions of pages is one narrow scan (plus one aggregate for the census).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markup import canonical_markup, decode_references, link_hrefs
from ..functions.text import absolutize_url, py_strip, strip_query
from . import dedup

# Patterns and markers.  Embedded JSON is found by one attribute of
# its script tag, whatever other attributes stand beside it.
LD_JSON = r'(?is)<script\b[^>]*\btype\s*=\s*["\']?application/ld\+json["\']?[^>]*>(.*?)</script>'
NEXT_DATA = r'(?is)<script\b[^>]*\bid\s*=\s*["\']?__NEXT_DATA__["\']?[^>]*>\s*(\{.*?\})\s*</script>'
# H4 looks for this very text.
NEXT_DATA_LITERAL = r'(?s)<script id="__NEXT_DATA__" type="application/json">(\{.*?\})</script>'
# On canonical markup.
TITLE_TAG = r"(?s)<title(?: [^>]*)?>(.*?)</title>"
# Hosting vendors recognised in page links.
ATS_VENDORS = ["greenhouse", "lever", "workable", "kalibrr", "glints", "recruitee", "smartrecruit"]
ATS_LINK = r'(?i)https?://[^\s"<>]*(' + "|".join(ATS_VENDORS) + r')[^\s"<>]*'
JSON_TITLE = r'"title"\s*:\s*"([^"]{5,50})"'
# Selectors counted by the census, as literal markers.
CENSUS_MARKERS = ['data-testid="job-card"', "<article", 'data-automation="jobListing"', "<a href=",
                  "<p>", "<script", "application/ld+json", "__NEXT_DATA__"]
TIA_SUFFIX = " - Tech in Asia"


def links(pages: DataFrame) -> DataFrame:
    """Every link's href, decoded, with its position in the page."""
    return pages.select("page_id", "url", F.posexplode(link_hrefs("html")).alias("item_pos", "href"))


def title_text(markup: Column) -> Column:
    """The decoded text of the title of canonical markup, empty without one."""
    return decode_references(F.coalesce(F.regexp_extract(markup, TITLE_TAG, 1), F.lit("")))


def filter_links(pages: DataFrame, marker: str = "/jobs/", exact_exclude: str = "/jobs",
                 banned: Sequence[str] = ("search", "employers"), base: str = "https://www.techinasia.com") -> DataFrame:
    """Distinct absolute links containing ``marker`` (minus listing/search pages)."""
    h = F.col("href")
    cond = h.contains(marker) & (h != exact_exclude)
    for b in banned:
        cond = cond & ~h.contains(b)
    return links(pages).filter(cond).select(absolutize_url(h, base).alias("link")).distinct()


def filter_url_pattern(pages: DataFrame, pattern: str = r"/academies/\d+",
                       base: str = "https://www.dicoding.com") -> DataFrame:
    """D3: hrefs matching a regex, absolutised; the first occurrence per url."""
    m = links(pages).filter(F.col("href").rlike(pattern))
    m = m.withColumn("link", absolutize_url("href", base))
    return dedup.first_per_key(m, "link", ["page_id", "item_pos"], keep=["link", "page_id", "item_pos"])


def pattern_census(pages: DataFrame, markers: Sequence[str] = CENSUS_MARKERS) -> DataFrame:
    """H1: per marker, pages with a hit and total hits."""
    per_page = F.array(*[F.struct(F.lit(m).alias("pattern"),
                                  F.regexp_count("html", F.lit(r"\Q" + m + r"\E")).alias("hits")) for m in markers])
    exploded = pages.select(F.explode(per_page).alias("c")).select("c.pattern", "c.hits")
    return exploded.groupBy("pattern").agg(F.count_if(F.col("hits") > 0).alias("pages_with_hits"),
                                           F.sum("hits").alias("total_hits"))


def extract_ld_json(pages: DataFrame) -> DataFrame:
    """H2: every JSON-LD block of every page."""
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(LD_JSON), 1)).alias("block_pos", "block"))


def json_items(block: Column) -> Column:
    """An object or a list of objects as an array of object texts."""
    b = py_strip(block)
    return F.when(b.startswith("["), F.from_json(b, "array<string>")).otherwise(F.array(b))


def ld_json_type_census(pages: DataFrame) -> DataFrame:
    """H3: ``@type`` values over all JSON-LD items."""
    items = extract_ld_json(pages).select(F.explode(json_items(F.col("block"))).alias("item"))
    return (items.select(F.get_json_object("item", "$['@type']").alias("ld_type"))
            .groupBy("ld_type").agg(F.count(F.lit(1)).alias("n_items")))


def has_next_data(html) -> Column:
    """H4: the page carries a ``__NEXT_DATA__`` script holding an object."""
    h = F.col(html) if isinstance(html, str) else html
    return h.rlike(NEXT_DATA_LITERAL)


def next_data_keys(pages: DataFrame) -> DataFrame:
    """H5: keys of ``props.pageProps`` and whether each is a list of job-like objects."""
    nd = pages.select("page_id", F.regexp_extract("html", NEXT_DATA, 1).alias("nd")).filter(F.col("nd") != "")
    props = nd.select("page_id", F.get_json_object("nd", "$.props.pageProps").alias("pp"))
    keys = props.select("page_id", F.explode(F.from_json("pp", "map<string,string>")).alias("key", "val"))
    val = F.col("val")
    first = F.get_json_object(val, "$[0]")
    first_keys = F.json_object_keys(first)
    job_like = (F.json_array_length(val) > 0) & first_keys.isNotNull() & (
        F.array_contains(first_keys, "title") | F.array_contains(first_keys, "id"))
    return keys.select("page_id", "key", F.coalesce(job_like, F.lit(False)).alias("job_like"),
                       F.json_array_length(val).alias("n_items"))


def link_harvest(pages: DataFrame, marker: str, samples: int) -> DataFrame:
    """H6: per page, the number of links containing ``marker`` and the first ``samples`` of them."""
    hits = F.filter(link_hrefs("html"), lambda h: h.contains(marker))
    return pages.select("page_id", F.size(hits).alias("n_links"), F.slice(hits, 1, samples).alias("samples"))


def detect_ats(pages: DataFrame) -> DataFrame:
    """H7: hosting vendors linked from each page (as written, in page order)."""
    return pages.select("page_id", F.regexp_extract_all("html", F.lit(ATS_LINK), 1).alias("vendors"))


def harvest_titles(pages: DataFrame, markers: Sequence[str] = ()) -> DataFrame:
    """H8: ``"title": "..."`` values of 5 to 50 characters, plus marker flags."""
    cols = [F.regexp_extract_all("html", F.lit(JSON_TITLE), 1).alias("titles")]
    cols += [F.col("html").contains(m).alias("has_" + "".join(ch if ch.isalnum() else "_" for ch in m))
             for m in markers]
    return pages.select("page_id", *cols)


def board_sizes(payloads: DataFrame, body: str = "body") -> DataFrame:
    """H9: postings per board payload: an object with ``jobs`` or a top-level list."""
    b = py_strip(F.col(body))
    n = F.when(b.startswith("["), F.json_array_length(b)).otherwise(
        F.json_array_length(F.get_json_object(b, "$.jobs")))
    return payloads.select("*", F.coalesce(n, F.lit(0)).alias("n_postings"))


def search_cards(pages: DataFrame, link_marker: str = "/id/job/", base: str = "https://id.jobstreet.com",
                 keep_linkless: bool = False) -> DataFrame:
    """Search-result cards split on ``<article``; link must contain ``link_marker``.

    Title from the card's link text, else its first heading; url cut at '?';
    company and location take their defaults; salary stays free text.
    """
    cards = pages.select("page_id", F.posexplode(F.split("html", "<article")).alias("card_idx", "card"))
    cards = cards.filter(F.col("card_idx") > 0)
    link = F.regexp_extract("card", r'href="([^"]*' + link_marker.replace("/", r"\/") + r'[^"]*)"', 1)
    heading = F.regexp_extract("card", r"(?s)<h[1-3][^>]*>(.*?)</h[1-3]>", 1)
    out = cards.select(
        "page_id", "card_idx",
        F.nullif(py_strip(F.regexp_replace(heading, "<[^>]+>", "")), F.lit("")).alias("job_title"),
        F.when(link != "", strip_query(absolutize_url(link, base))).alias("job_url"),
        F.lit("Private Advertiser").alias("company"),
        F.lit("Indonesia").alias("job_location"),
        F.lit("Full-time").alias("job_type"))
    return out if keep_linkless else out.filter(F.col("job_url").isNotNull())


def title_page(pages: DataFrame, suffix: str = TIA_SUFFIX, keep: dict | None = None) -> DataFrame:
    """Title and company from ``<title>X at Y - Tech in Asia</title>``; ``keep`` adds columns of the page, whose ``html`` is canonical markup."""
    pages = pages.withColumn("html", canonical_markup("html")).withColumn("_title", py_strip(title_text(F.col("html"))))
    t = F.col("_title")
    parts = F.split(t, " at ")
    both = t.contains(" at ") & t.contains(suffix)
    title = (F.when(both, py_strip(parts.getItem(0)))
             .when(t != "", py_strip(F.replace(t, F.lit(suffix), F.lit(""))))
             .otherwise(F.lit("N/A")))
    company = F.when(both, py_strip(F.replace(parts.getItem(1), F.lit(suffix), F.lit("")))).otherwise(F.lit("N/A"))
    return pages.select("page_id", F.col("url").alias("job_url"), title.alias("job_title"), company.alias("company"),
                        *[v.alias(k) for k, v in (keep or {}).items()])


def first_page_route(pages: DataFrame, marker: str = "/jobs/") -> DataFrame:
    """E7 on pages: marked links, else other links, else the title.

    The routes are arrays of one projection and the first that is not empty is
    exploded: one scan, no shuffle.
    """
    best = F.coalesce(*[F.when(F.size(r) > 0, F.col(r)) for r in ("r1", "r2", "r3")])
    return (page_routes(pages, marker).select("page_id", F.explode(best).alias("x"))
            .select("page_id", "x.route", "x.item_pos", "x.href"))


def page_routes(pages: DataFrame, marker: str) -> DataFrame:
    """Per page the items of its three routes (marked links, other links, the title) as arrays ``r1``, ``r2``, ``r3``."""
    found = pages.select("page_id", link_hrefs("html").alias("hrefs"), title_text(canonical_markup("html")).alias("title"))
    at = F.transform("hrefs", lambda h, i: F.struct(i.alias("item_pos"), h.alias("href")))
    found = found.select("page_id", "title", at.alias("all"))
    marked = F.filter("all", lambda x: x["href"].contains(marker))
    other = F.filter("all", lambda x: ~x["href"].contains(marker))
    title = F.array(F.struct(F.lit(0).alias("item_pos"), F.col("title").alias("href")))

    def numbered(items: Column, route: int) -> Column:
        return F.transform(items, lambda x: F.struct(F.lit(route).alias("route"), x["item_pos"].alias("item_pos"), x["href"].alias("href")))

    return found.select("page_id", *[numbered(r, k).alias(f"r{k}") for k, r in enumerate((marked, other, title), start=1)])


def new_page_route(pages: DataFrame, marker: str = "/jobs/") -> DataFrame:
    """E7 on pages with a running set: in page order, a page's first route with an item that no earlier page has emitted."""
    items = (page_routes(pages, marker).select("page_id", F.explode(F.flatten(F.array("r1", "r2", "r3"))).alias("x"))
             .select(F.lit("run").alias("run"), "page_id", "x.route", "x.item_pos", "x.href"))
    return dedup.first_new_route(items, page="page_id", url="href").drop("run")


def decoded_sql(x: str) -> str:
    """DuckDB: the references that the driver's pages hold, decoded."""
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{sign}')"
    return x


def hrefs_sql(html: str) -> str:
    """DuckDB: hrefs of links in any quotes, outside comments and scripts."""
    plain = f"regexp_replace(regexp_replace({html}, '(?s)<!--.*?-->', '', 'g'), '(?is)<(script|style)\\b.*?</(script|style)>', '', 'g')"
    values = f"""regexp_extract_all({plain}, '(?is)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>]+)', 1)"""
    return f"list_transform({values}, lambda v: {decoded_sql('trim(v, chr(34) || chr(39))')})"


def catalog() -> dict:
    """Registered page queries: name -> (spark query, DuckDB SQL or None)."""
    from ..plans import adapters as A

    def pg(spark, sf):
        return A.pages(spark, sf)

    list_sql = f"(SELECT page_id, url, {hrefs_sql('html')} AS l FROM pages)"
    link_sql = f"(SELECT page_id, url, unnest(l) AS href, CAST(unnest(range(len(l))) AS INTEGER) AS item_pos FROM {list_sql})"
    cen = " UNION ALL ".join(
        f"SELECT '{m}' AS pattern, (length(html) - length(replace(html, '{m}', ''))) // {len(m)} AS hits FROM pages"
        for m in CENSUS_MARKERS)
    routes_sql = (f"(SELECT page_id, 1 AS route, item_pos, href FROM {link_sql} WHERE contains(href, '/e')"
                  f" UNION ALL SELECT page_id, 2 AS route, item_pos, href FROM {link_sql} WHERE NOT contains(href, '/e')"
                  " UNION ALL SELECT page_id, 3 AS route, 0 AS item_pos, " + decoded_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)") + " AS href FROM pages)")
    return {
        "filter_links": (
            lambda s, sf: filter_links(pg(s, sf), marker="/t", exact_exclude="/the", banned=("search", "employers")),
            f"SELECT DISTINCT CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://www.techinasia.com' || href END AS link "
            f"FROM {link_sql} WHERE contains(href, '/t') AND href <> '/the' AND NOT contains(href, 'search') AND NOT contains(href, 'employers')"),
        "filter_url_pattern": (
            lambda s, sf: filter_url_pattern(pg(s, sf), pattern=r"^/[a-z]+$", base="https://www.dicoding.com"),
            f"SELECT link, page_id, item_pos FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, item_pos) AS rn FROM "
            f"(SELECT page_id, item_pos, 'https://www.dicoding.com' || href AS link FROM {link_sql} WHERE regexp_matches(href, '^/[a-z]+$'))) WHERE rn = 1"),
        "pattern_census": (
            lambda s, sf: pattern_census(pg(s, sf)),
            f"SELECT pattern, count(*) FILTER (WHERE hits > 0) AS pages_with_hits, CAST(sum(hits) AS BIGINT) AS total_hits FROM ({cen}) GROUP BY pattern"),
        "has_next_data": (
            lambda s, sf: pg(s, sf).select("page_id", has_next_data("html").alias("has_next_data")),
            "SELECT page_id, regexp_matches(html, '(?s)<script id=\"__NEXT_DATA__\" type=\"application/json\">(\\{.*?\\})</script>') AS has_next_data FROM pages"),
        "link_harvest": (
            lambda s, sf: link_harvest(pg(s, sf), marker="th", samples=3),
            "SELECT page_id, CAST(len(list_filter(l, lambda h: contains(h, 'th'))) AS INTEGER) AS n_links, "
            f"list_slice(list_filter(l, lambda h: contains(h, 'th')), 1, 3) AS samples FROM {list_sql}"),
        "detect_ats": (
            lambda s, sf: detect_ats(pg(s, sf)),
            "SELECT page_id, regexp_extract_all(html, '(?i)https?://[^\\s\"<>]*(" + "|".join(ATS_VENDORS)
            + ")[^\\s\"<>]*', 1) AS vendors FROM pages"),
        "harvest_titles": (
            lambda s, sf: harvest_titles(pg(s, sf), markers=["<article", "track("]),
            "SELECT page_id, regexp_extract_all(html, '\"title\"\\s*:\\s*\"([^\"]{5,50})\"', 1) AS titles, "
            "contains(html, '<article') AS has__article, contains(html, 'track(') AS has_track_ FROM pages"),
        "search_cards": (
            lambda s, sf: search_cards(pg(s, sf), keep_linkless=True).select("page_id", "card_idx", "job_title", "job_url", "company"),
            "SELECT page_id, card_idx, nullif(trim(regexp_replace(regexp_extract(card, '(?s)<h[1-3][^>]*>(.*?)</h[1-3]>', 1), '<[^>]+>', '', 'g')), '') AS job_title, "
            "CAST(NULL AS VARCHAR) AS job_url, 'Private Advertiser' AS company FROM "
            "(SELECT page_id, unnest(parts[2:]) AS card, CAST(unnest(range(1, len(parts))) AS INTEGER) AS card_idx FROM "
            "(SELECT page_id, string_split(html, '<article') AS parts FROM pages))"),
        "title_page": (
            lambda s, sf: title_page(pg(s, sf)),
            "SELECT page_id, url AS job_url, CASE WHEN contains(t, ' at ') AND contains(t, ' - Tech in Asia') THEN trim(split_part(t, ' at ', 1)) "
            "WHEN t <> '' THEN trim(replace(t, ' - Tech in Asia', '')) ELSE 'N/A' END AS job_title, "
            "CASE WHEN contains(t, ' at ') AND contains(t, ' - Tech in Asia') THEN trim(replace(split_part(t, ' at ', 2), ' - Tech in Asia', '')) ELSE 'N/A' END AS company "
            "FROM (SELECT page_id, url, trim(" + decoded_sql("coalesce(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '')") + ") AS t FROM pages)"),
        "first_nonempty_route": (
            lambda s, sf: first_page_route(pg(s, sf), marker="/e"),
            f"SELECT page_id, route, item_pos, href FROM (SELECT *, min(route) OVER (PARTITION BY page_id) AS best FROM {routes_sql}) WHERE route = best"),
        "first_new_route": (
            lambda s, sf: new_page_route(pg(s, sf), marker="/e"),
            "WITH RECURSIVE items AS " + routes_sql + """, l AS (
              SELECT page_id, row_number() OVER (ORDER BY page_id) AS n, coalesce(list(href ORDER BY item_pos) FILTER (WHERE route = 1), []) AS r1,
                     coalesce(list(href ORDER BY item_pos) FILTER (WHERE route = 2), []) AS r2, coalesce(list(href ORDER BY item_pos) FILTER (WHERE route = 3), []) AS r3
              FROM items GROUP BY page_id
            ), walk AS (
              SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS seen, 0 AS route, CAST([] AS VARCHAR[]) AS got
              UNION ALL
              SELECT n, list_concat(seen, got), route, got FROM (
                SELECT n, seen, CASE WHEN len(f1) > 0 THEN 1 WHEN len(f2) > 0 THEN 2 ELSE 3 END AS route,
                       CASE WHEN len(f1) > 0 THEN f1 WHEN len(f2) > 0 THEN f2 ELSE f3 END AS got
                FROM (SELECT l.n, seen, list_filter(r1, lambda x: NOT list_contains(seen, x)) AS f1,
                             list_filter(r2, lambda x: NOT list_contains(seen, x)) AS f2, list_filter(r3, lambda x: NOT list_contains(seen, x)) AS f3
                      FROM walk JOIN l ON l.n = walk.n + 1))
            )
            SELECT l.page_id, i.route, min(i.item_pos) AS item_pos, i.href
            FROM walk JOIN l USING (n) JOIN items i ON i.page_id = l.page_id AND i.route = walk.route
            WHERE list_contains(got, i.href) GROUP BY ALL"""),
        "exclude_seen": (
            lambda s, sf: dedup.exclude_seen(links(pg(s, sf)).select("page_id", "item_pos", "href"), key="href",
                                             order=["page_id", "item_pos"]),
            f"SELECT page_id, item_pos, href FROM (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, item_pos) AS rn FROM {link_sql}) WHERE rn = 1"),
    }
