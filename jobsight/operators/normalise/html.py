"""HTML pages to job and course records.

Pages are rows of a ``pages``-shaped table (page_id, url, html).  Embedded
JSON (JSON-LD, ``__NEXT_DATA__``, Apollo state) is cut out with a regex and
read with the JSON functions; card markup is brought into its canonical spelling
(``functions.markup``), then split and read with regexes, and texts are decoded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.dates import iso_or_now
from ...functions.markup import canonical_markup, decode_references, let
from ...functions.text import absolutize_url, clean_string, is_falsy, py_strip
from ...schemas import COURSE_RECORD
from ..pages import LD_JSON, NEXT_DATA, json_items, title_page
from .base import course_record, emit, item_fields, jget, job_record

JOBSTREET = "https://id.jobstreet.com"


def _pages_order(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("page_id", "seq")


def normalise_ld_json(pages: DataFrame, now: Column, desc_chars: int | None = None) -> DataFrame:
    """JSON-LD ``JobPosting`` items (object or list); items without url dropped.

    The whole description is kept; ``desc_chars=300`` cuts it as the original
    crawler does, so that later text reaches no skill.
    """
    blocks = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(LD_JSON), 1)).alias("block_pos", "block"))
    # parsed once, inside the exploded array, where the filter cannot repeat it
    items = blocks.select("page_id", "block_pos", F.posexplode(F.transform(
        json_items(F.col("block")), lambda x: item_fields(x, *LD_FIELDS))).alias("item_pos", "j"))
    j = lambda f: F.col(f"j.`{f}`")
    items = items.filter((j("@type") == "JobPosting") & ~is_falsy(j("url")))
    loc_obj = j("jobLocation")
    is_list = F.coalesce(py_strip(loc_obj).startswith("["), F.lit(False))
    location = F.when(is_list, F.coalesce(jget(loc_obj, "$[0].address.addressLocality"), F.lit("Indonesia"))).otherwise(
        F.coalesce(F.nullif(jget(loc_obj, "$.address.addressLocality"), F.lit("")),
                   F.nullif(jget(loc_obj, "$.address.addressRegion"), F.lit("")), F.lit("Indonesia")))
    posted = j("datePosted")
    desc = F.coalesce(j("description"), F.lit(""))
    rec = job_record(
        now, job_title=clean_string(F.coalesce(j("title"), F.lit("N/A"))),
        job_location=clean_string(location), job_department=F.lit("N/A"), job_url=j("url"),
        job_type=F.coalesce(j("employmentType"), F.lit("Full-time")),
        last_seen=F.when(is_falsy(posted), now).otherwise(iso_or_now(posted, now)),
        job_apply_end_date=iso_or_now(j("validThrough"), now),
        company=clean_string(F.coalesce(jget(j("hiringOrganization"), "$.name"), F.lit("Private Advertiser"))),
        job_board=F.lit("Jobstreet"), job_board_url=F.lit(JOBSTREET), work_arrangement=F.lit("On-site"),
        desc=clean_string(desc if desc_chars is None else F.substring(desc, 1, desc_chars)))
    return emit(items, {"source": F.lit("jobstreet"), "seq": F.col("page_id"),
                        "block_pos": F.col("block_pos"), "item_pos": F.col("item_pos")}, rec)


LD_FIELDS = ("@type", "url", "title", "datePosted", "validThrough", "employmentType", "description", "hiringOrganization",
             "jobLocation")


def normalise_next_data(pages: DataFrame, now: Column) -> DataFrame:
    """``__NEXT_DATA__`` jobs at the first non-empty of three paths."""
    nd = pages.select("page_id", F.regexp_extract("html", NEXT_DATA, 1).alias("nd")).filter(F.col("nd") != "")
    paths = ["$.props.pageProps.initialCandidateExperimentalData.jobs", "$.props.pageProps.jobs",
             "$.props.pageProps.searchResults.jobs"]
    # each candidate list is parsed once, as its own column, then the first non-empty wins
    nd = nd.select("page_id", *[F.from_json(F.get_json_object("nd", p), "array<string>").alias(f"_a{k}")
                                for k, p in enumerate(paths)])
    jobs = F.coalesce(*[F.when(F.size(f"_a{k}") > 0, F.col(f"_a{k}")) for k in range(len(paths))])
    # parsed once, inside the exploded array, where the filter cannot repeat it
    parsed = F.transform(F.coalesce(jobs, F.array().cast("array<string>")),
                         lambda x: F.struct(x.startswith("{").alias("is_obj"), F.from_json(x, NEXT_ITEM).alias("j")))
    items = nd.select("page_id", F.posexplode(parsed).alias("item_pos", "x")).select("page_id", "item_pos", "x.is_obj", "x.j")
    j = lambda f: F.col(f"j.{f}")
    url = F.coalesce(F.nullif(j("jobUrl"), F.lit("")), j("url"), F.lit(""))
    items = items.filter(F.col("is_obj") & (url != ""))
    url = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(JOBSTREET), url))
    loc_raw = F.coalesce(F.nullif(j("location"), F.lit("")), F.nullif(j("locationDescription"), F.lit("")),
                         F.lit("Indonesia"))
    loc = F.when(loc_raw.startswith("{"), F.coalesce(F.nullif(jget(loc_raw, "$.label"), F.lit("")),
                                                      jget(loc_raw, "$.name"), F.lit("Indonesia"))).otherwise(loc_raw)
    filled = lambda c: F.when(~c.isin("", "{}", "[]", "null", "false", "0"), c)
    cats = F.coalesce(filled(j("classification")), filled(j("categories")))
    dept = (F.when(cats.startswith("{"), F.coalesce(jget(cats, "$.description"), F.lit("N/A")))
            .when(cats.startswith("["), F.coalesce(jget(cats, "$[0].name"), F.lit("N/A"))).otherwise(F.lit("N/A")))
    title = clean_string(F.coalesce(F.nullif(j("title"), F.lit("")), F.nullif(j("jobTitle"), F.lit("")), F.lit("N/A")))
    posted = F.coalesce(F.nullif(j("listingDate"), F.lit("")), j("postedAt"))
    rec = job_record(
        now, job_title=title, job_location=clean_string(loc), job_department=clean_string(dept), job_url=url,
        job_type=F.lit("Full-time"), last_seen=F.when(is_falsy(posted), now).otherwise(iso_or_now(posted, now)),
        job_apply_end_date=iso_or_now(j("expiryDate"), now),
        company=clean_string(F.coalesce(jget(j("advertiser"), "$.description"), F.lit("Private Advertiser"))),
        job_board=F.lit("Jobstreet"), job_board_url=F.lit(JOBSTREET), work_arrangement=F.lit("On-site"),
        desc=F.concat_ws(" ", title, dept))
    return emit(items, {"source": F.lit("jobstreet"), "seq": F.col("page_id"), "item_pos": F.col("item_pos")}, rec)


NEXT_ITEM = ("jobUrl string, url string, title string, jobTitle string, advertiser string, location string, "
             "locationDescription string, classification string, categories string, listingDate string, "
             "postedAt string, expiryDate string")

APOLLO = r"(?s)window\.__APOLLO_STATE__\s*=\s*(\{.*?\});\s*(?:window\.|</script>)"


def normalise_apollo(pages: DataFrame, now: Column, base: str = "https://www.coursera.org") -> DataFrame:
    """Apollo state map values whose ``__typename`` is ``Search_ProductHit``."""
    st = pages.select("page_id", F.from_json(F.regexp_extract("html", APOLLO, 1), "map<string,string>").alias("m"))
    hits = st.select("page_id", F.explode(F.coalesce(F.map_values("m"), F.array().cast("array<string>"))).alias("v"))
    hits = hits.filter(jget(F.col("v"), "$.__typename") == "Search_ProductHit")
    v = F.col("v")
    skills = F.from_json(jget(v, "$.skills"), "array<string>")
    url = F.coalesce(jget(v, "$.url"), F.lit(""))
    rec = course_record(
        now, course_title=jget(v, "$.name"),
        desc=F.when(F.size(skills) > 0, F.array_join(skills, ", ")).otherwise(F.coalesce(jget(v, "$.tagline"), F.lit(""))),
        platform=F.lit("Coursera"),
        url=F.when((url == "") | url.startswith("http"), url).otherwise(F.concat(F.lit(base), url)))
    return hits.select(F.lit("coursera").alias("source"), F.col("page_id").alias("seq"), *rec)


def _canonical(pages: DataFrame) -> DataFrame:
    return pages.withColumn("html", canonical_markup("html"))


def _text(c: Column, pattern: str, group: int = 1) -> Column:
    """A decoded text or attribute value of canonical markup, empty if there is none."""
    return decode_references(F.regexp_extract(c, pattern, group))


HREF = r' href="([^"]*)"'


def _attr_text(card: Column, cls: str) -> Column:
    t = _text(card, r'(?s) class="[^"]*' + cls + r'[^"]*"[^>]*>([^<]*)<')
    return F.coalesce(F.nullif(py_strip(t), F.lit("")), F.lit("N/A"))


def normalise_course_cards(pages: DataFrame, now: Column, pattern: str = r"/academies/\d+",
                           base: str = "https://www.dicoding.com", platform: str = "Dicoding") -> DataFrame:
    """Anchors whose href matches ``pattern``; first card per url; 4 attributes."""
    anchors = _canonical(pages).select("page_id", F.posexplode(F.regexp_extract_all(
        "html", F.lit(r'(?s)(<a(?: [^>]*?)? href="[^"]*"[^>]*>.*?</a>)'), 1)).alias("item_pos", "card"))
    href = _text(F.col("card"), HREF)
    anchors = anchors.withColumn("href", href).filter(F.col("href").rlike(pattern))
    anchors = anchors.withColumn("url", absolutize_url("href", base))
    from ..dedup import first_per_key
    first = first_per_key(anchors, "url", ["page_id", "item_pos"])
    c = F.col("card")
    title = _text(c, r"(?s)<(?:h5|strong)(?: [^>]*)?>([^<]*)<")
    rec = course_record(
        now, course_title=F.coalesce(F.nullif(py_strip(title), F.lit("")), F.lit("N/A")),
        desc=py_strip(_text(c, r"(?s)<p(?: [^>]*)?>([^<]*)<")),
        level=_attr_text(c, "level"), duration=_attr_text(c, "duration"), rating=_attr_text(c, "rating"),
        students=_attr_text(c, "student"), platform=F.lit(platform), url=F.col("url"))
    return first.select(F.lit(platform.lower()).alias("source"), F.col("page_id").alias("seq"), "item_pos", *rec)


def static_catalogue(spark: SparkSession, rows: Sequence[dict], now: str, platform: str = "Dicoding") -> DataFrame:
    """A caller-supplied fallback course table used when the live page failed."""
    df = spark.createDataFrame([tuple(r.get(f) for f in COURSE_RECORD.fieldNames()) for r in rows], COURSE_RECORD)
    return df.withColumn("platform", F.lit(platform)).withColumn("scraped_at", F.lit(now))


def normalise_job_cards(pages: DataFrame, now: Column, link_marker: str, base: str, company: str,
                        board: str) -> DataFrame:
    """B6 / B8 generic form: anchors whose href contains ``link_marker``."""
    anchors = _canonical(pages).select("page_id", F.posexplode(F.regexp_extract_all(
        "html", F.lit(r'(?s)(<a(?: [^>]*?)? href="[^"]*' + link_marker + r'[^"]*"[^>]*>.*?</a>)'), 1)).alias("item_pos", "card"))
    c = F.col("card")
    href = _text(c, HREF)
    title = py_strip(decode_references(F.regexp_replace(F.regexp_replace(c, r"^<a\b[^>]*>|</a>$", ""), r"<[^>]+>", " ")))
    title = F.regexp_replace(title, r"\s+", " ")
    out = anchors.select("page_id", "item_pos", absolutize_url(href, base).alias("url"), title.alias("title"))
    out = out.filter((F.col("url") != base) & (F.col("title") != ""))
    rec = job_record(now, job_title=F.col("title"), job_location=F.lit("Indonesia"), job_department=F.lit("N/A"),
                     job_url=F.col("url"), job_type=F.lit("Full-time"), company=F.lit(company),
                     job_board=F.lit(board), work_arrangement=F.lit("On-site"),
                     desc=F.concat_ws(" ", F.col("title"), F.lit("N/A")))
    return emit(out, {"source": F.lit(company.lower()), "seq": F.col("page_id"), "item_pos": F.col("item_pos")}, rec)


def _first_text(card: Column, patterns: Sequence[str]) -> Column:
    """Text of the first element in the card that any pattern matches, as in a CSS ``a, b, c::text`` group.

    The patterns are tried together at each place, so document order decides.
    """
    every = "|".join(f"(?:{p})" for p in patterns)
    inner = lambda found: F.coalesce(*[F.nullif(F.regexp_extract(found, p, 1), F.lit("")) for p in patterns])
    return let(F.regexp_extract(card, every, 0), lambda found: F.when(found != "", decode_references(inner(found))))


def cards_by_cascade(pages: DataFrame, routes: Sequence[str], read) -> DataFrame:
    """Cards of the first route that finds any on a page (selector cascade), as the columns that ``read`` makes of a card.

    A route is a regex, on canonical markup, for the start of a card element.  The page is split in
    front of every match; a card then ends at its own closing tag (see
    ``own_element``), so nothing behind it, on a page's last card the footer,
    counts as the card's.  All routes are evaluated in one projection of the
    page and the first non-empty one wins: one scan, no shuffle.
    """
    # a leading marker keeps the text before the first card as element 1 even
    # when the page starts with a card (a split never yields a leading empty
    # string for a zero-width match)
    pages = _canonical(pages)
    page = F.concat(F.lit("\u0001"), F.col("html"))
    parts = [F.slice(F.split(page, "(?=" + r + ")"), 2, 1 << 30) for r in routes]
    hits = [F.when(F.col("html").rlike(r), a) for r, a in zip(routes, parts)]
    chosen = F.coalesce(*hits, F.array().cast("array<string>"))
    # cut to their own tag and read inside the array: a filter behind the explode cannot repeat that work
    fields = lambda card: F.struct(*[v.alias(k) for k, v in read(card).items()])
    cards = F.transform(chosen, lambda x: let(own_element(x), fields))
    return pages.select("page_id", F.posexplode(cards).alias("item_pos", "card")).select("page_id", "item_pos", "card.*")


#: Elements that cards are.
CARD_TAGS = ("div", "li", "a", "article")


def own_element(markup: Column) -> Column:
    """The element that ``markup`` (canonical) starts with, one of ``CARD_TAGS``, up to its closing tag (all of it if there is none).

    The pieces between tags of the element's name are counted up and down; the
    first piece after which the count is zero ends the element.
    """
    step = lambda p: F.when(p.startswith("</"), -1).when(p.startswith("<"), 1).otherwise(0)

    def cut(pieces: Column, ended: Column) -> Column:
        whole = F.concat(F.array_join(F.slice(pieces, 1, ended - 1), ""),
                         F.regexp_extract(F.element_at(pieces, ended), r"^</[^>]*>?", 0))
        return F.when(ended > 0, whole).otherwise(markup)

    def ends(pieces: Column) -> Column:
        return F.aggregate(
            pieces, F.struct(F.lit(0).alias("open"), F.lit(0).alias("seen"), F.lit(0).alias("end")),
            lambda a, p: F.struct((a["open"] + step(p)).alias("open"), (a["seen"] + 1).alias("seen"),
                                  F.when((a["end"] == 0) & (a["open"] + step(p) == 0), a["seen"] + 1).otherwise(a["end"]).alias("end")),
            lambda a: a["end"])

    def counted(tag: str) -> Column:
        return let(F.split(markup, f"(?=</?{tag}[ >])"), lambda pieces: let(ends(pieces), lambda ended: cut(pieces, ended)))

    def element(tag: str) -> Column:
        """Up to the first closing tag where no element of the name opens before it, else by counting."""
        close = f"</{tag}>"
        inner = F.substring_index(F.substring(markup, 2, 1 << 30), close, 1)
        plain = F.contains(markup, F.lit(close)) & ~F.contains(inner, F.lit(f"<{tag} ")) & ~F.contains(inner, F.lit(f"<{tag}>"))
        return F.when(plain, F.concat(F.substring_index(markup, close, 1), F.lit(close))).otherwise(counted(tag))

    return F.coalesce(*[F.when(markup.startswith(f"<{tag} ") | markup.startswith(f"<{tag}>"), element(tag)) for tag in CARD_TAGS], markup)


# Selector cascades of the two career pages, as regexes for card starts and
# for the text of each field (first hit wins, like a CSS selector list).
VIDIO_ROUTES = [r'<div[^>]*class="[^"]*b-job[^"]*"[^>]*>\s*<a\b', r'<div[^>]*class="career-item[ "][^>]*>\s*<a\b',
                r'<li[^>]*class="job-item[ "][^>]*>\s*<a\b', r'<a\b[^>]*href="[^"]*/careers/',
                r'<div[^>]*class="[^"]*job[^"]*"[^>]*>\s*<h3\b', r'<(?:div|li)[^>]*class="[^"]*job[^"]*"[^>]*>']
VIDIO_TITLE = [r'class="[^"]*(?:b-job__name|job-title)[^"]*"[^>]*>([^<]+)<', r"<h3[^>]*>([^<]+)<", r"<h2[^>]*>([^<]+)<"]
VIDIO_LOCATION = [r'class="[^"]*(?:b-job__location|location)[^"]*"[^>]*>([^<]+)<', r"<span[^>]*>([^<]+)<"]
VIDIO_DEPARTMENT = [r'class="[^"]*(?:b-job__department|department)[^"]*"[^>]*>([^<]+)<']
TRAKSTAR_ROUTES = [r'<div[^>]*class="js-card list-item[ "]', r'<div[^>]*class="job-card[ "]', r'<li[^>]*class="opening[ "]',
                   r'<a\b[^>]*href="[^"]*job']
TRAKSTAR_TITLE = [r'<h3[^>]*class="js-job-list-opening-name[^"]*"[^>]*>([^<]+)<', r"<h3[^>]*>([^<]+)<",
                  r"<h2[^>]*>([^<]+)<"]
TRAKSTAR_LOCATION = [r'class="js-job-list-opening-loc[^"]*"[^>]*>([^<]+)<', r'class="[^"]*location[^"]*"[^>]*>([^<]+)<']
TRAKSTAR_DEPARTMENT = [r'class="rb-text-4[^"]*"[^>]*>([^<]+)<', r'class="[^"]*department[^"]*"[^>]*>([^<]+)<']
TRAKSTAR_TYPE = [r'class="js-job-list-opening-meta[^"]*"[^>]*>\s*<span[^>]*>([^<]+)<', r'class="[^"]*\btype\b[^"]*"[^>]*>([^<]+)<']
TRAKSTAR_SETUP = [r'class="js-job-list-opening-meta[^"]*"[^>]*>(?:\s*<span[^>]*>[^<]*</span>)*?\s*<span[^>]*>([^<]+)</span>\s*</div>']


#: The first text of a card, where no selector of a field has any.
ANY_TEXT = r">([^<]+)<"


def _sanitize(c: Column) -> Column:
    """White space collapsed; an empty text becomes 'N/A'."""
    return F.when(is_falsy(c), F.lit("N/A")).otherwise(F.regexp_replace(py_strip(c), r"(?U)[\s\x1c-\x1f]+", " "))


def _on_site(href: Column, base: str) -> Column:
    """A card's href as an absolute url, empty if there is none."""
    return let(href, lambda h: F.when(h.startswith("http"), h).when(h != "", F.concat(F.lit(base), h)).otherwise(F.lit("")))


def normalise_vidio_cards(pages: DataFrame, now: Column, base: str = "https://www.vidio.com") -> DataFrame:
    """Vidio careers cards; no url, no title or a title of 'N/A' drops the card."""
    cards = cards_by_cascade(pages, VIDIO_ROUTES, lambda c: {
        "_t": F.coalesce(_first_text(c, VIDIO_TITLE), _first_text(c, [ANY_TEXT]), F.lit("N/A")),
        "_u": _on_site(_text(c, HREF), base), "_dept": F.coalesce(_first_text(c, VIDIO_DEPARTMENT), F.lit("N/A")),
        "_loc": F.coalesce(_first_text(c, VIDIO_LOCATION), F.lit("Indonesia"))})
    cards = cards.filter((F.col("_u") != "") & (F.col("_t") != "N/A"))
    dept = F.col("_dept")
    rec = job_record(
        now, job_title=_sanitize(F.col("_t")), job_location=_sanitize(F.col("_loc")),
        job_department=_sanitize(dept), job_url=F.col("_u"), job_type=F.lit("Full-time"), company=F.lit("Vidio"),
        company_url=F.lit(base), job_board=F.lit("Vidio Careers"), work_arrangement=F.lit("On-site"),
        desc=F.concat_ws(" ", F.col("_t"), dept))
    return emit(cards, {"source": F.lit("vidio"), "seq": F.col("page_id"), "item_pos": F.col("item_pos")}, rec)


def normalise_trakstar_cards(pages: DataFrame, now: Column, base: str = "https://mekari.hire.trakstar.com") -> DataFrame:
    """Trakstar opening cards; per-field selector fallbacks; no href drops the card."""
    cards = cards_by_cascade(pages, TRAKSTAR_ROUTES, lambda c: {
        "_u": _on_site(_text(c, r'<a(?: [^>]*?)? href="([^"]*)"'), base),
        "_t": F.coalesce(_first_text(c, TRAKSTAR_TITLE), _first_text(c, [ANY_TEXT]), F.lit("N/A")),
        "_dept": F.coalesce(_first_text(c, TRAKSTAR_DEPARTMENT), F.lit("N/A")),
        "_type": F.coalesce(_first_text(c, TRAKSTAR_TYPE), F.lit("Full-time")),
        "_loc": F.coalesce(_first_text(c, TRAKSTAR_LOCATION), F.lit("Indonesia")),
        "_setup": F.coalesce(_first_text(c, TRAKSTAR_SETUP), F.lit("On-site"))}).filter(F.col("_u") != "")
    title, dept, jtype = F.col("_t"), F.col("_dept"), F.col("_type")
    san = lambda x: F.coalesce(F.nullif(_sanitize(x), F.lit("")), F.lit("N/A"))
    rec = job_record(
        now, job_title=san(title), job_location=san(F.col("_loc")),
        job_department=san(dept), job_url=F.col("_u"), job_type=san(jtype), company=F.lit("Mekari"),
        job_board=F.lit("Mekari Careers"),
        work_arrangement=san(F.col("_setup")),
        desc=F.concat_ws(" ", title, dept, jtype))
    return emit(cards, {"source": F.lit("mekari"), "seq": F.col("page_id"), "item_pos": F.col("item_pos")}, rec)


# Selectors of a search-result card, as regexes.
SEARCH_ROUTES = [r'<article\b[^>]*data-testid="job-card"', r"<article\b"]
CARD_LINK = r'(?s)<a(?: [^>]*?)? href="(?=[^"]*/id/job/)(?=[^"]*cardTitle)([^"]*)"[^>]*>(.*?)</a>'
ANY_LINK = r'(?s)<a(?: [^>]*?)? href="([^"]*/id/job/[^"]*)"[^>]*>(.*?)</a>'
CARD_HEADING = [r"<h3[^>]*>([^<]+)", r"<h2[^>]*>([^<]+)", r'<[a-z0-9]+[^>]*data-automation="jobTitle"[^>]*>([^<]+)']
FIRST_TEXT = r"(?s)(?:^|>)([^<]+)"


def _automation(card: Column, name: str) -> Column:
    return let(_text(card, r'<[a-z0-9]+[^>]* data-automation="' + name + r'"[^>]*>([^<]+)'), lambda t: F.when(t != "", t))


def _span_class(card: Column, name: str) -> Column:
    return let(_text(card, r'<span[^>]* class="[^"]*' + name + r'[^"]*"[^>]*>([^<]+)'), lambda t: F.when(t != "", t))


def normalise_search_cards(pages: DataFrame, now: Column, base: str = JOBSTREET) -> DataFrame:
    """Search-result cards (``job-card`` articles, else any) to the 18-field record.

    The link is the one that mentions ``cardTitle``, else the first job link; a
    card without one is dropped.  The title is the link's first text, else the
    first heading.  Company, location and salary come from the card.
    """
    def read(c: Column) -> dict:
        link = let(F.regexp_extract(c, CARD_LINK, 0), lambda x: F.when(x != "", x).otherwise(F.regexp_extract(c, ANY_LINK, 0)))
        in_link = lambda x: F.struct(
            F.when(x != "", F.coalesce(F.nullif(_text(x, CARD_LINK), F.lit("")), _text(x, ANY_LINK))).alias("href"),
            py_strip(_text(F.regexp_extract(x, ANY_LINK, 2), FIRST_TEXT)).alias("text"))
        return {"link": let(link, in_link), "heading": _first_text(c, CARD_HEADING),
                "company": F.coalesce(_automation(c, "jobCompany"), _span_class(c, "company"), F.lit("Private Advertiser")),
                "place": F.coalesce(_automation(c, "jobLocation"), _span_class(c, "location"), F.lit("Indonesia")),
                "pay": F.coalesce(_automation(c, "jobSalary"), F.lit("0"))}

    cards = cards_by_cascade(pages, SEARCH_ROUTES, read).filter(F.col("link.href").isNotNull())
    href = F.col("link.href")
    title = F.coalesce(F.nullif(F.col("link.text"), F.lit("")), F.col("heading"), F.lit("N/A"))
    cards = cards.withColumns({
        "_url": F.substring_index(F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href)), "?", 1),
        "_title": clean_string(title), "_company": clean_string("company"), "_location": clean_string("place")})
    rec = job_record(
        now, job_title=F.col("_title"), job_location=F.col("_location"), job_department=F.lit("N/A"), job_url=F.col("_url"),
        base_salary=F.col("pay"), job_type=F.lit("Full-time"), job_apply_end_date=now,
        company=F.col("_company"), job_board=F.lit("Jobstreet"), job_board_url=F.lit(base), work_arrangement=F.lit("On-site"),
        job_age=F.lit("0"), desc=F.concat_ws(" ", "_title", "_company"))
    return emit(cards, {"source": F.lit("jobstreet"), "seq": F.col("page_id"), "item_pos": F.col("item_pos")}, rec)


def page_texts(markup: Column) -> Column:
    """Of canonical markup the texts inside paragraphs and directly in spans, decoded, stripped, in page order, joined by a space."""
    pieces = F.regexp_extract_all(markup, F.lit(r"(?s)<p[ >].*?</p>|<span(?: [^>]*)?>[^<]*"), F.lit(0))
    nodes = F.flatten(F.transform(pieces, lambda x: F.split(F.regexp_replace(x, r"(?s)<[^>]*>", "\u0001"), "\u0001")))
    return F.array_join(F.filter(F.transform(nodes, lambda t: py_strip(decode_references(t))), lambda t: t != ""), " ")


def normalise_title_page(pages: DataFrame, now: Column) -> DataFrame:
    """A posting's own page: title and company from ``<title>``, the description from its texts."""
    read = title_page(pages, keep={"_desc": page_texts(F.col("html"))})
    rec = job_record(
        now, job_title=F.col("job_title"), job_location=F.lit("N/A"), job_department=F.lit("N/A"), job_url=F.col("job_url"),
        job_type=F.lit("N/A"), company=F.col("company"), company_url=F.lit(""), job_board=F.lit("Tech in Asia Jobs"),
        job_board_url=F.lit("https://www.techinasia.com/jobs"), work_arrangement=F.lit("N/A"), job_age=F.lit("0"),
        desc=F.col("_desc"))
    return emit(read, {"source": F.lit("techinasia"), "seq": F.col("page_id"), "item_pos": F.lit(0)}, rec)
