"""Main text of pages: templates, broken markup, and the article element of the given pages."""

import html
import re

import pytest

from jobsight.llm.html_text import extract_pages, main_text

PARA = "A paragraph of the story, with commas, a full stop. And one more sentence that makes it long enough."
SHELL = ("<html><head><title>T</title><style>p{{}}</style></head><body><header>Site head, line.</header><nav><a href=x>Home</a></nav>"
         "<div class='cookie-notice'>We use cookies, a lot. Accept, please, all of them, now. It is a long notice, is it not?</div>"
         "{}<aside>Side, bar. Text.</aside><form>Sign up, now.<input></form><section class='comments'><article><p>First! A comment, "
         "long enough to be read, by anyone who comments.</p></article></section><footer>&copy; us</footer><script>var a='<p>x';</script></body></html>")
CASES = [
    ("<article><h1>Head</h1><p>" + PARA + "<p>In.</p></article>", f"Head {PARA} In."),
    ("<article><h1>A&amp;B</h1><p><b>" + PARA + "<br>next</p><!-- no --><div class=ad>Buy, now.</div><p>last&nbsp;one</p></article>",
     f"A&B {PARA} next last one"),
    ("<main><p>" + PARA + "</p><ul><li>one</li><li>two</li></ul><table><tr><td>a<td>b</table></main>", f"{PARA} one two a b"),
    ("<div id=story><h2>Head</h2><p>" + PARA + "</p><p>" + PARA + "</p><p>Short.</p></div>", f"Head {PARA} {PARA} Short."),
    ("<article><p>wo<i>rd</i>s &lt;b&gt; 1 < 2</p><p>" + PARA + "</p></article>", f"words <b> 1 < 2 {PARA}"),
]


@pytest.mark.parametrize("body,want", CASES)
def test_templates(body, want):
    assert main_text(SHELL.format(body)) == want


WHOLE = [
    (f"<article><h1>Head</h1><div class=body><p>{PARA}</p><p>{PARA}</p></div><ul><li>one</li><li>two</li></ul><div>End.</div></article>",
     f"Head {PARA} {PARA} one two End."),
    (f"<main><h1>Head</h1><p>{PARA}<br>{PARA}</p><h2>Tail</h2></main>", f"Head {PARA} {PARA} Tail"),
    (f"<div id=story><h2>Head</h2><p>{PARA}<br>{PARA}</p></div>", f"Head {PARA} {PARA}"),
]


@pytest.mark.parametrize("body,want", WHOLE)
def test_region_is_the_whole_article(body, want):
    assert main_text(SHELL.format(body)) == want


CARD = "<article class=card><h3>Other</h3><p>A teaser, short.</p></article>"
STORY = f"<div class=entry><h1>Head</h1><p>{PARA}</p><p>{PARA}</p><p>{PARA}</p></div>"
PLACES = [
    (STORY + 3 * CARD, f"Head {PARA} {PARA} {PARA}"),
    (3 * CARD + STORY, f"Head {PARA} {PARA} {PARA}"),
    (f"<article><h1>One</h1><p>{PARA}</p></article><article><h1>Two</h1><p>{PARA}</p></article>", f"One {PARA} Two {PARA}"),
    (STORY + f"<article><h1>Two</h1><p>{PARA}</p></article>", f"Head {PARA} {PARA} {PARA} Two {PARA}"),
    (f"<div>{PARA}</div><article>{PARA} {PARA}</article>", f"{PARA} {PARA}"),
    (f"<div>{5 * PARA}</div><article>" + 5 * f"<p>{PARA}</p>" + "<p>End.</p></article>", " ".join(5 * [PARA]) + " End."),
    (f"<div><p>{PARA}</p></div><main><h1>Two</h1><p>{PARA}</p><p>{PARA}</p></main>", f"Two {PARA} {PARA}"),
]


@pytest.mark.parametrize("body,want", PLACES)
def test_teasers_do_not_displace_the_story(body, want):
    assert main_text(SHELL.format(body)) == want


ARTICLE = f"<article><h1>Head</h1><p>{PARA}</p><p>{PARA}</p></article>"
MARKED = [
    *((f"<{tag}>{ARTICLE}<div class=ad>Buy.</div></{tag.split()[0]}>", f"Head {PARA} {PARA}") for tag in (
        "div class='layout has-sidebar'", "div id='page-widget'", "div class='content-with-sidebar'", "form id=page",
        "div class=modal")),
    (f"<article><p>{PARA}</p><p class='notice-period'>Two weeks.</p><div class='related-work'>Others did, too.</div><p class=notice>Note.</p>"
     f"<div class='share-buttons'>Share, now.</div><p class=ad>Buy.</p><form>Sign up.</form></article>",
     f"{PARA} Two weeks. Others did, too. Note."),
    (f"<div class='layout has-sidebar'><div class=post><h1>Head</h1><p>{PARA}</p><p>{PARA}</p></div><div class=sidebar>More.</div></div>",
     f"Head {PARA} {PARA}"),
    (f"<article><h1>Head</h1><div class=widget><p>{PARA}</p></div><div class=ad>Buy.</div></article>", f"Head {PARA}"),
    (ARTICLE + f"<div class=comments>{3 * f'<p>{PARA}</p>'}</div>", f"Head {PARA} {PARA}"),
    (f"<h1>Head</h1><p>{PARA}</p><p>{PARA}</p><div class=comments><p>First, {PARA}</p><div>Second, it is.</div></div>", f"Head {PARA} {PARA}"),
]


@pytest.mark.parametrize("body,want", MARKED)
def test_marks_weigh_and_do_not_delete(body, want):
    assert main_text(SHELL.format(body)) == want


@pytest.mark.parametrize("kind", ["sidebar", "widget", "comments", "page-widget"])
def test_a_page_that_is_all_marked(kind):
    assert main_text(f"<div class={kind}>{ARTICLE}</div>") == f"Head {PARA} {PARA}"
    assert main_text(f"<div class={kind}><h1>Head</h1><p>{PARA}</p><p>{PARA}</p></div>") == f"Head {PARA} {PARA}"


LINKED = [
    (f"<article><h1><a href=x>Head</a></h1><p>{PARA}</p><p><a href=y>See there.</a></p><table><tr><td><a href=u>cell</a></table>"
     "<ol><li><a href=z>Source one</a></li><li><a href=w>Source</a> two</li></ol></article>",
     f"Head {PARA} See there. cell Source one Source two"),
    (f"<div id=story><h2><a href=x>Head</a></h2><p>{PARA}</p><p>{PARA}</p></div>", f"Head {PARA} {PARA}"),
    (f"<ul><li><a href=x>Home page, and more.</a></li></ul><article><p>{PARA}</p></article>", PARA),
]


@pytest.mark.parametrize("body,want", LINKED)
def test_links_within_a_region_stay(body, want):
    assert main_text(SHELL.format(body)) == want


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<script>", "</p></div>", "&am", "<a href='", "<nav>x</nav>"])
def test_nothing_or_broken(page):
    assert main_text(page) in ("", "<", "&am")


def test_deep_and_long_pages():
    assert len(main_text("<div>a, b. " * 30_000)) > 100_000
    assert len(main_text("<article>" + "<p>" + "word, " * 200_000)) > 1_000_000


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in extract_pages(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        page = r["html"]
        begin, end = page.index("<article"), page.find("</article>")
        inner = re.sub(r"<(/?(p|h1|article)|br)\b[^>]*(>|$)", " ", page[begin:end if end >= 0 else len(page)])
        want = " ".join(html.unescape(re.sub(r"</?b>", "", inner)).split())
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


def test_frames(spark):
    rows = [(1, None, None, "t"), (1, None, None, "t"), (None, "u", "<p>" + PARA, "t"), (3, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(str, (tuple(r) for r in extract_pages(pages).collect())))
    assert got == sorted(map(str, [(1, None, "", 0), (1, None, "", 0), (None, "u", PARA, len(PARA)), (3, "v", "", 0)]))
    assert extract_pages(pages.limit(0)).collect() == []


BODY = "".join(f"<p>{PARA}</p>" for _ in range(3))


def test_headline_beside_the_body():
    page = f"<body><div class=top><a href=/>Home</a></div><div><h1>Head</h1><div class=meta>By A</div><div class=body>{BODY}</div></div></body>"
    assert main_text(page) == " ".join(["Head", "By A", *[PARA] * 3])


def test_column_beside_the_story_has_a_path_of_its_own():
    side = "<div class=col2><p><a href=/a>One</a></p><p><a href=/b>Two</a></p><p>About us.</p></div>"
    assert main_text(f"<body><div class=row><div class=col>{BODY}</div>{side}</div></body>") == " ".join([PARA] * 3)


def test_short_story_beside_a_long_footer():
    legal = "All rights reserved, of course. No part may be copied, sold or lent. " * 6
    assert main_text(f"<body><div id=content><h1>Hi</h1><p>Short text.</p></div><div class=footer>{legal}</div></body>") == "Hi Short text."


def test_notices_and_calls():
    bar = "<div id=cb-77>We use cookies, and so do our partners. Accept them all, or choose.<button>OK</button></div>"
    call = "<p class=newsletter>Sign up for our letter, free of charge.</p>"
    assert main_text(f"<body>{bar}<div class=entry>{BODY}</div></body>") == " ".join([PARA] * 3)
    assert main_text(f"<body><article><h1>T</h1>{BODY}{call}</article></body>") == " ".join(["T", *[PARA] * 3])
    about = "".join(f"<p>Cookies are small files, {PARA}</p>" for _ in range(5))
    assert main_text(f"<body><div class=entry>{about}</div></body>").count("Cookies") == 5
    kept = f"<article><h1>T</h1>{BODY}<p class=notice-period>A month, as agreed.</p></article>"
    assert main_text(kept).endswith("A month, as agreed.")
