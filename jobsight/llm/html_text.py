"""Main text of web pages by tag-path ratios.

A page becomes its text nodes in page order, each with the path of block
elements from the root; a step is the tag with, for elements that hold others, its
classes, so that columns side by side are paths of their own.  Per path, text length and punctuation per node are
aggregated; the two ratios are smoothed along the page, so that a heading next
to paragraphs shares their weight, and fused, less the share of link text.  The
paths above a threshold are content, taken apart for article and main elements and
for the page outside them, so that neither hides the other, and the smallest element
around their nodes, or the article or main element that it lies in, is a content region.
Article and main elements with content are regions of their own; if the longest
of them has less content than the page outside, the region of the outside counts,
and with it those that are long enough beside it.  The regions' nodes make the text.

Elements that never hold main text (menus, footers, scripts and the like, by tag
or role) do not enter the ratios.  Forms, and elements marked by a word of class or
id, do, at a lower score: a class that names nothing else (ad, share-buttons) weighs
more than one that has such a word among others (has-sidebar, notice-period), and an
article or main element is marked only by elements around it that hold other texts
(comments, related).  Elements of the former kind are no content at all while a sentence
stands outside them, and small blocks outside articles that speak of cookies or consent
never are.  Within a region, forms and elements of the former kind are left
out unless they hold content.  A headline (h1) in front of a region, and what
short texts stand between the two, belong to it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
NEVER = frozenset("head script style noscript template nav footer aside button select textarea title iframe svg canvas "
                  "menu dialog object audio video option math".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
RAW_END = {t: re.compile(f"</{t}[^>]*>", re.I) for t in RAW}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
# Elements that are a part of a text and never all of it.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote".split())
BREAKS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
# Words of class or id that mark an element as no main text, and words that say nothing beside them.
ADVERTS = r"ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?"
WORDS = (rf"{ADVERTS}|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|footer|masthead|site-header|page-header|topbar|"
         r"cookies?|consent|gdpr|notices?|alert|newsletter|subscribe|signup|share|sharing|social|related|recommended|"
         r"recommendations|comments?|replies|reply|disqus|popup|modal|overlay|pagination|pager|toolbar|widget|login|search")
BESIDE = (r"top|bottom|inner|outer|area|bar|block|box|button|buttons|container|form|group|icons?|items?|"
          r"links?|list|panel|posts?|section|slot|stories|unit|wrapper|wrap")
MARKS = re.compile(rf"(?:^|[\s_-])(?:{WORDS})(?:$|[\s_-])", re.I)
NOTHING_ELSE = re.compile(rf"(?:^|\s)(?:(?:{BESIDE})[_-]+)*(?:{WORDS})(?:[_-]+(?:{WORDS}|{BESIDE}))*(?:$|\s)", re.I)
ADVERT = re.compile(rf"(?:^|\s)(?:{ADVERTS})(?:$|\s)", re.I)
# Of these, words of elements that hold texts other than the main one, articles among them.
OTHERS = re.compile(rf"(?:^|[\s_-])(?:{ADVERTS}|sidebar|related|recommended|recommendations|comments?|replies|reply|disqus)(?:$|[\s_-])", re.I)
# Elements that a word of class or id other than of adverts never takes out.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote tr td th".split())
# Of prose elements, those whose class is only words like these are calls to the reader.
CALLS = re.compile(r"(?:^|\s)(?:(?:newsletter|subscribe|signup|share|sharing|social|cookies?|consent|gdpr|login)(?:$|[\s_-]+(?=\S)))+$", re.I)
# Words of notices, in blocks of at most NOTICE_NODES nodes outside articles.
NOTICE = re.compile(r"\b(?:cookies?|consent|gdpr|dsgvo|rgpd)\b", re.I)
NOTICE_NODES = 3
SENTENCE = re.compile(r"\w[.!?…。！？][\"'»”)]*(?:\s|$)")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")
#: Weight of neighbouring nodes, by distance, when ratios are smoothed.
SMOOTH = [math.exp(-d * d / 2) for d in range(4)]
#: A path is content from this share of the page's best path on.
THRESHOLD = 0.25
#: Nodes with a larger share of link text choose no region; within a region they are text like others.
MOST_LINK = 0.5
#: Factor of a path's score by its mark: none, a word among others, a form, nothing but such words, those of ``OTHERS``.
MARKED = (1.0, 0.5, 0.1, 0.1, 0.02)
FORM, ONLY = 2, 3


@dataclass
class Element:
    """An open or closed element; ``last`` is the number of the last element opened within it.

    ``main`` and ``outer`` are the numbers of the nearest and of the outermost article or main element, itself included; 0 for none.
    ``mark`` is a place in ``MARKED``; ``left_out`` is the number of the nearest form or element marked by nothing but such words, 0 for none.
    """

    tag: str
    number: int
    parent: int
    path: int
    never: bool
    main: int
    outer: int
    mark: int
    left_out: int
    last: int = 0


@dataclass
class Node:
    path: int
    element: int
    outer: int
    mark: int
    left_out: int
    text: str
    link: int


def mark_of(tag: str, words: str) -> int:
    """Place in ``MARKED`` by the words of an element's class and id."""
    if tag == "body" or not MARKS.search(words):
        return 0
    if not (NOTHING_ELSE.search(words) if tag not in PROSE else ADVERT.search(words) or CALLS.search(words.strip())):
        return 1
    return ONLY + 1 if OTHERS.search(words) else ONLY


def parse(page: str) -> tuple[list[Node], list[Element]]:
    """Text nodes that may be content, in page order, and the elements; a node is the text between two block borders."""
    root = Element("", 0, 0, 0, False, 0, 0, 0, 0)
    elements, stack = [root], [root]
    opened: Counter = Counter()
    paths: dict[tuple, int] = {}
    nodes: list[Node] = []
    runs: list[str] = []
    link = links = 0

    def flush() -> None:
        nonlocal link
        if runs:
            top = stack[-1]
            text = "" if top.never else " ".join("".join(runs).split())
            runs.clear()
            if text:
                nodes.append(Node(top.path, top.number, top.outer, top.mark, top.left_out, text, min(link, len(text))))
        link = 0

    def add(raw: str) -> None:
        nonlocal link
        if raw:
            text = html.unescape(raw)
            runs.append(text)
            if links:
                link += len(text.strip())

    def close() -> None:
        element = stack.pop()
        opened[element.tag] -= 1
        element.last = len(elements) - 1

    at = 0
    while True:
        m = TOKEN.search(page, at)
        add(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue  # a comment or a declaration
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m[1] else links + 1
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        flush()
        links = 0
        if m[1]:
            if opened[tag] > 0:
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        while stack[-1].tag in CLOSES.get(tag, ()):
            close()
        if tag in BREAKS_P and stack[-1].tag == "p":
            close()
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        top = stack[-1]
        given = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(m[3])} if m[3] else {}
        role = given.get("role", "").lower()
        main = tag in ("article", "main") or role in ("main", "article")
        never = (tag in NEVER or (tag == "header" and not top.main) or role in ROLES or "hidden" in given
                 or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""))
        mark = FORM if tag == "form" else mark_of(tag, f"{given.get('class', '')} {given.get('id', '')}") if given and not main else 0
        number, all_marks = len(elements), max(mark, 0 if main and top.mark <= ONLY else top.mark)
        classes = " ".join(given.get("class", "").split()) if given and tag not in PROSE else ""
        element = Element(tag, number, top.number, paths.setdefault((top.path, tag, classes, main, all_marks), len(paths) + 1),
                          never or top.never, number if main else top.main, top.outer or main * number, all_marks,
                          number if mark >= FORM else top.left_out)
        elements.append(element)
        stack.append(element)
        opened[tag] += 1
    flush()
    while stack:
        close()
    return nodes, elements


def scores(nodes: list[Node]) -> dict[int, float]:
    """Fused ratio of each path, at the factor of its mark."""
    factor = {n.path: MARKED[n.mark] for n in nodes}
    total: dict[int, list[float]] = {}
    for n in nodes:
        t = total.setdefault(n.path, [0, 0, 0, 0])
        for i, x in enumerate((1, len(n.text), len(PUNCTUATION.findall(n.text)), n.link)):
            t[i] += x
    ratio = {p: (t[1] / t[0], t[2] / t[0]) for p, t in total.items()}
    smooth: dict[int, list[float]] = {p: [0.0, 0.0] for p in total}
    for i, n in enumerate(nodes):
        near = [(SMOOTH[abs(j - i)], ratio[nodes[j].path]) for j in range(max(0, i - 3), min(len(nodes), i + 4))]
        weight = sum(w for w, _ in near)
        for k in (0, 1):
            smooth[n.path][k] += sum(w * r[k] for w, r in near) / weight
    return {p: factor[p] * (s[0] / total[p][0]) * (1 + s[1] / total[p][0]) * (1 - total[p][3] / total[p][1]) * math.sqrt(total[p][1])
            for p, s in smooth.items()}


def around(content: list[Node], elements: list[Element]) -> Element:
    """The smallest element around all content, or the article or main element that it lies in; around a single node, from its parent on."""
    low, high = min(n.element for n in content), max(n.element for n in content)
    region = elements[content[0].element]
    if len(content) == 1 and region.number != region.main:
        region = elements[region.parent]
    while not (region.number <= low and high <= region.last) or (region.tag in PARTS and region.number != region.main):
        region = elements[region.parent]
    return elements[region.main] if region.main else region


def regions(content: list[Node], elements: list[Element]) -> dict[int, Element]:
    """The content regions of a page, by the outermost article or main element (0 for the page outside)."""
    groups: dict[int, list[Node]] = {}
    for n in content:
        groups.setdefault(n.outer, []).append(n)
    size = {k: sum(len(n.text) * MARKED[n.mark] for n in g) for k, g in groups.items()}
    outside = size.pop(0, 0)
    if outside > max(size.values(), default=0):
        taken = [0, *(k for k, x in size.items() if x >= THRESHOLD * outside)]
    else:
        taken = list(size)
    return {k: around(groups[k], elements) for k in taken}


def notices(nodes: list[Node], elements: list[Element]) -> set[int]:
    """Places of the nodes of small blocks outside articles that speak of cookies or consent."""
    out: set[int] = set()
    numbers = [n.element for n in nodes]
    for n in nodes:
        if not n.outer and NOTICE.search(n.text):
            block = elements[n.element]
            while block.tag in PROSE or block.tag in PARTS:
                block = elements[block.parent]
            if block.number and block.tag != "body":
                held = [i for i, e in enumerate(numbers) if block.number <= e <= block.last]
                if len(held) <= NOTICE_NODES < len(nodes):
                    out.update(held)
    return out


def headed(nodes: list[Node], elements: list[Element], first: int, size: int) -> list[int]:
    """The places from the last headline in front of place ``first`` up to it, if the texts between are short and unmarked."""
    for i in range(first - 1, -1, -1):
        if elements[nodes[i].element].tag == "h1":
            between = [j for j in range(i, first) if nodes[j].mark <= 1 and nodes[j].link <= MOST_LINK * len(nodes[j].text)]
            return between if i in between and sum(len(nodes[j].text) for j in between[1:]) <= THRESHOLD * size else []
    return []


def main_text(page: str | None) -> str:
    """The main text; empty for null, for an empty page and for one without content."""
    nodes, elements = parse(page or "")
    gone = notices(nodes, elements)
    nodes = [n for i, n in enumerate(nodes) if i not in gone]
    if not nodes:
        return ""
    score = scores(nodes)
    best = [max((score[n.path] for n in nodes if bool(n.outer) == inside), default=0.0) for inside in (False, True)]
    content = [n for n in nodes if score[n.path] >= THRESHOLD * best[n.outer > 0] and n.link <= MOST_LINK * len(n.text)]
    plain = [n for n in nodes if n.mark < FORM and n.link <= MOST_LINK * len(n.text)]
    if any(SENTENCE.search(n.text) for n in plain):
        content = [n for n in content if n.mark < ONLY] or plain
    taken = regions(content, elements)
    holding = {n.left_out for n in content if n.outer in taken}
    found = sorted(taken.values(), key=lambda e: e.number)
    out, at, first, last = [], 0, 0, -1  # first and last element of the region begun that reaches farthest
    for i, n in enumerate(nodes):
        while at < len(found) and found[at].number <= n.element:
            if found[at].last > last:
                first, last = found[at].number, found[at].last
            at += 1
        if n.element <= last and (n.left_out <= first or n.left_out in holding):
            out.append(i)
    if out and not any(elements[nodes[i].element].tag == "h1" for i in out):
        out = headed(nodes, elements, out[0], sum(len(nodes[i].text) for i in out)) + out
    return " ".join(nodes[i].text for i in out)


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns with ``text`` and ``n_chars`` for every row.

    Null and empty pages give the empty text; rows are independent, so nulls in
    other columns and repeated rows stay as they are.
    """
    rows = pages.select(*keep, F.col(html_col).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
