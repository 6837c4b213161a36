"""HTML markup as native expressions: one tokenizer for tags and attributes, and character references.

``canonical_markup`` rewrites a page into one spelling, so that the rules that
read pages are written once: names in lower case, every attribute as
``name="value"`` after one space, no comments, no contents of scripts and
styles.  Texts and values keep their character references (a quote, ``<`` or
``>`` inside a value becomes one), and are decoded by ``decode_references``
after they have been cut out.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The rest of a tag after its name: quoted values may hold '>'.
_REST = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>"""
#: A tag in the canonical spelling, not of a script or style.
_CANONICAL = r"""<(?!(?:script|style)[ >])[a-z][a-z0-9-]*+(?: [a-z][a-z0-9_:-]*+="[^"<>]*+")*+>|</[a-z][a-z0-9-]*+>"""
#: A comment or declaration, a script or style with its contents, a tag, a stray '<' with its text, or text with the canonical tags behind it.
TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<[!?][^>]*+(?:>|\z)"
         rf"|<(script|style)(?=[\s/>]){_REST}.*?(?:</\1\s*>|\z)"
         rf"|</?[a-z]{_REST}|</?[a-z][^<>]*+>|<[^<]*+|[^<]++(?:(?-i:{_CANONICAL})|[^<]++)*+")
_OPEN_TAG = rf"(?is)^<[a-z]{_REST}|^<[a-z][^<>]*+>"
_NAME = r"^<(/?[a-zA-Z][^\s/>]*)"
_ATTRIBUTE = r"""(?s)[^\s"'/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++))?"""
#: hrefs of links in canonical markup.
LINK_HREF = r'<a(?: [^>]*?)? href="([^"]*)"'
_REFERENCE = r"^(?:(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8});?|([A-Za-z][A-Za-z0-9]{1,31});)"

#: The names of HTML 4, with the apostrophe and the six that HTML 5 also knows in capitals.
NAMES = {**name2codepoint, "apos": 39, **{n.upper(): name2codepoint[n] for n in ("amp", "lt", "gt", "quot", "copy", "reg")}}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` reads it: a one-element array stands for a local name."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _attribute(token: Column) -> Column:
    def rewritten(raw: Column) -> Column:
        value = F.when(raw.startswith('"') | raw.startswith("'"), F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
        for sign, reference in (('"', "&quot;"), ("<", "&lt;"), (">", "&gt;")):
            value = F.replace(value, F.lit(sign), F.lit(reference))
        return F.concat(F.lit(" "), F.lower(F.regexp_extract(token, r"^[^\s/>=]+", 0)), F.lit('="'), value, F.lit('"'))
    return (F.when(token.rlike(r'^[a-z][a-z0-9_:-]*+="[^"<>]*+"\z'), F.concat(F.lit(" "), token))
            .otherwise(let(F.regexp_extract(token, r"(?s)^[^\s/>=]+\s*=\s*(.*)$", 1), rewritten)))


def _tag(token: Column) -> Column:
    def rewritten(written: Column) -> Column:
        name = F.lower(written)
        embeds = name.isin("script", "style")
        # a whole tag is its own opening, but for elements with their contents and tags that do not end
        opening = F.when(embeds | ~token.endswith(">"), F.regexp_extract(token, _OPEN_TAG, 0)).otherwise(token)
        rest = F.substring(opening, F.length(written) + 2, F.length(opening))
        attributes = F.transform(F.regexp_extract_all(rest, F.lit(_ATTRIBUTE), F.lit(0)), _attribute)
        opened = F.concat(F.lit("<"), name, F.array_join(attributes, ""), F.lit(">"))
        return (F.when(name == "", F.replace(token, F.lit("<"), F.lit("&lt;")))
                .when(name.startswith("/"), F.concat(F.lit("<"), name, F.lit(">")))
                .when(embeds, F.concat(opened, F.lit("</"), name, F.lit(">")))
                .otherwise(opened))
    return (F.when(token.startswith("<!") | token.startswith("<?"), F.lit(""))
            .otherwise(let(F.regexp_extract(token, _NAME, 1), rewritten)))


def canonical_markup(html) -> Column:
    """The page in one spelling (see the module); null stays null."""
    tokens = F.regexp_extract_all(_col(html), F.lit(TOKEN), F.lit(0))
    as_is = lambda t: ~t.startswith("<") | t.rlike(rf"^(?:{_CANONICAL})\z")
    return F.array_join(F.transform(tokens, lambda t: F.when(as_is(t), t).otherwise(_tag(t))), "")


def _decoded(piece: Column) -> Column:
    """What a piece of text that stood behind '&' stands for."""
    number, name = (F.regexp_extract(piece, _REFERENCE, g) for g in (1, 2))
    code = F.when(number.rlike("^#[xX]"), F.conv(F.substring(number, 3, 8), 16, 10)).otherwise(F.substring(number, 2, 8)).try_cast("long")
    legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    sign = F.when(legal, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("�"))
    named = F.element_at(F.create_map(*[F.lit(x) for n, c in NAMES.items() for x in (n, chr(c))]), name)
    rest = F.regexp_replace(piece, _REFERENCE, "")
    return (F.when(number != "", F.concat(sign, rest))
            .when((name != "") & named.isNotNull(), F.concat(named, rest))
            .otherwise(F.concat(F.lit("&"), piece)))


def decode_references(c) -> Column:
    """Character references of a text or attribute value decoded: numbers (the semicolon may lack) and ``NAMES``; others stay."""
    def joined(parts: Column) -> Column:
        tail = F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), _decoded)
        return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))
    return let(_col(c), lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&", -1), joined)).otherwise(t))


def link_hrefs(html) -> Column:
    """hrefs of all links of a page, decoded, in page order."""
    return F.transform(F.regexp_extract_all(canonical_markup(html), F.lit(LINK_HREF), F.lit(1)), decode_references)
