"""String cleaning with Python text semantics, as native Spark expressions.

Every function takes and returns a ``Column``; nothing here leaves the JVM.
Python's ``str.split()``/``strip()`` treat the Unicode White_Space set *and*
the four information separators U+001C..U+001F as whitespace, Java's ``\\s``
does not, so the class below spells that set out under ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python whitespace as a Java regex class (used with the (?U) flag).
PY_WS_CLASS = r"[\s\x1c-\x1f]"
# The same set as characters (Unicode White_Space and the four separators).
PY_WS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# A run of white space other than one plain space.  Printable ASCII is told apart
# first, and the many single spaces of a text are no matches.
_WS_RUN = rf"(?U) [[^!-~]&&{PY_WS_CLASS}]+|[[^ -~]&&{PY_WS_CLASS}][[^!-~]&&{PY_WS_CLASS}]*"
_TAG = r"<[^>]+>"
# str.title() upper-cases a cased letter that follows an uncased character
# (or starts the text) and lower-cases every other cased letter.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_TITLE_BOUNDARY = r"(?U)(?<=[^" + _CASED + r"])(?=[" + _CASED + r"])"
_TITLE_MARK = "\u0002 "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_falsy(c) -> Column:
    """Python truthiness of a string column: None and '' are falsy."""
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def py_strip(c) -> Column:
    """``str.strip()``."""
    return F.btrim(_col(c), F.lit(PY_WS))


def py_ws(c) -> Column:
    """``' '.join(s.split())`` - collapse whitespace runs and strip."""
    return F.regexp_replace(py_strip(c), _WS_RUN, " ")


def clean_string(c) -> Column:
    """Spider-side cleaner; tags become a space, CR is removed, N/A when blank."""
    c = _col(c)
    body = F.regexp_replace(c, _TAG, " ")
    body = F.replace(F.replace(body, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))
    body = py_ws(body)
    return F.when(is_falsy(c), F.lit("N/A")).otherwise(F.coalesce(F.nullif(body, F.lit("")), F.lit("N/A")))


def strip_html(c) -> Column:
    """Tags become a space, ends stripped, inner runs kept; falsy gives ''."""
    c = _col(c)
    return F.when(is_falsy(c), F.lit("")).otherwise(py_strip(F.regexp_replace(c, _TAG, " ")))


def collapse_ws(c, default: str = "N/A", dash_commas: bool = False,
                blank_to_default: bool = False) -> Column:
    """Falsy gives ``default``; optional ', ' to ' - ' first; collapse runs.

    ``blank_to_default`` maps an all-whitespace value to ``default`` as well.
    """
    c = _col(c)
    body = F.replace(c, F.lit(", "), F.lit(" - ")) if dash_commas else c
    body = py_ws(body)
    if blank_to_default:
        body = F.coalesce(F.nullif(body, F.lit("")), F.lit(default))
    return F.when(is_falsy(c), F.lit(default)).otherwise(body)


def comma_to_dash(c, null_default: str = "N/A", title: bool = False,
                  drop_word: str | None = None, blank_default: str | None = None) -> Column:
    """C4: strip, ',' to ' -', collapse.  Null gives ``null_default``.

    C4d adds title case (``title``) or removal of one word (``drop_word``) and
    maps a blank result to ``blank_default``.
    """
    c = _col(c)
    body = F.replace(py_strip(c), F.lit(","), F.lit(" -"))
    if title:
        body = py_title(body)
    elif drop_word:
        body = py_strip(F.replace(body, F.lit(drop_word), F.lit("")))
    body = py_ws(body)
    if blank_default is not None:
        body = F.coalesce(F.nullif(body, F.lit("")), F.lit(blank_default))
    return F.when(c.isNull(), F.lit(null_default)).otherwise(body)


def clean_text(c) -> Column:
    """Load-side cleaner; tags are removed (words join up), runs collapsed.

    Null/empty give 'N/A'; a value that is only tags and spaces gives ''.
    """
    c = _col(c)
    body = py_ws(F.regexp_replace(c, _TAG, ""))
    return F.when(is_falsy(c), F.lit("N/A")).otherwise(body)


def null_if_na(c) -> Column:
    """Null when empty or when strip+upper equals 'N/A'; else unchanged.

    The input is read three times: pass a column, not a costly expression
    (see ``classify_frame``), or the expression is evaluated three times.
    """
    c = _col(c)
    # the substring test is cheap and necessary, the strip regex runs only when it passes
    na = F.lower(c).contains("n/a") & (F.upper(py_strip(c)) == "N/A")
    return F.when((c == "") | na, F.lit(None).cast("string")).otherwise(c)


def py_title(c) -> Column:
    """``str.title()``, fully inside codegen.

    ``initcap`` lower-cases the text and upper-cases the first letter after a
    space.  Marking every cased letter that follows an uncased character with
    a private marker plus a space lets ``initcap`` capitalise exactly the
    letters ``str.title()`` does; the markers are then removed.
    """
    marked = F.regexp_replace(_col(c), _TITLE_BOUNDARY, _TITLE_MARK)
    return F.replace(F.initcap(marked), F.lit(_TITLE_MARK), F.lit(""))


def py_capitalize(c) -> Column:
    """``str.capitalize()`` - first character upper, the rest lower."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def absolutize_url(c, base: str) -> Column:
    """C17: prefix ``base`` unless the url already starts with 'http'."""
    c = _col(c)
    return F.when(c.startswith("http"), c).otherwise(F.concat(F.lit(base), c))


def strip_query(c) -> Column:
    """C17: cut a url at the first '?'."""
    return F.substring_index(_col(c), "?", 1)


def first_truthy(*cols) -> Column:
    """Python ``a or b or ...`` over string columns ('' falls through)."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols])


def search_text(title, desc) -> Column:
    """``str(title + ' ' + desc).lower()`` with Python's 'None' for nulls."""
    t = F.coalesce(_col(title), F.lit("None"))
    d = F.coalesce(_col(desc), F.lit("None"))
    return F.lower(F.concat(t, F.lit(" "), d))
