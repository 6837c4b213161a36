"""Salary parsing and rule-based classification.

Rules are ordered lists passed as parameters; each becomes one ``CASE WHEN``
chain of literal ``contains`` tests, compiled once and evaluated in codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col, is_falsy, null_if_na, py_strip, py_title

# Location keywords (substring, first hit wins) and their labels.
LOCATION_RULES: list[tuple[str, str]] = [
    ("jakarta", "DKI Jakarta"),
    ("tangerang", "Tangerang"),
    ("surabaya", "Surabaya"),
    ("bandung", "Bandung"),
]

# Title keywords per category, tested in this order on the
# lower-cased title; note the trailing space in 'ai '.
CATEGORY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("data engineer", "database", "etl"), "Data Engineering"),
    (("data scientist", "machine learning", "ai "), "Data Science & AI"),
    (("data analyst", "analytics"), "Data Analytics"),
    (("software", "developer", "backend", "frontend"), "Software Engineering"),
]
CATEGORY_DEFAULT = "Other"

# Work-setup keywords, tested in this order on the lower-cased value.
WORK_SETUP_RULES: list[tuple[tuple[str, ...], str]] = [
    (("partially remote", "hybrid"), "Hybrid"),
    (("on-site", "onsite", "wfo"), "Onsite"),
    (("remote", "wfh"), "Remote"),
]
WORK_SETUP_UNKNOWN = "Tidak Disebutkan"

# Arrangement inferred from free text (remote beats hybrid).
ARRANGEMENT_TEXT_RULES: list[tuple[str, str]] = [("remote", "Remote"), ("hybrid", "Hybrid")]
ARRANGEMENT_DEFAULT = "On-site"

# Python float() text shape: sign, digits with single underscores, optional
# fraction and exponent, or nan/inf words; surrounding whitespace allowed.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_SHAPE = (r"(?U)^[\s\x1c-\x1f]*[+-]?(?:(?:" + _DIGITS + r"(?:\.(?:" + _DIGITS + r")?)?|\.(?:"
               + _DIGITS + r"))(?:[eE][+-]?" + _DIGITS + r")?|(?i:nan|inf|infinity))[\s\x1c-\x1f]*$")
SALARY_TYPE = "decimal(15,2)"


def _any_contains(text: Column, words: Sequence[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


def salary_is_numeric(c) -> Column:
    """True when ``float(x or 0)`` would succeed (falsy counts as 0)."""
    c = _col(c)
    return is_falsy(c) | c.rlike(FLOAT_SHAPE)


def parse_salary(c, numeric: Column | None = None) -> Column:
    """``float(x or 0)`` into NUMERIC(15,2).

    Falsy gives 0.  Non-numeric text, NaN, infinities and values beyond the
    15,2 range give null; ``check_constraints`` turns those into rejects.
    ``numeric`` may pass an already computed ``salary_is_numeric`` column.
    """
    c = _col(c)
    if numeric is not None:
        body = F.regexp_replace(py_strip(c), "_", "")
        num = F.when(body.rlike(r"(?i)^[+-]?(nan|inf|infinity)$"), F.lit(None)).otherwise(
            body.try_cast("double").try_cast(SALARY_TYPE))
        return (F.when(is_falsy(c), F.lit(0).cast(SALARY_TYPE))
                .when(numeric, num).otherwise(F.lit(None).cast(SALARY_TYPE)))
    body = F.regexp_replace(py_strip(c), "_", "")
    num = F.when(body.rlike(r"(?i)^[+-]?(nan|inf|infinity)$"), F.lit(None)).otherwise(
        body.try_cast("double").try_cast(SALARY_TYPE))
    return (F.when(is_falsy(c), F.lit(0).cast(SALARY_TYPE))
            .when(c.rlike(FLOAT_SHAPE), num)
            .otherwise(F.lit(None).cast(SALARY_TYPE)))


def standardize_location(c, rules: Sequence[tuple[str, str]] = LOCATION_RULES) -> Column:
    """Falsy gives null; first keyword hit wins; else Python title case."""
    c = _col(c)
    low = F.lower(c)
    out = F.when(is_falsy(c), F.lit(None).cast("string"))
    for word, label in rules:
        out = out.when(low.contains(word), F.lit(label))
    return out.otherwise(py_title(c))


def standardize_category(department, title,
                         rules: Sequence[tuple[Sequence[str], str]] = CATEGORY_RULES,
                         default: str = CATEGORY_DEFAULT) -> Column:
    """Keep a department unless falsy or 'N/A'; else classify the title."""
    d, t = _col(department), _col(title)
    low = F.lower(F.coalesce(t, F.lit("None")))
    out = F.when(~is_falsy(d) & (F.upper(d) != "N/A"), d)
    for words, label in rules:
        out = out.when(_any_contains(low, words), F.lit(label))
    return out.otherwise(F.lit(default))


def standardize_work_setup(c, rules: Sequence[tuple[Sequence[str], str]] = WORK_SETUP_RULES,
                           unknown: str = WORK_SETUP_UNKNOWN) -> Column:
    """C11: blank or 'N/A' gives 'Tidak Disebutkan'; keyword rules; else title case."""
    c = _col(c)
    low = F.lower(c)
    out = F.when(is_falsy(c) | (F.upper(py_strip(c)) == "N/A"), F.lit(unknown))
    for words, label in rules:
        out = out.when(_any_contains(low, words), F.lit(label))
    return out.otherwise(py_title(c))


def infer_arrangement(texts: Sequence, rules: Sequence[tuple[str, str]] = ARRANGEMENT_TEXT_RULES,
                      default: str = ARRANGEMENT_DEFAULT, lower: bool = True) -> Column:
    """Ordered keyword rules over one or more text columns.

    A rule fires when its keyword is in any of the columns (lower-cased unless
    ``lower=False``, as for the case-sensitive benefits rule).
    """
    cols = [F.coalesce(_col(t), F.lit("")) for t in texts]
    if lower:
        cols = [F.lower(t) for t in cols]
    out = None
    for word, label in rules:
        cond = F.lit(False)
        for t in cols:
            cond = cond | t.contains(word)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def infer_arrangement_flags(remote_flag, hybrid_flag, default: str = ARRANGEMENT_DEFAULT) -> Column:
    """C16 flag form: a truthy remote flag beats a truthy hybrid flag."""
    return (F.when(F.coalesce(_col(remote_flag).cast("boolean"), F.lit(False)), F.lit("Remote"))
            .when(F.coalesce(_col(hybrid_flag).cast("boolean"), F.lit(False)), F.lit("Hybrid"))
            .otherwise(F.lit(default)))


def classify_frame(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The warehouse projection of job records, in two stages.

    Stage one computes each rule once as a column; stage two applies C7,
    which reads its input three times.  Spark does not fold the stages back
    into one projection while a costly expression is read more than once, so
    every regex chain runs once per row.  ``job_title`` should already be
    cleaned (C5) and be a column of ``df``.
    """
    def g(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")
    s1 = df.select(
        *keep,
        g("job_title").alias("_title"), g("company").alias("_company"),
        standardize_location(g("job_location")).alias("_loc"), g("job_board").alias("_board"),
        g("job_url").alias("job_url"), g("base_salary").alias("_salary"),
        salary_is_numeric(g("base_salary")).alias("salary_ok"),
        standardize_category(g("job_department"), g("job_title")).alias("_cat"), g("job_level").alias("_level"),
        standardize_work_setup(g("work_arrangement")).alias("work_setup"), g("job_type").alias("_type"))
    return s1.select(
        *keep,
        null_if_na("_title").alias("job_title"), null_if_na("_company").alias("company_name"),
        null_if_na("_loc").alias("location"), null_if_na("_board").alias("source"), "job_url",
        parse_salary("_salary", F.col("salary_ok")).alias("salary_avg"), "salary_ok",
        null_if_na("_cat").alias("job_category"),
        null_if_na("_level").alias("experience_level"), "work_setup", null_if_na("_type").alias("job_type"))
