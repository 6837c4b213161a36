"""JSON API payloads to job records.

Each function takes a ``raw_payloads``-shaped DataFrame (already filtered to
its kind) and the run timestamp as a text Column, and returns the ordering
columns plus the 18 job fields.  Everything is one explode and one narrow
projection per payload row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.classify import infer_arrangement
from ...functions.dates import iso_or_now, iso_seconds_or_input, long_date_or_now, millis_or_now
from ...functions.text import (collapse_ws, comma_to_dash, first_truthy, is_falsy, py_capitalize, py_strip,
                               py_title, strip_html)
from .base import explode_fields, explode_items, jget, job_record, keep_order, or_default


def _truthy_text(c: Column) -> Column:
    """Python truthiness of a JSON scalar read as text (null, '', 0, false, [] are falsy)."""
    return ~(is_falsy(c) | c.isin("0", "0.0", "false", "[]", "{}"))


DEALLS_ITEM = ("role string, description string, slug string, categorySlug string, latestUpdatedAt string, "
               "createdAt string, status string, workplaceType string, city string, country string, company string, "
               "employmentTypes string, salaryRange string, candidatePreference string")


def _obj(text: Column, field: str, default: str) -> Column:
    """``o.get(field, default)`` when the raw JSON text ``o`` is an object, else ``default``."""
    return F.when(F.coalesce(text.startswith("{"), F.lit(False)),
                  F.coalesce(jget(text, f"$.{field}"), F.lit(default))).otherwise(F.lit(default))


def normalise_dealls(payloads: DataFrame, now: Column) -> DataFrame:
    """B1: Dealls ``data.docs``; level from education codes; status decides activity.

    Each posting is parsed once into a struct; polymorphic members stay raw
    JSON text and are read only where needed.
    """
    it = explode_items(payloads, "$.data.docs")
    it = it.withColumn("j", F.from_json("item", DEALLS_ITEM))
    j = lambda f: F.col(f"j.{f}")
    role = j("role")
    raw_seen = first_truthy(j("latestUpdatedAt"), j("createdAt"))
    last_seen = F.when(is_falsy(raw_seen), now).otherwise(iso_seconds_or_input(raw_seen))
    slug_dept = j("categorySlug")
    types = F.from_json(j("employmentTypes"), "array<string>")
    edu = F.from_json(jget(j("candidatePreference"), "$.lastEducations"), "array<int>")
    level = (F.when(F.array_contains(edu, 7), "Postgraduate").when(F.array_contains(edu, 6), "Graduate")
             .when(F.array_contains(edu, 5), "Undergraduate").otherwise("Junior/Mid-Level"))
    salary = jget(j("salaryRange"), "$.start")
    rec = job_record(
        now,
        job_title=collapse_ws(role, dash_commas=True),
        job_location=F.concat_ws(", ", _obj(j("city"), "name", "N/A"), _obj(j("country"), "name", "Indonesia")),
        job_department=F.when(is_falsy(slug_dept), "N/A").otherwise(py_title(F.replace(slug_dept, F.lit("-"), F.lit(" ")))),
        job_url=F.concat(F.lit("https://dealls.com/role/"), F.coalesce(j("slug"), F.lit(""))),
        base_salary=F.when(_truthy_text(salary), salary).otherwise("0"),
        job_type=F.when(F.size(types) > 0, F.array_join(types, ", ")).otherwise("N/A"),
        job_level=F.coalesce(level, F.lit("Junior/Mid-Level")),
        last_seen=last_seen,
        is_active=F.when(j("status") == "active", "True").otherwise("False"),
        company=_obj(j("company"), "name", "Unknown"),
        company_url=F.concat(F.lit("https://dealls.com/company/"), _obj(j("company"), "slug", "")),
        job_board=F.lit("Dealls"), job_board_url=F.lit("https://dealls.com/"),
        work_arrangement=py_capitalize(F.coalesce(j("workplaceType"), F.lit("On-site"))),
        desc=F.concat_ws(" ", F.coalesce(role, F.lit("")), F.coalesce(j("description"), F.lit(""))),
    )
    return keep_order(it, rec)


# Kalibrr education codes.
KALIBRR_LEVELS = {200: "High School", 550: "Bachelor", 650: "Master"}


KALIBRR_ITEM = ("id string, name string, function string, description string, qualifications string, "
                "created_at string, application_end_date string, tenure string, base_salary string, "
                "education_level string, company_name string, company string, google_location string, "
                "is_work_from_home string, is_hybrid string")


def normalise_kalibrr(payloads: DataFrame, now: Column) -> DataFrame:
    """B2: Kalibrr ``jobs``; url from company code and id; remote flag beats hybrid."""
    it = explode_items(payloads, "$.jobs").withColumn("j", F.from_json("item", KALIBRR_ITEM))
    j = lambda f: F.col(f"j.{f}")
    # read more than once below, so columns of their own
    it = it.withColumns({"_code": _obj(j("company"), "code", ""), "_ac": jget(j("google_location"), "$.address_components")})
    code, ac = F.col("_code"), F.col("_ac")
    city = F.coalesce(jget(ac, "$.city"), F.lit(""))
    region = F.coalesce(jget(ac, "$.region"), F.lit(""))
    it = it.withColumn("_loc", F.btrim(F.concat(city, F.lit(", "), region), F.lit(", ")))
    loc = F.col("_loc")
    has_ac = F.coalesce(ac.startswith("{"), F.lit(False))
    edu = j("education_level").try_cast("int")
    level = F.lit("Junior/Mid-Level")
    for k, v in sorted(KALIBRR_LEVELS.items(), reverse=True):
        level = F.when(edu == k, F.lit(v)).otherwise(level)
    salary = j("base_salary")
    desc = F.concat_ws(" ", F.coalesce(j("name"), F.lit("")), F.coalesce(j("function"), F.lit("")),
                       strip_html(j("description")), strip_html(j("qualifications")))
    flags = F.when(_truthy_text(j("is_work_from_home")), "Remote").when(
        _truthy_text(j("is_hybrid")), "Hybrid").otherwise("On-site")
    rec = job_record(
        now,
        job_title=collapse_ws(F.replace(j("name"), F.lit("\n"), F.lit(" "))),
        job_location=F.when(has_ac, or_default(loc, "N/A")).otherwise("N/A"),
        job_department=F.coalesce(j("function"), F.lit("N/A")),
        job_url=F.concat(F.lit("https://www.kalibrr.com/c/"), code, F.lit("/jobs/"), F.coalesce(j("id"), F.lit(""))),
        base_salary=F.when(_truthy_text(salary), salary).otherwise("0"),
        job_type=F.coalesce(j("tenure"), F.lit("N/A")),
        job_level=level,
        last_seen=iso_or_now(j("created_at"), now),
        job_apply_end_date=iso_or_now(j("application_end_date"), now),
        company=F.coalesce(j("company_name"), F.lit("Unknown")),
        company_url=F.concat(F.lit("https://www.kalibrr.com/c/"), code),
        job_board=F.lit("Kalibrr"), job_board_url=F.lit("https://www.kalibrr.com/"),
        work_arrangement=flags, desc=desc,
    )
    return keep_order(it, rec)


def normalise_karir(payloads: DataFrame, now: Column) -> DataFrame:
    """Karir ``data.opportunities``; salary is the lower bound; empty dates stay empty."""
    it = explode_fields(payloads, "$.data.opportunities", "id", "job_position", "company_name", "location", "job_functions",
                        "job_type", "job_levels", "salary_lower", "posted_at", "expires_at", "workplace")
    j = lambda f: F.col(f"j.{f}")
    funcs = F.from_json(j("job_functions"), "array<string>")
    levels = F.from_json(j("job_levels"), "array<string>")
    position = F.coalesce(j("job_position"), F.lit("N/A"))
    company = F.coalesce(j("company_name"), F.lit("Unknown"))
    salary = j("salary_lower")
    last_seen = iso_seconds_or_input(j("posted_at"))
    rec = job_record(
        now,
        job_title=comma_to_dash(position),
        job_location=comma_to_dash(F.coalesce(j("location"), F.lit("Indonesia"))),
        job_department=F.when(F.size(funcs) > 0, F.array_join(funcs, " - ")).otherwise("N/A"),
        job_url=F.concat(F.lit("https://karir.com/opportunities/"), F.coalesce(j("id"), F.lit(""))),
        base_salary=F.when(_truthy_text(salary), salary).otherwise("0"),
        job_type=F.coalesce(j("job_type"), F.lit("Full-time")),
        job_level=F.when(levels.isNotNull(), F.array_join(levels, " - ")).otherwise("N/A"),
        last_seen=last_seen,
        job_apply_end_date=iso_seconds_or_input(j("expires_at")),
        company=comma_to_dash(company),
        job_board=F.lit("Karir.com"), job_board_url=F.lit("https://karir.com/"),
        work_arrangement=F.coalesce(j("workplace"), F.lit("On-site")),
        desc=F.concat_ws(" ", position, F.coalesce(F.array_join(funcs, " "), F.lit("")), company),
    )
    return keep_order(it, rec)


def normalise_greenhouse(payloads: DataFrame, now: Column, company: str = "Flip",
                         board: str = "Flip Careers", infer_from_content: bool = True,
                         url_base: str = "https://boards.greenhouse.io/flip/jobs/",
                         content_chars: int | None = None) -> DataFrame:
    """B4 (Flip) / B5 (Vidio): Greenhouse ``jobs``; first department and office.

    The description takes the whole content; ``content_chars=200`` cuts it as
    the original crawler does, so that later text reaches no skill.
    """
    it = explode_fields(payloads, "$.jobs", "id", "title", "updated_at", "absolute_url", "content", "location",
                        "departments", "offices")
    j = lambda f: F.col(f"j.{f}")
    title = collapse_ws(j("title"))
    dept = F.coalesce(jget(j("departments"), "$[0].name"), F.lit("N/A"))
    content = F.coalesce(j("content"), F.lit(""))
    if infer_from_content:
        loc = _obj(j("location"), "name", "Indonesia")
        updated = j("updated_at")
        last_seen = F.when(is_falsy(updated), now).otherwise(iso_or_now(updated, now))
        setup = infer_arrangement([content])
        desc = F.concat_ws(" ", title, dept, content if content_chars is None else F.substring(content, 1, content_chars))
        url = F.coalesce(j("absolute_url"), F.concat(F.lit(url_base), F.coalesce(j("id"), F.lit(""))))
    else:
        loc = F.coalesce(jget(j("offices"), "$[0].name"), F.lit("Indonesia"))
        last_seen = now
        setup = F.lit("On-site")
        desc = F.concat_ws(" ", title, dept)
        url = F.coalesce(j("absolute_url"), F.lit(""))
    rec = job_record(
        now, job_title=title, job_location=collapse_ws(loc), job_department=collapse_ws(dept), job_url=url,
        job_type=F.lit("Full-time"), last_seen=last_seen, company=F.lit(company), job_board=F.lit(board),
        work_arrangement=setup, desc=desc)
    return keep_order(it, rec)


def normalise_lever(payloads: DataFrame, now: Column) -> DataFrame:
    """Lever postings (top-level array); arrangement from the location text."""
    it = explode_fields(payloads, None, "text", "hostedUrl", "createdAt", "categories")
    j = lambda f: F.col(f"j.{f}")

    def cat(field: str, default: str) -> Column:
        return collapse_ws(F.coalesce(jget(j("categories"), f"$.{field}"), F.lit(default)), blank_to_default=True)
    title = collapse_ws(j("text"), blank_to_default=True)
    loc = cat("location", "Indonesia")
    commitment = cat("commitment", "Full-time")
    team = F.when(is_falsy(jget(j("categories"), "$.team")), "N/A").otherwise(cat("team", ""))
    rec = job_record(
        now, job_title=title, job_location=loc, job_department=cat("department", "N/A"),
        job_url=F.coalesce(j("hostedUrl"), F.lit("")), job_type=commitment,
        last_seen=millis_or_now(j("createdAt"), now), company=F.lit("Mekari"),
        job_board=F.lit("Mekari Careers"), work_arrangement=infer_arrangement([loc]),
        desc=F.concat_ws(" ", title, cat("department", "N/A"), commitment, team))
    return keep_order(it, rec)


def normalise_jibe(payloads: DataFrame, now: Column) -> DataFrame:
    """Jibe ``jobs[].data``; empty data skipped; posted date 'Month d, yyyy'."""
    it = explode_items(payloads, "$.jobs")
    it = it.withColumn("item", jget(F.col("item"), "$.data")).filter(
        F.col("item").isNotNull() & ~F.col("item").isin("{}", "null"))
    i = F.col("item")
    title = F.coalesce(jget(i, "$.title"), F.lit("N/A"))
    description = F.coalesce(jget(i, "$.description"), F.lit(""))
    dept = F.coalesce(jget(i, "$.tags2[0]"), F.lit("N/A"))
    rec = job_record(
        now, job_title=title, job_location=F.coalesce(jget(i, "$.full_location"), F.lit("N/A")),
        job_department=dept,
        job_url=F.concat(F.lit("https://careers.softwareone.com/en/jobs/"), F.coalesce(jget(i, "$.req_id"), F.lit(""))),
        job_type=F.coalesce(jget(i, "$.employment_type"), F.lit("N/A")),
        last_seen=long_date_or_now(jget(i, "$.posted_date"), now),
        company=F.coalesce(jget(i, "$.hiring_organization"), F.lit("SoftwareOne")),
        job_board=F.lit("SoftwareOne Careers"),
        work_arrangement=infer_arrangement([title, description]),
        desc=F.concat_ws(" ", title, dept, description, F.coalesce(jget(i, "$.qualifications"), F.lit(""))))
    return keep_order(it, rec)


def normalise_koltiva(payloads: DataFrame, now: Column) -> DataFrame:
    """Koltiva ``data.data``; title case; 'Contract' removed from the type."""
    it = explode_fields(payloads, "$.data.data", "position_name", "unitsec_name", "unit_name", "country_name", "slug",
                        "work_period_name", "level_name", "close_date", "jobs_benefits_perks")
    j = lambda f: F.col(f"j.{f}")
    position = F.coalesce(j("position_name"), F.lit("N/A"))
    section = F.coalesce(j("unitsec_name"), F.lit("N/A"))
    benefits = F.coalesce(j("jobs_benefits_perks"), F.lit(""))
    close = F.coalesce(j("close_date"), F.lit(""))
    rec = job_record(
        now, job_title=comma_to_dash(position, title=True, blank_default="N/A"),
        job_location=F.concat_ws(" - ", comma_to_dash(j("unit_name"), blank_default="N/A"),
                                 comma_to_dash(j("country_name"), blank_default="N/A")),
        job_department=comma_to_dash(section, blank_default="N/A"),
        job_url=F.concat(F.lit("https://career.koltiva.com/list-job/"), F.coalesce(j("slug"), F.lit(""))),
        job_type=comma_to_dash(j("work_period_name"), drop_word="Contract", blank_default="N/A"),
        job_level=comma_to_dash(j("level_name"), blank_default="N/A"),
        job_apply_end_date=F.when(close.contains("T"), F.substring_index(close, "T", 1)).otherwise(close),
        last_seen=now, company=F.lit("Koltiva"), job_board=F.lit("Koltiva Careers"),
        work_arrangement=infer_arrangement([benefits], rules=[("Work-from-home", "Remote")], lower=False),
        desc=F.concat_ws(" ", position, section, benefits))
    return keep_order(it, rec)
