"""URL filters that change over time: list entries as validity intervals.

A dated entry adds or removes a pattern on a list.  Entries of one pattern
become intervals from an addition to the next removal, and a capture is
evaluated against the intervals that hold when it was fetched: an as-of join on
the patterns a URL can match (its host, the parent domains, the path prefixes).

Captures meet the lists as distinct (pattern, day) pairs, so a host with a third
of all captures sends each task's days, not its rows, through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobsight.llm.store import written

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host, without user, port and final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")


def patterns(url: Column) -> Column:
    """What a URL can match: ``host:h``, ``domain:d`` for h and its parents, ``path:h/a/b`` for its folders."""
    h = host(url)
    labels = F.split(h, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    folders = F.split(F.regexp_extract(url, PATH, 1), "/")
    prefixes = F.when(F.size(folders) > 2, F.transform(
        F.sequence(F.lit(2), F.size(folders) - 1),
        lambda i: F.concat(F.lit("path:"), h, F.array_join(F.slice(folders, 1, i), "/"), F.lit("/"))))
    return F.when(h != "", F.concat(F.array(F.concat(F.lit("host:"), h)), parents,
                                    F.coalesce(prefixes, F.array().cast("array<string>"))))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, since, until`` from ``list, pattern, action ('add' or 'remove'), at``.

    Of entries on one day the removal counts.  Rows with a null are left out.
    ``until`` is exclusive and null while the entry holds.
    """
    days = (entries.dropna(subset=["list", "pattern", "action", "at"]).groupBy("list", "pattern", "at")
            .agg(F.bool_and(F.col("action") == "add").alias("added")))
    following = W.partitionBy("list", "pattern").orderBy("at")
    return (days.withColumn("until", F.lead("at").over(following)).filter("added")
            .select("list", "pattern", F.col("at").alias("since"), "until"))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    at_col: str = "fetched_at") -> DataFrame:
    """One row per capture: ``id, url, fetched_at, n_lists, lists, blocked``.

    ``lists`` are the names, sorted and comma-joined, of the lists with an entry
    that held at ``fetched_at``.  A null URL, one without host, and a null date
    match nothing.  Repeated rows are answered row by row.
    """
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(at_col).alias("fetched_at"))
    held = written(intervals(entries), "intervals")
    seen = rows.select("url", "fetched_at").distinct()
    keyed = written(seen.select("url", "fetched_at", F.explode(patterns(F.col("url"))).alias("pattern")), "patterns")
    asked = keyed.select("pattern", "fetched_at").distinct()
    now = written(asked.join(held, "pattern")
                  .filter((F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until"))))
                  .select("pattern", "fetched_at", "list").distinct(), "held")
    named = written(keyed.join(now, ["pattern", "fetched_at"]).groupBy("url", "fetched_at")
                    .agg(F.sort_array(F.collect_set("list")).alias("names")), "named")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return rows.join(named, ["url", "fetched_at"], "left").select(
        "id", "url", "fetched_at", F.size(names).cast("long").alias("n_lists"),
        F.array_join(names, ",").alias("lists"), (F.size(names) > 0).alias("blocked"))


def drop_blocked(captures: DataFrame, entries: DataFrame, url_col: str = "url", at_col: str = "fetched_at") -> DataFrame:
    """``captures`` without those that a list blocked when they were fetched, all columns as they came."""
    bad = (filter_captures(captures.select(F.lit(0).alias("__i"), url_col, at_col), entries, "__i", url_col, at_col)
           .filter("blocked").select(F.col("url").alias("__u"), F.col("fetched_at").alias("__a")).distinct())
    return captures.join(bad, (captures[url_col] == bad["__u"]) & (captures[at_col] == bad["__a"]), "left_anti")
