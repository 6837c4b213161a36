"""Deduplication and route choice.

"First row per key" is an aggregate, not a window: ``min_by(row, order)`` runs
a partial aggregation before the shuffle, so a key that holds a third of the
input leaves each map task as a single row.  Its struct buffer makes Spark sort
by the key on both sides of the shuffle; no task gathers the rows of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, key, order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per ``key`` by the ``order`` columns (ties: any one)."""
    keys = _as_list(key)
    cols = list(keep) if keep is not None else df.columns
    row = F.struct(*[F.col(c) for c in cols if c not in keys])
    rank = F.struct(*[F.col(c) for c in order])
    best = df.groupBy(*keys).agg(F.min_by(row, rank).alias("_first"))
    return best.select(*keys, "_first.*")


def dedup_jobs(records: DataFrame, order: Sequence[str] = ("file_path", "block_start", "pos"),
               key: str = "job_url") -> DataFrame:
    """first record per raw ``job_url`` in landing order."""
    return first_per_key(records, key, order).select(*records.columns)


def dedup_courses(records: DataFrame, order: Sequence[str] = ("file_path", "block_start", "pos"),
                  key: str = "course_title") -> DataFrame:
    """first record per raw ``course_title`` (before cleaning)."""
    return first_per_key(records, key, order).select(*records.columns)


def distinct_pairs(df: DataFrame, cols: Sequence[str] = ("job_id", "skill_name")) -> DataFrame:
    """the set of (owner, skill) pairs."""
    return df.select(*cols).dropDuplicates(list(cols))


def exclude_seen(items: DataFrame, key: str = "job_url",
                 order: Sequence[str] = ("page_seq", "route", "item_pos")) -> DataFrame:
    """Keep an item only the first time its url is emitted in a run."""
    return first_per_key(items, key, order).select(*items.columns)


def first_nonempty_route(items: DataFrame, unit, route: str = "route") -> DataFrame:
    """Per unit (page or run), keep only the rows of its best route.

    Route ``r`` is used only when every route before it gave no rows.  The best
    route per unit is a partial aggregate; the semi-join brings it back.  AQE
    splits a unit that is far larger than the rest (skew join).
    """
    units = _as_list(unit)
    best = items.groupBy(*units).agg(F.min(route).alias(route))
    return items.join(best, units + [route], "left_semi")


def first_new_route(items: DataFrame, run: str = "run", page: str = "page_seq", route: str = "route",
                    url: str = "job_url", pos: str = "item_pos") -> DataFrame:
    """E7 with a running set of urls (T9): pages of a run are read in order, and a
    page takes its first route that has a url no earlier page has taken; it emits that route's new urls, each once.

    Whether a route has a new url depends on what earlier pages took.  All pages
    are decided together, in rounds.  ``taken`` holds the first page that took
    each url so far; a page not decided yet might still take the urls of
    the routes left to it.  In a round a url is old to a page if an earlier page took
    it, new if no earlier page took it or might take it, else open.  A page skips
    routes whose urls are all old, and is decided when its next route has a new
    url (that route), or no route is left (none).  The first page not decided
    has no open url, so each round decides some pages of every run; most pages
    hold a url that they are the first to show and are decided in the first.

    Returns the emitted items, all columns.  Items without a url are never new.
    """
    spark = items.sparkSession
    ensure_checkpoint_dir(spark)
    names = {"_run": run, "_page": page, "_route": route, "_url": url}
    left = (items.filter(F.col(url).isNotNull()).select(*[F.col(c).alias(n) for n, c in names.items()])
            .distinct().checkpoint())
    taken = left.limit(0).select("_run", "_url", F.col("_page").alias("_by"))
    decided = left.limit(0).select("_run", "_page", "_route")
    while not left.isEmpty():
        might = left.groupBy("_run", "_url").agg(F.min("_page").alias("_might"))
        seen = left.join(might, ["_run", "_url"]).join(taken, ["_run", "_url"], "left")
        old = F.coalesce(F.col("_by") < F.col("_page"), F.lit(False))
        new = ~old & (F.col("_might") >= F.col("_page"))
        routes = (seen.groupBy("_run", "_page", "_route")
                  .agg(F.bool_and(old).alias("_old"), F.bool_or(new).alias("_new")))
        # the first route that is not all old, and whether it has a new url
        pages = routes.groupBy("_run", "_page").agg(
            F.min(F.when(~F.col("_old"), F.struct("_route", "_new"))).alias("_next")).checkpoint()
        found = pages.filter("_next._new").select("_run", "_page", F.col("_next._route").alias("_route")).checkpoint()
        decided = decided.unionByName(found).checkpoint()
        claims = left.join(found, ["_run", "_page", "_route"], "left_semi").select("_run", "_url", F.col("_page").alias("_by"))
        taken = taken.unionByName(claims).groupBy("_run", "_url").agg(F.min("_by").alias("_by")).checkpoint()
        rest = pages.filter("NOT _next._new").select("_run", "_page", F.col("_next._route").alias("_from"))
        left = left.join(rest, ["_run", "_page"]).filter("_route >= _from").drop("_from").checkpoint()
    # of the route taken the urls whose first taker is the page, each at its first position
    back = {c: n for n, c in names.items()}
    mine = [F.col(c).alias(back[c]) for c in (run, page, route, url)]
    first = (items.select(*mine, F.col(pos).alias("_pos")).join(decided, ["_run", "_page", "_route"], "left_semi")
             .join(taken.withColumnRenamed("_by", "_page"), ["_run", "_url", "_page"], "left_semi")
             .groupBy("_run", "_page", "_route", "_url").agg(F.min("_pos").alias("_pos")))
    on = [items[c].eqNullSafe(first[n]) for n, c in [*names.items(), ("_pos", pos)]]
    return items.join(first, on, "left_semi")
