"""Snapshot tables with an open/refresh/close lifecycle.

A snapshot is an immutable DataFrame; every operator returns the next state.
Joins are on the natural key (``job_url`` / ``url``), so each step is one
shuffle per side, or none when AQE broadcasts a small batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import JOB_VACANCIES, LENGTH_LIMITS
from ..session import ensure_checkpoint_dir

JOB_COLS = [f.name for f in JOB_VACANCIES.fields]
# Columns an existing url takes from a new sighting; all others keep old values.
UPSERT_REFRESH = ("job_title", "salary_avg", "work_setup")
BATCH_COLS = ["job_title", "company_name", "location", "source", "job_url", "salary_avg",
              "job_category", "experience_level", "work_setup", "job_type"]


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x.cast("timestamp_ntz")
    return F.lit(x).cast("timestamp_ntz")


# ---------------------------------------------------------------- ids

def assign_ids(df: DataFrame, id_col: str, start, order: Sequence[str] = (),
               compact: bool = False) -> DataFrame:
    """Unique ids above ``start`` without a single task that sees all rows.

    * ``compact=False`` (one pass): ``start + 1 + monotonically_increasing_id``;
      unique, with gaps between partitions (the warehouse key allows gaps).
      Rows keep their partitions and are sorted inside them by ``order`` (a
      unique key), so a recomputed task numbers them the same way.
    * ``compact=True``: ``start + 1, start + 2, ...`` in the order of ``order`` over
      the whole table: rows are range-partitioned, each partition numbers its
      rows, and the row counts of the partitions before it are added.  The
      counts are one row per partition, summed up in one unpartitioned
      window over those few rows.  The numbered rows are checkpointed to the shared
      checkpoint folder first, so both passes see the same partitions.
      Without ``order`` rows are numbered as they lie.
    """
    base = start if isinstance(start, Column) else F.lit(start)
    if not compact:
        local = df.sortWithinPartitions(*order) if order else df
        return local.withColumn(id_col, (base + 1 + F.monotonically_increasing_id()).cast("long"))
    ensure_checkpoint_dir(df.sparkSession)
    local = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    local = local.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    part, at = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = local.join(offsets, part == F.col("_part")).withColumn(id_col, (base + F.col("_before") + at + 1).cast("long"))
    return out.drop("_mid", "_part", "_before")


def max_id(df: DataFrame, id_col: str) -> Column:
    """The largest id as a scalar subquery (0 when empty): evaluated with the plan, not before it."""
    return F.coalesce(df.agg(F.max(id_col)).scalar(), F.lit(0)).cast("long")


# ------------------------------------------------------------ predicates

def stale_predicate(last_seen, is_active, as_of, days: int = 3) -> Column:
    """``last_seen < date(as_of) - days`` and active (midnight is kept)."""
    cutoff = F.date_sub(F.to_date(_ts(as_of)), days).cast("timestamp_ntz")
    ls = F.col(last_seen) if isinstance(last_seen, str) else last_seen
    act = F.col(is_active) if isinstance(is_active, str) else is_active
    return (ls < cutoff) & act


# ------------------------------------------------------------ joins

def absent_rows(existing: DataFrame, new: DataFrame, key: Sequence[str], owner: str | None = None) -> DataFrame:
    """E5: the rows of ``new`` whose key ``existing`` lacks.

    With ``owner``, a column of the key, the history is first cut down to the
    owners that ``new`` has: what meets ``new`` in the join follows the
    batch and not the history (a small batch's owners are sent to the scan by Spark).
    """
    old = existing.select(*key)
    if owner is not None:
        old = old.join(new.select(owner).distinct(), owner, "left_semi")
    return new.join(old, list(key), "left_anti").select(*existing.columns)


def insert_absent(existing: DataFrame, new: DataFrame, key: Sequence[str], owner: str | None = None) -> DataFrame:
    """E5: keep every existing row, add new rows whose key is absent."""
    return existing.unionByName(absent_rows(existing, new, key, owner))


def cascade_delete(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children whose owner still exists (deleting an owner deletes its skills)."""
    return children.join(parents.select(key), key, "left_semi")


def orphan_check(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows without an owner (must be empty)."""
    return children.join(parents.select(key), key, "left_anti")


# ------------------------------------------------------------ upsert

def upsert_jobs(current: DataFrame, batch: DataFrame, as_of, clear_closed_at: bool = False,
                id_order: Sequence[str] = ("job_url",)) -> DataFrame:
    """G1: insert new urls, refresh seen ones.

    A new url gets ``scraped_at = last_seen = as_of``, active, no ``closed_at``, and
    the next id, new urls in the order of ``id_order`` (``file_path, block_start, pos`` for
    the landing order).  A seen url gets ``last_seen = as_of``, active, and the batch's
    title, salary and work setup; all other columns keep their old values and
    ``closed_at`` is kept unless ``clear_closed_at``.  ``batch`` must be unique
    on ``job_url`` (``dedup_jobs`` then ``check_constraints``).

    Two joins on the url: the snapshot with the batch's refreshable columns, and the
    batch against the snapshot's urls.  A snapshot read by ``read_bucketed`` is
    partitioned and sorted by url on disk, so only the batch crosses a shuffle;
    only the new rows are numbered.
    """
    now = _ts(as_of)
    seen = batch.select(F.col("job_url").alias("_url"), *[F.col(c).alias(f"_{c}") for c in UPSERT_REFRESH])
    joined = current.select(*JOB_COLS).join(seen, F.col("job_url") == F.col("_url"), "left")
    hit = F.col("_url").isNotNull()
    changed = {c: F.col(f"_{c}") for c in UPSERT_REFRESH} | {"last_seen": now, "is_active": F.lit(True)}
    if clear_closed_at:
        changed["closed_at"] = F.lit(None).cast("timestamp_ntz")
    kept = joined.select(*[F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in JOB_COLS])
    extra = [c for c in id_order if c not in BATCH_COLS]
    fresh = batch.select(*BATCH_COLS, *extra).join(current.select("job_url"), "job_url", "left_anti")
    fresh = assign_ids(fresh, "job_id", max_id(current, "job_id"), order=list(id_order), compact=True)
    fresh = fresh.withColumns({"scraped_at": now, "last_seen": now, "is_active": F.lit(True),
                               "closed_at": F.lit(None).cast("timestamp_ntz")})
    return kept.unionByName(fresh.select(*JOB_COLS))


def close_stale(jobs: DataFrame, as_of, days: int = 3) -> DataFrame:
    """Active rows unseen since ``date(as_of) - days`` close at ``as_of``."""
    stale = stale_predicate("last_seen", "is_active", as_of, days)
    return (jobs.withColumn("closed_at", F.when(stale, _ts(as_of)).otherwise(F.col("closed_at")))
            .withColumn("is_active", F.when(stale, F.lit(False)).otherwise(F.col("is_active"))))


# ------------------------------------------------------------ courses

def insert_courses(current: DataFrame, batch: DataFrame, as_of,
                   order: Sequence[str] = ("file_path", "block_start", "pos")) -> DataFrame:
    """Add courses with a new url; a known url keeps its stored title.

    A url repeated inside the batch keeps its first row.
    """
    from .dedup import first_per_key
    cols = ["course_title", "platform", "url"]
    first = first_per_key(batch.select(*cols, *order), "url", order).select(*cols, *order)
    fresh = first.join(current.select("url"), "url", "left_anti")
    fresh = fresh.withColumn("scraped_at", _ts(as_of))
    fresh = assign_ids(fresh, "course_id", max_id(current, "course_id"), order=list(order), compact=True)
    keep = ["course_id", "course_title", "platform", "url", "scraped_at"]
    return current.select(*keep).unionByName(fresh.select(*keep))


# ------------------------------------------------------------ constraints

def constraint_reasons(df: DataFrame, table: str = "job_vacancies", key: str | None = None,
                       not_null: Sequence[str] | None = None, check_unique: bool = True) -> DataFrame:
    """``df`` with a ``reject_reason`` (empty for rows the warehouse takes), in one pass.

    Checks NOT NULL, VARCHAR lengths, the salary's numeric shape and range,
    and key uniqueness (every row of a repeated key is rejected: the
    warehouse would refuse the whole batch).  A batch that F1 has made
    unique needs no ``check_unique``: then the check is one projection.
    """
    key = key or ("job_url" if table == "job_vacancies" else "url")
    not_null = list(not_null) if not_null is not None else (
        ["job_title", "job_url"] if table == "job_vacancies" else ["course_title", "url"])
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c}_null")) for c in not_null]
    for c, n in LENGTH_LIMITS.get(table, {}).items():
        if c in df.columns:
            reasons.append(F.when(F.length(c) > n, F.lit(f"{c}_too_long")))
    if "salary_ok" in df.columns:
        reasons.append(F.when(~F.col("salary_ok"), F.lit("salary_not_numeric")))
        reasons.append(F.when(F.col("salary_ok") & F.col("salary_avg").isNull(), F.lit("salary_out_of_range")))
    checked = df
    if check_unique:
        # counted with partial aggregation and joined back: a hot key stays spread over tasks
        dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
        checked = df.join(dup.withColumn("_dup", F.lit(True)), key, "left")
        reasons.append(F.when(F.col("_dup"), F.lit("duplicate_key")))
    checked = checked.withColumn("reject_reason", F.concat_ws(";", F.array_compact(F.array(*reasons))))
    return checked.drop("_dup")


def check_constraints(df: DataFrame, table: str = "job_vacancies", key: str | None = None,
                      not_null: Sequence[str] | None = None, check_unique: bool = True,
                      strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejects) by ``constraint_reasons``.

    ``strict`` raises if there are rejects, as the warehouse does: the checked
    rows are written once, and counted in that same pass.
    """
    checked = constraint_reasons(df, table, key, not_null, check_unique)
    return split_checked(written_checked(checked, table, strict) if strict else checked)


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of the rows of ``constraint_reasons``."""
    return checked.filter(F.col("reject_reason") == "").drop("reject_reason"), checked.filter(F.col("reject_reason") != "")


def written_checked(checked: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """The rows of ``constraint_reasons`` written once; ``strict`` raises if that same pass counted rejects."""
    from ..sources.snapshot import written
    seen = Observation()
    out = written(checked.observe(seen, F.count_if(F.col("reject_reason") != "").alias("rejects")), f"checked-{table}")
    if strict and seen.get["rejects"]:
        raise ValueError(f"{seen.get['rejects']} rows violate {table} constraints")
    return out


# ------------------------------------------------------------ replay

def replay(current: DataFrame, batches: Sequence[tuple], days: int = 3) -> DataFrame:
    """Fold dated batches through upsert then close, in date order.

    ``batches`` holds ``(as_of, batch_df)``; an as_of with ``None`` batch still
    closes stale rows.  Each step's state is checkpointed so the lineage stays
    one step deep.
    """
    state = current
    ensure_checkpoint_dir(current.sparkSession)
    for as_of, batch in sorted(batches, key=lambda t: str(t[0])):
        if batch is not None:
            state = upsert_jobs(state, batch, as_of)
        state = close_stale(state, as_of, days).checkpoint(eager=True)
    return state


def replay_closed_form(sightings: DataFrame, as_of, key: str = "job_url", seen: str = "seen_at",
                       order: Sequence[str] = ("pos",), days: int = 3,
                       columns: Sequence[str] | None = None) -> DataFrame:
    """G8 in closed form: the state after daily runs up to ``as_of``.

    ``columns`` names the output columns wanted (default: all).  Only those are
    carried, so the rules behind the others are pruned from the plan.

    A run on day d stamps ``last_seen = d`` on every key seen that day and
    closes active keys last seen before ``d - days``.  So a key seen on days
    s1 < ... < sk is active iff ``sk >= as_of - days``; it was closed on the
    day ``s + days + 1`` after every gap longer than ``days + 1`` days, and
    ``closed_at`` holds the last such day.  Refreshable columns come from the
    first row of the last day, the others from the first row of the first day.

    One aggregation per key, with partial aggregation before the shuffle: the
    key's distinct sighting days (at most one per calendar day of the history,
    whatever the key's row count), its first row by (day, order) and the first
    row of its last day.  The gaps are then read off the sorted day array.
    """
    day = F.to_date(F.col(seen))
    wanted = [c for c in BATCH_COLS if columns is None or c in columns]
    refreshed = set(UPSERT_REFRESH)
    held = {"_first": [c for c in wanted if c != key and c not in refreshed], "_last": [c for c in wanted if c in refreshed]}
    first_rank = F.struct(day.alias("d"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    # the first row of the last day: latest day, then smallest order (any orderable type)
    last_rank = F.struct((-F.datediff(day, F.lit("1970-01-01"))).alias("d"),
                         *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    best = [F.min_by(F.struct(*names), rank).alias(at) for (at, names), rank in zip(held.items(), (first_rank, last_rank)) if names]
    agg = sightings.groupBy(key).agg(F.sort_array(F.collect_set(day)).alias("_days"), *best)
    end = F.to_date(_ts(as_of))
    n = F.size("_days")
    closing = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when(
            (F.date_add(F.element_at("_days", i + 1), days + 1) <= end)
            & ((i == n - 1) | (F.element_at("_days", i + 2) > F.date_add(F.element_at("_days", i + 1), days + 1))),
            F.date_add(F.element_at("_days", i + 1), days + 1)))
    cols = [F.col(key) if c == key else F.col(f"{'_last' if c in refreshed else '_first'}.{c}").alias(c)
            for c in wanted]
    d0, d1 = F.element_at("_days", 1), F.element_at("_days", -1)
    times = {"scraped_at": d0.cast("timestamp_ntz"), "last_seen": d1.cast("timestamp_ntz"),
             "is_active": d1 >= F.date_sub(end, days), "closed_at": F.array_max(closing).cast("timestamp_ntz")}
    return agg.select(*cols, *[v.alias(k) for k, v in times.items() if columns is None or k in columns])


# ------------------------------------------------------------ replay in steps

#: What a step carries per key beside the rows: the first and last sighting day, and the last day a gap closed it.
STATE_DAYS = ("first_day", "last_day", "closed_day")


def interval_state(sightings: DataFrame, key: str = "job_url", seen: str = "seen_at",
                   order: Sequence[str] = ("pos",), days: int = 3) -> DataFrame:
    """G8 as mergeable state: one row per key of fixed width, whatever the length of the history.

    ``first`` and ``last`` are the key's first row of its first and of its last day
    (as structs).  Sightings are reduced to one row per key and day before
    they meet (partial aggregation), then neighbouring days give the gaps.
    """
    day = F.to_date(F.col(seen))
    row = F.struct(*[c for c in BATCH_COLS if c != key])
    daily = (sightings.groupBy(F.col(key), day.alias("_day"))
             .agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_row")))
    before = F.lag("_day").over(Window.partitionBy(key).orderBy("_day"))
    end = F.date_add(before, days + 1)
    gaps = daily.withColumn("_closed", F.when(F.col("_day") > end, end))
    return gaps.groupBy(key).agg(
        F.min("_day").alias("first_day"), F.max("_day").alias("last_day"), F.max("_closed").alias("closed_day"),
        F.min_by("_row", "_day").alias("first"), F.max_by("_row", "_day").alias("last"))


def merge_states(earlier: DataFrame, later: DataFrame, key: str = "job_url", days: int = 3) -> DataFrame:
    """The state over two spans of days; every day of ``earlier`` lies before every day of ``later``.

    A step of a daily load merges the stored state with the day's.  The gap
    between a key's last day in the one and first day in the other closes it if it is long enough.
    """
    a = earlier.select(F.col(key), *[F.col(c).alias(f"_a_{c}") for c in (*STATE_DAYS, "first", "last")])
    b = later.select(F.col(key), *[F.col(c).alias(f"_b_{c}") for c in (*STATE_DAYS, "first", "last")])
    end = F.date_add("_a_last_day", days + 1)
    between = F.when(F.col("_b_first_day") > end, end)
    return a.join(b, key, "full_outer").select(
        key, F.coalesce("_a_first_day", "_b_first_day").alias("first_day"), F.coalesce("_b_last_day", "_a_last_day").alias("last_day"),
        F.coalesce("_b_closed_day", between, "_a_closed_day").alias("closed_day"),
        F.coalesce("_a_first", "_b_first").alias("first"), F.coalesce("_b_last", "_a_last").alias("last"))


def state_at(state: DataFrame, as_of, key: str = "job_url", days: int = 3) -> DataFrame:
    """The postings of a state after the run of ``as_of`` (as ``replay_closed_form``)."""
    end = F.to_date(_ts(as_of))
    overdue = F.date_add("last_day", days + 1)
    cols = [F.col(key) if c == key else F.col(f"{'last' if c in UPSERT_REFRESH else 'first'}.{c}").alias(c) for c in BATCH_COLS]
    return state.select(
        *cols, F.col("first_day").cast("timestamp_ntz").alias("scraped_at"), F.col("last_day").cast("timestamp_ntz").alias("last_seen"),
        (F.col("last_day") >= F.date_sub(end, days)).alias("is_active"),
        F.coalesce(F.when(overdue <= end, overdue), "closed_day").cast("timestamp_ntz").alias("closed_at"))
