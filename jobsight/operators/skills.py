"""Skill matching and id resolution.

``match_keywords`` is one narrow projection: per keyword a cheap substring test
guards a literal-pattern ``rlike`` (compiled once per task), the hits are
gathered into an array and exploded.  It stays inside whole-stage codegen and
needs neither a shuffle nor a join against the dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SKILL_KEYWORDS
from ..sources.snapshot import written
from .dedup import distinct_pairs
from .lifecycle import insert_absent


def keyword_pattern(keyword) -> Column:
    """Java regex for ``\\b`` + literal lower-cased keyword + ``\\b`` (Unicode words)."""
    k = F.lit(keyword) if isinstance(keyword, str) else keyword
    return F.concat(F.lit(r"(?U)\b\Q"), F.lower(k), F.lit(r"\E\b"))


def keyword_hits(text, keywords: Sequence[str] = SKILL_KEYWORDS) -> Column:
    """Array of the distinct keywords (original spelling) found in the lower-cased ``text``."""
    t = F.col(text) if isinstance(text, str) else text
    none = F.array().cast("array<string>")
    parts = []
    for kw in dict.fromkeys(keywords):
        hit = t.contains(F.lower(F.lit(kw))) & F.rlike(t, keyword_pattern(kw))
        parts.append(F.when(hit, F.array(F.lit(kw))).otherwise(none))
    return F.flatten(F.array(*parts)) if parts else none


def match_keywords(df: DataFrame, text: str, keywords: Sequence[str] = SKILL_KEYWORDS,
                   keep: Sequence[str] = (), out: str = "skill_name") -> DataFrame:
    """One row per (kept columns, matched keyword)."""
    return df.select(*keep, F.explode(keyword_hits(text, keywords)).alias(out))


# Word characters; the most frequent ones are told apart first.
_WORD = r"[a-z0-9\w]"
WORD_RUN = rf"(?U){_WORD}+"
#: Two neighbouring words with what stands between them; the next match begins at the second word.
WORD_PAIR = rf"(?U)(?<!{_WORD})(?=({_WORD}++[^a-z0-9\w]++{_WORD}++)){_WORD}++"


def match_keywords_join(df: DataFrame, text: str, keywords, keep: Sequence[str] = (),
                        out: str = "skill_name") -> DataFrame:
    """E3 for large dictionaries (a list or a one-column DataFrame), as equi-joins.

    Same rows as ``match_keywords``; the caller picks the plan.  A keyword can
    only match a text that holds each of its words as a word, so it is
    joined on one of them, the one that the fewest texts hold (its anchor);
    a keyword with a word that no text holds is dropped.  What is shuffled are the
    distinct words of each text, whatever the lengths of the keywords, with a 128-bit hash of the text
    in place of the row; texts come back to their candidates by that hash.  There one
    word by itself needs no check, two words are looked up among the
    text's pairs of neighbouring words, which are cut out once per text, and other
    keywords are checked by the regex, after a plain substring test.  A keyword without any word character is matched by the
    regex projection; such keywords (strings of signs) are collected.

    Each (row, keyword) pair comes out once per input row.
    """
    spark = df.sparkSession
    table = keywords if isinstance(keywords, DataFrame) else spark.createDataFrame(
        [(k,) for k in dict.fromkeys(keywords)], "skill_name string")
    kw = table.select(F.col(table.columns[0]).alias("_kw")).filter("_kw IS NOT NULL").distinct().withColumn("_low", F.lower("_kw"))
    low = F.col("_low")
    words_of = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(WORD_RUN), F.lit(0)))
    kind = F.when(F.rlike(low, F.lit(r"(?Us)^\w+\z")), 1).when(F.rlike(low, F.lit(r"(?Us)^\w+\W+\w+\z")), 2).otherwise(0)
    lows = kw.select("_low").distinct().select("_low", words_of(low).alias("_words"), kind.alias("_kind"))
    t = F.col(text)
    name = [F.xxhash64(t).alias("_r1"), F.xxhash64(F.lit(1), t).alias("_r2")]
    words = df.select(*name, F.explode(words_of(t)).alias("_word"))
    needed = lows.select("_low", "_kind", F.size("_words").alias("_n"), F.explode("_words").alias("_word"))
    held = words.join(needed.select("_word").distinct(), "_word").groupBy("_word").agg(F.count(F.lit(1)).alias("_texts"))
    anchors = (needed.join(held, "_word").groupBy("_low", "_kind", "_n")
               .agg(F.count(F.lit(1)).alias("_found"), F.min(F.struct("_texts", "_word")).alias("_rarest"))
               .filter("_found = _n").select("_low", "_kind", F.col("_rarest._word").alias("_word")))
    anchors = written(anchors, "anchors")  # a table of known size: a small one is joined where the words lie
    # the sets are as large as a text has words that anchor keywords
    candidates = (words.join(anchors, "_word").groupBy("_r1", "_r2")
                  .agg(*(F.collect_set(F.when(F.col("_kind") == k, low)).alias(f"_c{k}") for k in range(3))))
    pairs = F.when(F.size("_c2") > 0, F.array_intersect("_c2", F.regexp_extract_all("_text", F.lit(WORD_PAIR), F.lit(1)))).otherwise(F.col("_c2"))
    other = F.filter("_c0", lambda k: F.contains("_text", k) & F.rlike("_text", keyword_pattern(k)))
    checked = (df.select(*keep, t.alias("_text"), *name).join(candidates, ["_r1", "_r2"])
               .select(*keep, F.explode(F.concat("_c1", pairs, other)).alias("_low"))
               .join(kw, "_low").select(*keep, F.col("_kw").alias(out)))
    signs = [r["_kw"] for r in kw.join(lows.filter("size(_words) = 0"), "_low").select("_kw").collect()]
    return checked.unionByName(match_keywords(df, text, signs, keep=keep, out=out)) if signs else checked


def resolve_job_id(batch: DataFrame, jobs: DataFrame, key: str = "job_url") -> DataFrame:
    """Attach ``job_id`` by url; unmatched batch rows are skipped."""
    return batch.join(jobs.select("job_id", key), key, "inner")


def resolve_course_id(batch: DataFrame, courses: DataFrame, title: str = "course_title") -> DataFrame:
    """Attach ``course_id`` by title; one id per stored title (the largest)."""
    ids = courses.groupBy(title).agg(F.max("course_id").alias("course_id"))
    return batch.join(ids, title, "inner")


def append_skills(existing: DataFrame, owners: DataFrame, text: str, id_col: str,
                  keywords: Sequence[str] = SKILL_KEYWORDS) -> DataFrame:
    """Add the (owner, skill) pairs found in ``owners``; pairs never disappear."""
    found = distinct_pairs(match_keywords(owners, text, keywords, keep=[id_col]), [id_col, "skill_name"])
    return insert_absent(existing.select(id_col, "skill_name"), found, [id_col, "skill_name"], owner=id_col)
