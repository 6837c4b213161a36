"""The corpus queries and their SQL; ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.collocations import collocations
from jobsight.llm.decontaminate import contamination
from jobsight.llm.exact_dedup import exact_duplicates
from jobsight.llm.html_text import extract_pages
from jobsight.llm.jaccard_join import near_duplicates
from jobsight.llm.pii import fit_spans, personal_data, span_digests
from jobsight.llm.line_dedup import line_digests
from jobsight.llm.periodic_runs import run_digests
from jobsight.llm.piece_bpe import encode_digests
from jobsight.llm.quality import fit_quality, quality_score
from jobsight.llm.sharding import SHARD_BYTES, assign_shards
from jobsight.llm.store import table
from jobsight.llm.textops import crc_mod
from jobsight.llm.toxicity import fit_toxicity, toxicity_score
from jobsight.llm.url_lists import HOST, filter_captures, host

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return span_digests(personal_data(docs, fit_spans(docs)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = fit_quality(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op6_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), model_path())


def captures_and_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``pages`` as captures with a day each, and dated list entries derived from all their hosts."""
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    number = lambda name: F.conv(F.substring(F.md5(name), 1, 7), 16, 10).cast("long")
    captures = table(spark, sf_dir, "pages").select("page_id", "url", day(F.col("page_id") * 37 % 365).alias("fetched_at"))
    hosts = captures.select(host(F.col("url")).alias("h")).filter("h <> ''").distinct().withColumn("x", number(F.col("h")))
    parents = (hosts.select(F.regexp_replace("h", r"^[^.]*\.", "").alias("h")).filter("contains(h, '.')").distinct()
               .withColumn("x", number(F.col("h"))))
    rows = [
        (hosts, "host:", "", "blocked_hosts", 2, "add", F.col("x") % 200),
        (hosts, "host:", "", "blocked_hosts", 6, "remove", F.col("x") % 200 + 40 + F.col("x") % 50),
        (hosts, "host:", "", "blocked_hosts", 12, "add", F.col("x") % 200 + 120),
        (parents, "domain:", "", "blocked_domains", 3, "add", F.col("x") % 300),
        (hosts, "path:", "/en/", "english_only", 5, "add", F.col("x") % 100),
        (hosts, "path:", "/en/", "english_only", 5, "remove", F.col("x") % 100 + 90),
    ]
    entries = None
    for source, lead, tail, name, every, action, at in rows:
        part = source.filter(F.col("x") % every == 0).select(
            F.lit(name).alias("list"), F.concat(F.lit(lead), F.col("h"), F.lit(tail)).alias("pattern"),
            F.lit(action).alias("action"), day(at).alias("at"))
        entries = part if entries is None else entries.unionByName(part)
    return captures, entries


def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_lists(spark, sf_dir)
    return filter_captures(captures, entries).withColumnRenamed("id", "page_id")


OP7_SQL = f"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched_at,
         regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '\\.$', '') AS h,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages
), hosts AS (
  SELECT h, CAST('0x' || substr(md5(h), 1, 7) AS BIGINT) AS x FROM (SELECT DISTINCT h FROM captures WHERE h <> '')
), parents AS (
  SELECT h, CAST('0x' || substr(md5(h), 1, 7) AS BIGINT) AS x
  FROM (SELECT DISTINCT regexp_replace(h, '^[^.]*\\.', '') AS h FROM hosts) WHERE contains(h, '.')
), entries AS (
  SELECT 'blocked_hosts' AS list, 'host:' || h AS pattern, 'add' AS action, x % 200 AS n FROM hosts WHERE x % 2 = 0
  UNION ALL SELECT 'blocked_hosts', 'host:' || h, 'remove', x % 200 + 40 + x % 50 FROM hosts WHERE x % 6 = 0
  UNION ALL SELECT 'blocked_hosts', 'host:' || h, 'add', x % 200 + 120 FROM hosts WHERE x % 12 = 0
  UNION ALL SELECT 'blocked_domains', 'domain:' || h, 'add', x % 300 FROM parents WHERE x % 3 = 0
  UNION ALL SELECT 'english_only', 'path:' || h || '/en/', 'add', x % 100 FROM hosts WHERE x % 5 = 0
  UNION ALL SELECT 'english_only', 'path:' || h || '/en/', 'remove', x % 100 + 90 FROM hosts WHERE x % 5 = 0
), days AS (
  SELECT list, pattern, DATE '2024-01-01' + CAST(n AS INTEGER) AS since, bool_and(action = 'add') AS added
  FROM entries GROUP BY ALL
), latest AS (
  SELECT DISTINCT c.page_id, c.url, d.list
  FROM captures c JOIN days d ON d.since <= c.fetched_at AND (
       d.pattern = 'host:' || c.h OR (starts_with(d.pattern, 'domain:') AND ('.' || c.h) LIKE ('%.' || substr(d.pattern, 8)))
       OR (starts_with(d.pattern, 'path:') AND starts_with(c.h || c.path, substr(d.pattern, 6))))
  WHERE d.added AND NOT EXISTS (SELECT 1 FROM days n WHERE n.list = d.list AND n.pattern = d.pattern AND NOT n.added
                                AND n.since > d.since AND n.since <= c.fetched_at)
), named AS (SELECT page_id, url, count(*) AS n, string_agg(list, ',' ORDER BY list) AS lists FROM latest GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_at, coalesce(n, 0) AS n_lists, coalesce(lists, '') AS lists, coalesce(n, 0) > 0 AS blocked
FROM captures c LEFT JOIN named USING (page_id, url)
"""


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


OP8_SQL = f"""
WITH copies AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, name, row_number() OVER (PARTITION BY name) - 1 AS nth
  FROM (SELECT *, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS name FROM documents)
), d AS (
  SELECT doc_id, n_bytes, CAST('0x' || CASE WHEN nth = 0 THEN name ELSE substr(md5(name || ':' || nth), 1, 15) END AS BIGINT) AS h FROM copies
), sums AS (
  SELECT depth, h >> (60 - depth) AS p, sum(n_bytes) AS whole
  FROM (SELECT h, n_bytes, unnest(range(0, 41)) AS depth FROM d WHERE n_bytes <= {SHARD_BYTES}) GROUP BY ALL
), placed AS (
  SELECT doc_id, n_bytes, h, min(depth) AS depth FROM d JOIN sums ON d.h >> (60 - depth) = p
  WHERE n_bytes <= {SHARD_BYTES} AND whole <= {SHARD_BYTES} GROUP BY ALL
), named AS (
  SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
         CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> CAST(60 - depth AS INTEGER)), CAST(depth AS INTEGER), '0') END AS shard FROM placed
  UNION ALL SELECT doc_id, n_bytes, 60, 'own:' || lpad(lower(hex(h)), 15, '0') FROM d WHERE n_bytes > {SHARD_BYTES}
)
SELECT doc_id, shard, depth, n_bytes, CAST(sum(n_bytes) OVER w AS BIGINT) AS shard_bytes, count(*) OVER w AS shard_docs
FROM named WINDOW w AS (PARTITION BY shard)
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP10_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n)
), hits AS (
  SELECT dw.doc_id, dw.n, dw.k, windows.item_id FROM doc_windows dw JOIN windows ON dw.n = windows.n AND dw.g = windows.g
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), tokens AS (
  SELECT lang, piece_id, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM pieces
), triples AS (
  SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM tokens WINDOW s AS (PARTITION BY piece_id ORDER BY i)
), f AS (
  SELECT lang, w1 AS phrase, count(*) AS f FROM triples GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2, count(*) FROM triples WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (
  SELECT lang, w1, w2, w3, count(*) AS a FROM triples WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, count(*) AS a, 1 AS k, w1 AS head, w2 AS tail FROM triples WHERE w2 IS NOT NULL
  GROUP BY lang, w1, w2 HAVING count(*) >= 10
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, 1, w1, w2 || ' ' || w3 FROM f3
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, 2, w1 || ' ' || w2, w3 FROM f3
), scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longest AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, w1 || ' ' || w2 AS phrase, a FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, a FROM f3) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longest USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
), totals AS (SELECT lang, count(*) AS n FROM tokens GROUP BY lang
), placed AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM kept JOIN totals USING (lang)
)
SELECT * FROM placed WHERE rank <= 2000
"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), common AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (SELECT lines.*, common.key IS NOT NULL AS gone FROM lines LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_html_text": op3_html_text,
    "op4_quality": op4_quality,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_piece_bpe": op6_piece_bpe,
    "op7_url_lists": op7_url_lists,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op7_url_lists": OP7_SQL,
    "op8_sharding": OP8_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_line_dedup": OP12_SQL,
}
