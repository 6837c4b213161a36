"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Base kinds (email, ip, card, phone) are found by patterns and arithmetic checks;
their spans always stand.  Beside them, generators of high recall propose
spans, overlapping ones too: spelled-out addresses, number chains, long tokens,
assignments.  Boosted trees score each candidate from its format and its
context, thresholds calibrated per generator on held-back candidates decide,
and of overlapping winners the best stays.

The trees are fitted by Spark ML on the candidates of all documents, equal ones
counted together, with weak labels: formats that prove themselves (check digits, octet
ranges, well-formed addresses, a naming word in front).  They are then written out as one SQL
expression, so scoring is a projection without shuffle, collect or Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.llm.store import written

# The base patterns.  Guards at a run's start and possessive
# repeats keep the leftmost matches as they are and the search linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What has to be in a text for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
GENERATORS = {
    "contact": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "number": r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
    "token": r"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{16,}+",
    "assigned": r"(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\x20?[=:]\x20?[\"']?"
                r"[A-Za-z0-9+/_=.-]{6,}+[\"']?",
}
TREES, DEPTH = 12, 3
#: Precision on held-back candidates that a threshold has to reach.
PRECISION = 0.95
SECRET_WORDS = r"(?i)(?:password|passwd|pwd|secret|token|key|hash|credential)[^a-z]{0,4}$"
CONTACT_WORDS = r"(?i)(?:phone|tel|call|fax|mobile|card|account|iban|mail|contact|ip|host)[^a-z]{0,4}$"
SPAN = "array<struct<start:int,end:int>>"


def located(df: DataFrame, patterns: dict[str, str], needs: dict[str, str | None]) -> DataFrame:
    """Adds ``<kind>_m`` (matches) and ``<kind>_g`` (the text between them, one more than matches)."""
    text = F.col("text")
    found = df.withColumns({
        f"{k}_m": F.regexp_extract_all("text", F.lit(p), F.lit(0)) if not needs.get(k) else
        F.when(F.contains(text, F.lit(needs[k])), F.regexp_extract_all("text", F.lit(p), F.lit(0)))
        for k, p in patterns.items()})
    return found.withColumns({
        f"{k}_g": F.when(F.size(f"{k}_m") > 0, F.split("text", p, -1)) for k, p in patterns.items()})


def spans(kind: str, valid: str) -> Column:
    """Spans of the matches ``m`` that are ``valid``, in code points, end exclusive."""
    return F.expr(f"""coalesce(aggregate(
        arrays_zip(slice({kind}_g, 1, size({kind}_m)), {kind}_m),
        named_struct('pos', 0, 'out', cast(array() AS {SPAN})),
        (a, x) -> named_struct('pos', a.pos + length(x['0']) + length(x.{kind}_m),
            'out', CASE WHEN {valid.format(m=f'x.{kind}_m')} THEN concat(a.out, array(named_struct(
                'start', a.pos + length(x['0']), 'end', a.pos + length(x['0']) + length(x.{kind}_m)))) ELSE a.out END),
        a -> a.out), cast(array() AS {SPAN}))""")


DIGITS = "regexp_replace({m}, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": "forall(split({m}, '[.]'), p -> CASE WHEN length(ltrim('0', p)) <= 3 "
          "THEN coalesce(try_cast(concat('0', ltrim('0', p)) AS int), 999) <= 255 ELSE false END)",
    "card": f"CASE WHEN length({DIGITS}) BETWEEN 13 AND 19 THEN luhn_check({DIGITS}) ELSE false END",
    "phone": f"length({DIGITS}) BETWEEN 9 AND 15",
}

def features(m: str, before: str, after: str) -> list[str]:
    """SQL of a candidate's features: format first, then context."""
    digits = DIGITS.format(m=m)
    return [
        f"length({m})", f"length({digits})", f"regexp_count({m}, '[a-z]')", f"regexp_count({m}, '[A-Z]')",
        f"regexp_count({m}, '[.]')", f"regexp_count({m}, '[ ()/-]')", f"instr({m}, '@') > 0", f"startswith({m}, '+')",
        f"regexp_count({m}, '[0-9][A-Za-z]|[A-Za-z][0-9]')", f"{m} RLIKE '^[0-9a-f]+$'", f"{m} RLIKE '[=:]'",
        f"size(array_distinct(split(left({m}, 64), ''))) / least(length({m}), 64)",
        f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN luhn_check({digits}) ELSE false END",
        f"regexp_count({m}, '[0-9]+') ", f"{before} RLIKE r'{SECRET_WORDS}'", f"{before} RLIKE r'{CONTACT_WORDS}'",
        f"{before} RLIKE '[A-Za-z0-9]$'", f"{after} RLIKE '^[A-Za-z0-9]'", f"{before} RLIKE '[\\\"=:] ?$'",
    ]


def weak_label(kind: str, m: str, before: str) -> str:
    """SQL: whether a candidate's format, or the word in front of it, proves it."""
    digits = DIGITS.format(m=m)
    if kind == "contact":
        return f"{m} RLIKE r'^[A-Za-z0-9._%+-]+ ?(@|.at.) ?[A-Za-z0-9-]+( ?([.]|.dot.) ?[A-Za-z0-9-]+)*( ?([.]|.dot.) ?[A-Za-z]{{2,}})$'"
    if kind == "number":
        return (f"CASE WHEN startswith({m}, '+') THEN length({digits}) BETWEEN 9 AND 15 WHEN {m} RLIKE '^[0-9 -]+$' "
                f"AND length({digits}) BETWEEN 13 AND 19 THEN luhn_check({digits}) WHEN {m} RLIKE '^[0-9]+([.][0-9]+){{3}}$' THEN "
                + VALID["ip"].format(m=m) + " ELSE false END")
    if kind == "token":
        return (f"({before} RLIKE r'{SECRET_WORDS}' OR {m} RLIKE '^AKIA[A-Z0-9]{{16}}$' OR {m} RLIKE "
                f"'(?i)^(password|secret|token|key)=') AND {m} RLIKE '[0-9]'")
    return f"{m} RLIKE '[0-9]' OR {m} RLIKE '[\\\"]'"


N_FEATURES = len(features("m", "b", "a"))
STRUCT = ("struct<kind:int,start:int,end:int,label:int,"
          + ",".join(f"f{i}:double" for i in range(N_FEATURES)) + ">")


def candidates(kind: str) -> Column:
    """All candidates of a generator with their features and weak labels."""
    m, before, after = f"x.{kind}_m", "right(x['0'], 24)", "left(x['1'], 12)"
    number = list(GENERATORS).index(kind)
    values = ", ".join(f"'f{i}', cast({f} AS double)" for i, f in enumerate(features(m, before, after)))
    return F.expr(f"""coalesce(aggregate(
        arrays_zip(slice({kind}_g, 1, size({kind}_m)), slice({kind}_g, 2, size({kind}_m)), {kind}_m),
        named_struct('pos', 0, 'out', cast(array() AS array<{STRUCT}>)),
        (a, x) -> named_struct('pos', a.pos + length(x['0']) + length({m}), 'out', concat(a.out, array(named_struct(
            'kind', {number}, 'start', a.pos + length(x['0']), 'end', a.pos + length(x['0']) + length({m}),
            'label', cast({weak_label(kind, m, before)} AS int), {values})))),
        a -> a.out), cast(array() AS array<{STRUCT}>))""")


def proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, candidates`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return located(rows, GENERATORS, {"contact": None}).select(
        "doc_id", F.concat(*(candidates(k) for k in GENERATORS)).alias("candidates"))


@dataclass
class SpanModel:
    """Score of a candidate ``x`` as SQL, and the threshold of each generator."""

    score: str
    thresholds: dict[str, float]


def tree_sql(lines: list[str]) -> str:
    """SQL of one tree from its printed form; consumes ``lines``."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return f"{float(line.split(':')[1])!r}D"
    test = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
    yes = tree_sql(lines)
    lines.pop(0)  # Else
    return f"(CASE WHEN x.f{test[1]} <= {float(test[2])!r}D THEN {yes} ELSE {tree_sql(lines)} END)"


def counted_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The candidates of all documents, those of one half, kind, label and features as one row with their number ``n``."""
    rows = proposed(docs, id_col, text_col).select(
        F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"), F.explode("candidates").alias("x"))
    names = [f"f{i}" for i in range(N_FEATURES)]
    return rows.groupBy("half", "x.kind", "x.label", *(f"x.{f}" for f in names)).agg(F.count("*").alias("n"))


def fit_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanModel | None:
    """Fit trees on the candidates of one half of the documents and thresholds on those of the other.

    Equal candidates weigh as many as they are.  None where there are no
    candidates of both labels.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = written(counted_candidates(docs, id_col, text_col), "pii-candidates")
    names = [f"f{i}" for i in range(N_FEATURES)]
    fit = VectorAssembler(inputCols=names, outputCol="features").transform(
        rows.filter("half = 0").select(F.col("label").cast("double").alias("label"), F.col("n").cast("double").alias("n"), *names))
    if fit.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11, maxBins=32, weightCol="n").fit(fit)
    trees = []
    for tree, weight in zip(model.trees, model.treeWeights):
        lines = [x for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        trees.append(f"{weight!r}D * {tree_sql(lines)}")
    score = f"1D / (1D + exp(-2D * ({' + '.join(trees)})))"
    held = rows.filter("half = 1").select("kind", "label", "n", F.struct(*names).alias("x"))
    bins = (held.select("kind", "label", "n", F.floor(F.expr(score) * 50).cast("int").alias("bin"))
            .groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good")).collect())
    thresholds = {}
    for i, kind in enumerate(GENERATORS):
        least, total, good = 0.9, 0, 0
        for r in sorted((r for r in bins if r["kind"] == i), key=lambda r: -r["bin"]):
            total, good = total + r["n"], good + r["good"]
            if good >= PRECISION * total and r["bin"] >= 15:
                least = min(least, r["bin"] / 50)
        thresholds[kind] = least
    return SpanModel(score, thresholds)


def personal_data(docs: DataFrame, model: SpanModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base spans of each kind, ``added`` and the text.

    ``added`` holds, by generator and start, the candidates over their
    threshold that overlap no base span and no better candidate.  Null and
    empty texts have no spans.  Without a model nothing is added.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = located(rows, BASE, NEEDS).select("doc_id", "text", *(spans(k, VALID[k]).alias(k) for k in BASE))
    base = base.withColumn("base", F.concat(*BASE))
    if model is None:
        return base.select("doc_id", "text", *BASE, F.expr("cast(array() AS array<struct<kind:int,start:int,end:int>>)").alias("added"))
    with_all = located(base, GENERATORS, {}).select(
        "doc_id", "text", *BASE, "base", F.concat(*(candidates(k) for k in GENERATORS)).alias("candidates"))
    least = "element_at(array(" + ", ".join(f"{model.thresholds[k]!r}D" for k in GENERATORS) + "), x.kind + 1)"
    scored = with_all.withColumn("scored", F.expr(
        f"transform(candidates, x -> named_struct('score', {model.score}, 'kind', x.kind, 'start', x.start, 'end', x.end))"))
    won = scored.withColumn("won", F.expr(
        f"""reverse(array_sort(filter(scored, x -> x.score >= {least}
            AND NOT exists(base, b -> b.start < x.end AND x.start < b.end))))"""))
    kept = "array<struct<kind:int,start:int,end:int>>"
    return won.select("doc_id", "text", *BASE, F.expr(f"""array_sort(aggregate(won, cast(array() AS {kept}), (a, x) ->
        CASE WHEN exists(a, b -> b.start < x.end AND x.start < b.end) THEN a
        ELSE concat(a, array(named_struct('kind', x.kind, 'start', x.start, 'end', x.end))) END))""").alias("added"))


def span_digests(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of the base spans, all spans as text, and the number of added ones."""
    shown = [F.expr(f"transform({k}, x -> concat('{k}:', x.start, ':', x.end))") for k in BASE]
    names = "array(" + ", ".join(f"'{k}'" for k in GENERATORS) + ")"
    base = F.array_join(F.concat(*shown), ",")
    every = F.array_join(F.concat(*shown, F.expr(
        f"transform(added, x -> concat(element_at({names}, x.kind + 1), ':', x.start, ':', x.end))")), ",")
    return found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
                        F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(found: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in brackets; overlapping spans merge."""
    labelled = [F.expr(f"transform({k}, x -> named_struct('start', x.start, 'end', x.end, 'kind', '{k}'))") for k in BASE]
    names = "array(" + ", ".join(f"'{k}'" for k in GENERATORS) + ")"
    labelled.append(F.expr(f"transform(added, x -> named_struct('start', x.start, 'end', x.end, 'kind', element_at({names}, x.kind + 1)))"))
    cut = found.withColumn("__all", F.array_sort(F.concat(*labelled)))
    return cut.select("doc_id", F.expr(f"""aggregate(__all, named_struct('upto', 0, 'out', ''), (a, x) -> named_struct(
        'upto', greatest(a.upto, x.end),
        'out', CASE WHEN x.start < a.upto THEN a.out
               ELSE concat(a.out, substring({text_col}, a.upto + 1, x.start - a.upto), '[', x.kind, ']') END),
        a -> concat(a.out, substring({text_col}, a.upto + 1)))""").alias("text"))
