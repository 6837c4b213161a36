"""The corpus pipeline: stages applied one after the other to ``documents``.

Every stage takes what its predecessor kept and, but for the last, returns rows
of ``documents`` with all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.catalog import model_path
from jobsight.llm.decontaminate import drop_contaminated
from jobsight.llm.exact_dedup import drop_exact_duplicates
from jobsight.llm.jaccard_join import drop_near_duplicates
from jobsight.llm.piece_bpe import encode_digests
from jobsight.llm.store import table, written
from jobsight.llm.toxicity import fit_toxicity, toxicity_score

#: Documents with this score or more go.
TOXIC_SCORE = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; the lexicon is learned from the labelled rows."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity_score(F.col("text"), model) < TOXIC_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z as a-z) the one with the largest doc_id stays."""
    return drop_exact_duplicates(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more in five-word shingles one stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def piece_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents left."""
    return encode_digests(docs, model_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", piece_bpe),
]

# The stages learn a model and follow links to any depth, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
