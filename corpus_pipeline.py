"""A corpus pipeline of five operators: language, near duplicates, benchmark leaks, personal data, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Between stages the documents are written to the shared folder and read back. The stages' models
and decisions have no SQL form, so there is no oracle; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.llm import decontamination, jaccard_join, language_id, mixing, pii
from popforge.llm.shared import crc_mod, table, written

#: Near duplicates: words of a shingle, and the least percentage of common shingles.
SHINGLE, PERCENT = 5, 80
#: A prediction with less than this share of the evidence is no language.
LEAST_LANGUAGE_SCORE = 0.5

ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts that are null or without a letter go."""
    model = language_id.fit(docs.where(crc_mod("doc_id", 4) != 2))
    # columns of documents may have the names of the operator's
    other = {c: f"kept_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    judged = language_id.predict(docs.select("doc_id", "text", *[F.col(c).alias(k) for c, k in other.items()]), model)
    known = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return known.select([F.col(other.get(c, c)).alias(c) for c in docs.columns])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return jaccard_join.representatives(docs, SHINGLE, PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars brought up to date."""
    redacted = pii.scan(docs, pii.fit(docs), with_text=True)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies and the words taken of each."""
    mixed = mixing.mix(docs, keep=[c for c in docs.columns if c not in ("doc_id", "size", "source_size", "target", "copies", "taken")])
    return mixed.where("copies > 0")


STAGES = [
    ("language ID", keep_known_language),
    ("near duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
