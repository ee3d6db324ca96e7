"""A training-data pipeline over ``documents``: five stages, each an operator of ``evolve.llm``.

Every stage takes all that its predecessor kept and its decisions take effect: toxic
documents go, repeated lines go, one document of each group of near duplicates stays,
personal data is replaced by its kind, and what is left is packed into sequences.

A stage is (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of
``documents``, with ``n_chars`` counted anew where texts change. Between stages the rows
are written as Parquet to the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evolve.llm import line_dedup, near_duplicates, packing, pii, toxicity
from evolve.llm.common import table
from evolve.storage import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model is learned from their labels."""
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    sound = toxicity.score(docs.select("doc_id", "text"), model).where("score < 0.5").select(F.col("doc_id").alias("__sound")).distinct()
    return docs.join(sound, F.col("doc_id").eqNullSafe(F.col("__sound")), "leftsemi")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line that is near an earlier one goes, short ones if they equal it; so do documents that lose all their words by that."""
    out = line_dedup.apply(docs, line_dedup.decisions(docs.select("doc_id", "text"), exact=line_dedup.EXACT), emptied=False)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    kept = near_duplicates.near_duplicates(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "leftsemi")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs.select("doc_id", "text"), with_ids=False)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Tokens, learned scores and groups of near duplicates have no form in SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
