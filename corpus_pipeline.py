"""From raw documents to training tokens: the corpus operators one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, jaccard_join, line_dedup, queries, toxicity
from tidemark.llm.common import table, written


# Workers have served four stages before they encode: they keep fewer pieces.
PIECES_KEPT = 150_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model calls toxic go; the prior counts the stage's documents."""
    model = toxicity.fit(docs, queries.toxicity_labels(spark, sf_dir))
    return toxicity.score(docs, model).where(F.col("score") < 0.5).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go from the texts; ``n_chars`` follows."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of the smallest id."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document's ids and of the bytes they decode to."""
    return queries.token_digests(docs, PIECES_KEPT)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

# Log-odds, trees of sets and byte-pair merges have no plain SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
