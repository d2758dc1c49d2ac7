"""A training-data pipeline over the documents: reject poor texts, keep one of each group of near copies, blank out
secrets, mix the sources, and encode to pieces. Every stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewright.llm import jaccard, mixing, pieces, quality, secrets
from ratewright.storage import materialise


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the factorisation machine scores at 0.3 or more; fitted on the given documents."""
    machine = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accept(docs, machine)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, with the smallest id, of each component of documents linked at a Jaccard of 0.75."""
    return jaccard.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; no row goes."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream: a row for each time a document is taken, in order of virtual finish time."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_ids and exact of every row."""
    return pieces.encode(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality", accept_quality),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

# A fitted machine, near copies and a piece vocabulary are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
