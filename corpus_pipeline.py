"""The corpus pipeline: five stages, each the operator of that number over all rows that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes every stage's rows as
Parquet into the shared folder and reads them back for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import line_dedup, mixing, ngram_join, pieces, quality
from martlet.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and documents that the rules reject."""
    return quality.clean(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, but for the first; documents stay, perhaps with less text."""
    return line_dedup.line_dedup(docs).select(docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the smallest
    doc_id. Linked: 80 percent or more of their five-word shingles in common."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and N-best scores of every row, decoded again as a check."""
    return pieces.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The last stage searches a lattice, which SQL does not express; tests/llm compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_folder(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
