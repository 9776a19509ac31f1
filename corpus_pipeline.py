"""Training corpus pipeline: quality rules, line dedup, near-duplicate join, benchmark
decontamination, packing.

Each stage takes all rows that its predecessor kept and returns the columns of
``documents`` (the last returns the packed pieces).  ``run`` writes every stage to the
cluster's shared checkpoint folder and reads it again, as a scheduler of the stages would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfeat.llm import decontam, jaccard, linededup, packing, quality
from eventfeat.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in five documents or more stay in the one with the largest id only;
    ``n_chars``, where the table has it, follows the text."""
    out = linededup.dedup_lines(docs).drop("__n_lines", "__n_dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, or an edited copy of one, go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.piece_report(packing.pack(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]

#: tokenizing and alignment have no SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
