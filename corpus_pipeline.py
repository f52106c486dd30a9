"""The corpus pipeline: quality classifier, line removal, near duplicates, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from muster.llm import stages
from muster.llm.common import documents, staged

#: Each function takes (spark, docs, sf_dir). All but the last return the columns of documents.
STAGES = [
    ("quality_classifier", stages.quality_classifier),
    ("line_dedup", stages.line_dedup),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing_stage),
]

#: No stage of this pipeline can be stated in SQL; tests/llm compares it with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written to the shared folder and read again as the next one's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
