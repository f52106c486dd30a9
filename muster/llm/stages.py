"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on all rows of `docs`."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import contained, lines, near, packing, weak
from muster.llm.common import text_key, vocabulary
from muster.llm.shipping import shipped
from muster.sources.tables import read_table


def _stage(fn):
    """A stage that first sees to it that the executors have this package."""

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return fn(shipped(spark), docs, sf_dir)

    return run


def _only(docs: DataFrame, light: DataFrame, once: bool = False) -> DataFrame:
    """The rows of `docs` whose (doc_id, text hash) is in `light`, all columns as they are; `once`: equal rows once."""
    wanted = light.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).distinct()
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_doc"), text_key(F.col("text").cast("string")).alias("_key")
    )
    kept = keyed.join(wanted, (F.col("_key") == F.col("_k")) & F.col("_doc").eqNullSafe(F.col("_d")), "left_semi")
    if once:
        kept = kept.dropDuplicates(["_doc", "_key"])
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which neither fault is likelier than not. Labels come from the labels table."""
    return _only(docs, weak.scored(docs, read_table(spark, "labels", sf_dir)).where("kept"))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that stand earlier in the corpus; n_chars is the new text's length."""
    clean = lines.cleaned(docs)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("text").isNull(), F.col("row")["n_chars"]).otherwise(n)
    return clean.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Documents without words are in no group and stay. A row that repeats doc_id and text is kept once, and so is each text of
    a group in which no row has a doc_id.
    """
    return _only(docs, near.near_duplicates(docs).where("kept"), once=True)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    return _only(docs, contained.decontaminated(docs, read_table(spark, "benchmark", sf_dir)).where("n_hit = 0"))


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.packed(docs, vocabulary("byte_bpe_50k.tiktoken"))
