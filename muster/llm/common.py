"""Helpers that several operators share: staged tables, row keys, ranks without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.llm.shipping import shipped
from muster.sources.tables import read_table, shared_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, "documents", sf_dir)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written to the cluster's shared folder and read back: lineage ends there, and a lost executor loses nothing."""
    spark = shipped(df.sparkSession)
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """64-bit hash of a text; null and empty differ."""
    return F.xxhash64(text, text.isNull())


def ranked(df: DataFrame, group: Sequence[str], block: str, order: Sequence[str | Column], name: str) -> DataFrame:
    """Adds the row's 0-based place in its group, blocks in ascending order and rows by `order` within a block.

    Rows are numbered within (group, block), blocks are counted, and a running sum of the counts joins both: no task
    holds a group, only one block of it and one small row for each of its blocks.
    """
    local = Window.partitionBy(*group, block).orderBy(*order)
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*group, block)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    numbered = df.withColumn("_local", F.row_number().over(local) - 1)
    same = [numbered[c].eqNullSafe(starts[c]) for c in (*group, block)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    kept = [numbered[c] for c in df.columns]
    return numbered.join(starts, on).select(*kept, (F.col("_before") + F.col("_local")).cast("long").alias(name))


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is on this machine; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)
