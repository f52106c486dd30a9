"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Input partitions and their row counts are fixed by a written table of light columns. For each partition, the numbers of its rows that
go to each shard are drawn from the multivariate hypergeometric law over the places still open, so that every shard gets its
exact size and every assignment of rows to shards is equally likely. Within a partition, rows are put in random order and
dealt out by those numbers; behind the exchange, each shard's rows are put in random order again, cell by cell.

The driver holds one row of counts per partition (partitions times shards numbers), never a row of data. A shard is never in one task:
its second permutation is a sort by a random key, cut into cells, whose counts give each cell's first slot.

Defined cases: null texts have size 1 and checksum 0, like empty ones. Repeated rows are separate rows with separate slots. A null
doc_id takes part. Copies of a text are dealt like other rows: no key decides a row's place, so no text or id can make a
shard or a task large. Shard sizes differ by one at most, also with fewer rows than shards. The same table, layout and seed
give the same result, also when tasks are run again. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import staged

SHARDS, SEED = 16, 1234
CELL_ROWS = 10_000


def matrix(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Rows per (partition, shard): row sums are the counts, column sums differ by one at most."""
    total = int(counts.sum())
    open_places = np.full(shards, total // shards, np.int64)
    open_places[: total % shards] += 1
    rng = np.random.default_rng(seed)
    out = np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts.tolist()):
        left, places = n, int(open_places.sum())
        for s in range(shards):  # the law's marginals in turn; binomial-like draws of any size
            own = int(open_places[s])
            places -= own
            out[p, s] = _draw(rng, own, places, left)
            left -= out[p, s]
        open_places -= out[p]
    return out


def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One hypergeometric draw: how many of n rows, drawn from good + bad places, get good ones.

    numpy draws below 1e9 places. Above, the law is tabulated by its ratios within 12 standard deviations and inverted.
    """
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    total = good + bad
    if total < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    mean = n * (good / total)
    reach = 12 * (mean * (bad / total) * ((total - n) / (total - 1))) ** 0.5 + 5
    low, high = max(0, n - bad, int(mean - reach)), min(n, good, int(mean + reach))
    k = np.arange(low, high, dtype=float)
    ratio = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    log = np.concatenate([[0.0], np.cumsum(ratio)])
    law = np.cumsum(np.exp(log - log.max()))
    return low + int(np.searchsorted(law, rng.random() * law[-1], "right"))


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): each row once; slots of a shard run from 0 without a gap."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = staged(light.withColumn("partition", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "light")

    counts = {r[0]: r[1] for r in rows.groupBy("partition").agg(F.count(F.lit(1))).collect()}
    order = sorted(counts)
    sent = matrix(np.array([counts[p] for p in order], np.int64), shards, seed)
    starts = np.concatenate([np.zeros((len(order), 1), np.int64), np.cumsum(sent, axis=1)], axis=1)
    dealt = spark.createDataFrame([(p, starts[i, :-1].tolist()) for i, p in enumerate(order)], "partition int, starts array<long>")

    within = Window.partitionBy("partition").orderBy(F.xxhash64("row", F.lit(seed)), "row")
    placed = rows.withColumn("place", F.row_number().over(within) - 1).join(dealt, "partition")
    # a shard that gets none of the partition starts where the next one does; the last start at or below the place is the row's
    placed = placed.withColumn("shard", F.size(F.filter("starts", lambda x: x <= F.col("place"))) - 1)

    again = F.xxhash64("row", F.lit(seed + 1))
    n_cells = max(1, -(-sum(counts.values()) // (shards * cell_rows)))
    keyed = placed.select("doc_id", "size", "text_crc32", "row", "shard", again.alias("key"))
    keyed = staged(keyed.withColumn("cell", F.floor(F.shiftrightunsigned("key", 11) / float(2**53) * n_cells).cast("int")), "dealt")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = keyed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("key", "row")
    out = keyed.withColumn("slot", F.row_number().over(inside) - 1).join(cells, ["shard", "cell"])
    return out.select("doc_id", "size", "text_crc32", F.col("shard").cast("int"), (F.col("first") + F.col("slot")).cast("long").alias("slot"))
