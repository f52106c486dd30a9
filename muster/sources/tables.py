"""Reading tables and finding the shared work folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """A catalog table, or `<base>/<name>.parquet` (a file or a folder) when a base folder is given."""
    if base is None:
        return spark.table(name)
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Catalog(Mapping):
    """Tables by name under one folder or in the session catalog, opened on first use."""

    def __init__(self, spark: SparkSession, base: str | None = None, **given: DataFrame):
        self._spark, self._base, self._open = spark, base, dict(given)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = read_table(self._spark, name, self._base)
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._open)

    def __len__(self) -> int:
        return len(self._open)


class RunScope(Mapping):
    """The tables of one run, and the row sets that its parts share.

    A shared set is written to the cluster's shared folder on first use and read from there by all later ones, so it is worked out
    once and a lost executor loses nothing of it. `close` removes what was written; until then frames made from the sets can be read.
    """

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables, self._sets, self._spark = tables, {}, None
        self._folder = ""

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> RunScope:
        return tables if isinstance(tables, cls) else cls(tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._sets:
            rows = build()
            if self._spark is None:
                self._spark = rows.sparkSession
                self._folder = shared_folder(self._spark, "run")
            with shuffles_freed(self._spark):
                rows.write.parquet(f"{self._folder}/{name}")
            self._sets[name] = self._spark.read.schema(rows.schema).parquet(f"{self._folder}/{name}")
        return self._sets[name]

    def close(self) -> None:
        if self._spark is not None:
            folder = self._spark._jvm.org.apache.hadoop.fs.Path(self._folder)
            folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)
        self._sets, self._spark = {}, None


def shared(tables: Mapping[str, DataFrame], name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The row set, shared where the tables are those of a run."""
    return tables.shared(name, build) if isinstance(tables, RunScope) else build()


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written in this block is read from its files from then on, so Spark removes its shuffle files as each write ends.

    Otherwise they stay on the disks until the driver's JVM happens to collect the plan.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder.

    Where spark.checkpoint.dir is unset, a session on this machine alone gets a temporary folder, and on a cluster, whose
    machines would each write to a disk of their own, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="muster-")


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, by name, in its order and types. A missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])
