"""Named queries over the supplied tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from muster.sources.tables import Catalog

Query = Callable[[Catalog], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


class Registry:
    def __init__(self) -> None:
        self.entries: dict[str, Entry] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.entries:
                raise ValueError(f"query {name} registered twice")
            self.entries[name] = Entry(fn, sql)
            return fn

        return register

    def callables(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bind(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
            return lambda spark, sf_dir: entry.run(Catalog(spark, sf_dir))

        return {name: bind(e) for name, e in self.entries.items()}

    def sql(self) -> dict[str, str]:
        return {name: e.sql for name, e in self.entries.items() if e.sql}
