"""Small helpers shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquarry.session import configure


class Tables:
    """The sample tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = configure(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)  # read the schema once
        return table


class Catalog:
    """Queries by name, with the SQL that gives the same rows."""

    def __init__(self) -> None:
        self.runs: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        def register(build: Callable[[Tables], DataFrame]) -> Callable:
            name = build.__name__
            if name in self.runs:
                raise ValueError(f"query {name!r} is registered twice")
            self.runs[name] = lambda spark, folder: build(Tables(spark, folder))
            if sql is not None:
                self.sql[name] = sql
            return build
        return register

    def add_all(self, other: Catalog) -> None:
        if self.runs.keys() & other.runs.keys():
            raise ValueError("a query name is used twice")
        self.runs.update(other.runs)
        self.sql.update(other.sql)
