"""Relational databases as source and sink. Connection details come from the
caller or the environment, never from the code."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

WRITERS = 16  # connections of a write; ``numPartitions`` of a call overrides it


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)
    catalog: str = "select table_name from information_schema.tables"

    @classmethod
    def from_environment(cls, prefix: str = "TILLFLOW_JDBC") -> Database:
        login = {
            name: os.environ[f"{prefix}_{name.upper()}"]
            for name in ("user", "password") if f"{prefix}_{name.upper()}" in os.environ
        }
        return cls(os.environ[f"{prefix}_URL"], os.environ[f"{prefix}_DRIVER"], login)

    def options(self, **more: str) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties, **more}

    def read_table(
        self, spark: SparkSession, name: str, split_on: str | None = None,
        lower: str | None = None, upper: str | None = None, parts: int = 1,
    ) -> DataFrame:
        """A whole table; with ``split_on`` in ``parts`` ranges read side by side.
        Filters, columns and limits on the result run in the database."""
        more = {"dbtable": name}
        if split_on:
            more |= {"partitionColumn": split_on, "lowerBound": str(lower),
                     "upperBound": str(upper), "numPartitions": str(parts)}
        return spark.read.format("jdbc").options(**self.options(**more)).load()

    def read_query(self, spark: SparkSession, sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(query=sql)).load()

    def has_table(self, spark: SparkSession, name: str) -> bool:
        """Whether the database lists ``name`` in its catalog."""
        return not self.read_query(spark, f"{self.catalog} where table_name = '{name}'").isEmpty()

    def append(self, df: DataFrame, name: str, **more: str) -> None:
        self._write(df, "append", dbtable=name, **more)

    def replace(self, df: DataFrame, name: str, **more: str) -> None:
        """New content for a table. It is emptied, not dropped, so that readers
        always find it, with its column types and grants."""
        self._write(df, "overwrite", dbtable=name, truncate="true", **more)

    def _write(self, df: DataFrame, mode: str, **more: str) -> None:
        # However many executors there are, the database meets a few writers. The rows are
        # dealt out to them: Spark's own limit would merge partitions and so do all the work
        # before the write in as few tasks.
        options = self.options(**{"numPartitions": str(WRITERS), **more})
        df.repartition(int(options["numPartitions"])).write.format("jdbc").options(**options).mode(mode).save()
