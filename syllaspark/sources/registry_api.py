"""The national course registry as a Spark data source, one partition per chunk of codes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import COURSES

#: Keys that one request may ask for.
CHUNK = 80


def chunks(keys: list[str], size: int = CHUNK) -> list[list[str]]:
    return [keys[i : i + size] for i in range(0, len(keys), size)]


class _Chunk(InputPartition):
    def __init__(self, keys: list[str]):
        super().__init__(len(keys))
        self.keys = keys


class _Reader(DataSourceReader):
    def __init__(self, schema, options: dict, loader: Callable[[str, list[str]], list[dict]]):
        self.schema, self.table, self.loader = schema, options.get("table", ""), loader
        self.keys = json.loads(options.get("keys", "[]"))
        self.size = int(options.get("chunk", CHUNK))

    def partitions(self):
        return [_Chunk(c) for c in chunks(self.keys, self.size)] or [_Chunk([])]

    def read(self, partition):
        if not partition.keys:
            return
        names = self.schema.fieldNames()
        for row in self.loader(self.table, partition.keys):
            yield tuple(row.get(n) for n in names)


def registry_source(loader: Callable[[str, list[str]], list[dict]], name: str = "course_registry") -> type[DataSource]:
    """A data source class around ``loader(table, keys)``, which returns rows as dictionaries."""

    class Registry(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self):
            return COURSES

        def reader(self, schema) -> DataSourceReader:
            return _Reader(schema, dict(self.options), loader)

    return Registry


def scan(spark: SparkSession, loader: Callable[[str, list[str]], list[dict]], table: str, keys: list[str], schema=None, chunk: int = CHUNK) -> DataFrame:
    """Rows of a registry table for the given keys, requested chunk by chunk on the executors."""
    source = registry_source(loader)
    spark.dataSource.register(source)
    reader = spark.read.format(source.name()).option("table", table).option("keys", json.dumps(keys)).option("chunk", str(chunk))
    return (reader.schema(schema) if schema is not None else reader).load()
