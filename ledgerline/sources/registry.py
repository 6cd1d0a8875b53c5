"""Source registry: logical table name -> how to read it.

The source jobs read tables from several databases and a linked server (local, cross-database and
remote scans, S1-S4). Here every logical name resolves to one entry: a parquet path, a catalog
table, or a JDBC option set with partition bounds, so jobs never know where data lives. Remote
systems are best landed as parquet first (see ``streaming.incremental``); JDBC pushes filters but
not joins with other sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass
class Entry:
    kind: str                      # "parquet" | "table" | "jdbc" | "csv"
    location: str                  # path, table name or jdbc dbtable
    schema: StructType | None = None
    options: dict = field(default_factory=dict)


class SourceRegistry:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._entries: dict[str, Entry] = {}
        self._frames: dict[str, DataFrame] = {}

    # registration ---------------------------------------------------------------------------
    def parquet(self, name: str, path: str, schema: StructType | None = None) -> "SourceRegistry":
        self._entries[name] = Entry("parquet", path, schema)
        return self

    def table(self, name: str, table: str) -> "SourceRegistry":
        self._entries[name] = Entry("table", table)
        return self

    def jdbc(self, name: str, dbtable: str, url: str, partition_column: str | None = None,
             lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
             **opts) -> "SourceRegistry":
        """A remote table. With a numeric partition column the read is split into
        ``num_partitions`` ranges (parallel fetch instead of one cursor)."""
        o = {"url": url, "dbtable": dbtable, **opts}
        if partition_column is not None:
            o.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                     numPartitions=str(num_partitions))
        self._entries[name] = Entry("jdbc", dbtable, None, o)
        return self

    def csv(self, name: str, path: str, schema: StructType, **opts) -> "SourceRegistry":
        """Text exports (S13): multi-line quoted fields, explicit schema, no inference."""
        o = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', **opts}
        self._entries[name] = Entry("csv", path, schema, o)
        return self

    def frame(self, name: str, df: DataFrame) -> "SourceRegistry":
        """Register an already-built frame (stand-in views, tests)."""
        self._frames[name] = df
        return self

    # lookup ---------------------------------------------------------------------------------
    def __contains__(self, name: str) -> bool:
        return name in self._frames or name in self._entries

    def __call__(self, name: str) -> DataFrame:
        return self.source(name)

    def source(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        e = self._entries[name]
        r = self.spark.read
        if e.kind == "parquet":
            df = (r.schema(e.schema) if e.schema is not None else r).parquet(e.location)
        elif e.kind == "table":
            df = self.spark.table(e.location)
        elif e.kind == "jdbc":
            df = r.format("jdbc").options(**e.options).load()
        elif e.kind == "csv":
            df = r.schema(e.schema).options(**e.options).csv(e.location)
        else:
            raise ValueError(e.kind)
        self._frames[name] = df
        return df
