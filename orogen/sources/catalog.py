"""A catalog of keyed tables on shared storage: scans, lookups, upserts, deletes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import upsert


class Catalog:
    """Tables of one folder. Every change writes a new version and then moves the pointer to it, so readers see whole tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _pointer(self, table: str) -> str:
        return f"{self.path}/{table}/current"

    def _version(self, table: str) -> str | None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._pointer(table))
        fs = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(hadoop):
            return None
        return self.spark.read.text(self._pointer(table)).first()[0]

    def exists(self, table: str) -> bool:
        return self._version(table) is not None

    def load(self, table: str) -> DataFrame:
        version = self._version(table)
        if version is None:
            raise KeyError(f"no table {table}")
        return self.spark.read.parquet(f"{self.path}/{table}/{version}")

    def save(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        version = f"v-{uuid.uuid4().hex}"
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/{table}/{version}")
        self.spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(self._pointer(table))

    def scan(self, table: str, **conditions: object) -> DataFrame:
        """Rows equal to every condition; a string that begins with ^ asks for a prefix. Conditions reach the scan."""
        df = self.load(table)
        for name, value in conditions.items():
            prefix = isinstance(value, str) and value.startswith("^")
            df = df.where(F.col(name).startswith(value[1:]) if prefix else F.col(name).eqNullSafe(F.lit(value)))
        return df

    def lookup(self, table: str, **keys: object):
        """The row of a key, or None."""
        return self.scan(table, **keys).first()

    def upsert(self, table: str, changes: DataFrame, keys: list[str]) -> None:
        self.save(table, upsert(self.load(table), changes, keys) if self.exists(table) else changes)

    def delete(self, table: str, gone: DataFrame, keys: list[str]) -> None:
        self.save(table, self.load(table).join(gone.select(*keys), keys, "left_anti"))

    def keep_referenced(self, table: str, live: DataFrame, keys: list[str]) -> None:
        """Delete orphans: keep the rows whose keys are live."""
        self.save(table, self.load(table).join(live.select(*keys).distinct(), keys, "left_semi"))
