"""State by key in bucketed tables.

``KeyedTable`` holds one value per key, bucketed by the key through the session
catalog.  A join or aggregation on the key reads the stored side where it lies:
only the other side is shuffled, to the same buckets.  ``upsert`` rewrites the
buckets that the changed keys fall into and no other: their merged rows are
appended as new files, then their old files are removed.  Between the two steps
a key may have both its rows; ``rows`` takes the smaller value, so a failure there
changes nothing, and the next upsert of the bucket clears it up.

The catalog may be the session's own: the files carry the state, and a session
that lacks the table's entry makes it anew.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.sources.sinks import list_files, remove, table_exists

DATABASE = "eventlens_state"
_BUCKET = re.compile(r"_(\d+)(?:\.|$)")


class KeyedTable:
    """``key`` (a string, never null) and ``value``, a smaller value replacing a larger one."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, value_type: str = "date", fmt: str = "parquet"):
        self.spark, self.path, self.buckets, self.fmt = spark, path.rstrip("/"), buckets, fmt
        self.columns = f"key STRING, value {value_type}"
        # the name says how it is bucketed: another number of buckets is another table
        self.name = f"{DATABASE}.t_{hashlib.md5(f'{self.path}:{buckets}'.encode()).hexdigest()[:16]}"

    def exists(self) -> bool:
        return table_exists(self.spark, self.path, self.fmt)

    def _stored(self) -> DataFrame:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}) USING {self.fmt} "
                       f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        """``key, value``, a row for each key (no exchange: the table is bucketed by it)."""
        return self._stored().groupBy("key").agg(F.min("value").alias("value"))

    def _write(self, df: DataFrame, mode: str) -> None:
        """One file for each bucket that has rows."""
        dealt = df.select("key", "value").repartition(self.buckets, "key").sortWithinPartitions("key")
        dealt.write.format(self.fmt).mode(mode).bucketBy(self.buckets, "key").sortBy("key").option("path", self.path).saveAsTable(self.name)

    def replace(self, df: DataFrame) -> None:
        """Store ``df`` (not read from this table) in place of all rows."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # external: files stay until overwritten
        self._write(df, "overwrite")

    def bucket(self, name: str) -> int | None:
        """The bucket of a data file."""
        found = _BUCKET.search(name.split("-")[-1]) if name.startswith("part-") else None
        return int(found[1]) if found else None

    def upsert(self, changed: DataFrame) -> None:
        """Put the rows of ``changed`` (``key, value``; not read from this table) in place of those of their keys."""
        ids = changed.select(F.pmod(F.hash("key"), F.lit(self.buckets)).alias("b")).distinct().collect()  # the number of buckets at most
        touched = {r["b"] for r in ids}
        old = [f for f in list_files(self.spark, self.path) if self.bucket(f.rsplit("/", 1)[-1]) in touched]
        self._stored()
        rows = changed.select("key", "value")
        if old:
            held = self.spark.read.format(self.fmt).schema(self.columns).load(old)
            rows = rows.unionByName(held.join(changed.select("key").distinct(), "key", "left_anti"))
        self._write(rows.groupBy("key").agg(F.min("value").alias("value")), "append")
        for f in old:
            remove(self.spark, f)
        self.spark.catalog.refreshTable(self.name)
