"""Raw files and the ledger of those that a target has taken in.

``RawFiles`` names the raw folders of every connection.  Its listing (file,
modification time, length: hidden file metadata, no file is opened) is held
against the ledger stored with the target: files that the ledger lacks are new,
entries that the listing lacks are of files that vanished or changed.  A run
reads new files only.  The ledger also keeps the days found in each file, so
that when a file vanishes, the other files of its days are known.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.config import Config, CustomColumn
from eventlens.operators.staging import stage_events
from eventlens.sources.events import union_connections

#: Column of a staged row that names its file.
FILE = "raw_file"
#: What tells one state of a file from another.
IDENTITY = ["connection", "file", "modified", "length"]


@dataclass(frozen=True)
class FileSource:
    """The raw files of one connection.

    ``adapt`` maps a frame read from the files onto the raw column names; it may
    select, rename, cast and filter, but not join or aggregate."""

    path: str
    fmt: str = "parquet"
    schema: T.StructType | None = None
    adapt: Callable[[DataFrame], DataFrame] | None = None
    options: dict[str, str] = field(default_factory=dict)

    def listing(self, spark: SparkSession) -> DataFrame:
        """``file, path, modified, length`` of every file; ``path`` is what a reader takes."""
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path)
        meta = F.col("_metadata")
        return found.select(meta["file_path"].alias("file"), "path", meta["file_modification_time"].alias("modified"),
                            meta["file_size"].alias("length"))

    def read(self, spark: SparkSession, paths: list[str] | None = None) -> DataFrame:
        """All files, or those of ``paths``, with the ``FILE`` column."""
        reader = spark.read.format(self.fmt).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        df = reader.load(self.path if paths is None else paths)
        named = df.select("*", F.col("_metadata.file_path").alias(FILE))
        return self.adapt(df).select("*", F.col("_metadata.file_path").alias(FILE)) if self.adapt else named


@dataclass(frozen=True)
class RawFiles:
    """The raw files of all connections, by connection name."""

    sources: dict[str, FileSource]

    def count(self) -> int:
        """Rows of all files."""
        return sum(s.read(SparkSession.active()).count() for s in self.sources.values())

    def listing(self, spark: SparkSession) -> DataFrame:
        frames = [s.listing(spark).select(F.lit(name).alias("connection"), "*") for name, s in self.sources.items()]
        return reduce(DataFrame.unionByName, frames)

    def read(self, spark: SparkSession, cfg: Config, paths: dict[str, list[str]] | None = None) -> DataFrame | None:
        """The connections' rows united; of ``paths`` (by connection) only, where given.
        None if that names no file."""
        picked = {name: s.read(spark, None if paths is None else paths[name])
                  for name, s in self.sources.items() if paths is None or paths.get(name)}
        return union_connections(picked, cfg.preserve_source_case, cfg.raw_names) if picked else None


def stage_files(raw: DataFrame, cfg: Config) -> DataFrame:
    """Staged rows that keep the name of their file."""
    return stage_events(raw, cfg.with_(custom_columns=(*cfg.custom_columns, CustomColumn(FILE))))


def days_of_files(staged: DataFrame) -> DataFrame:
    """``file, days``: the distinct days of each file's staged rows."""
    return staged.groupBy(F.col(FILE).alias("file")).agg(F.collect_set("date_day").alias("days"))


def ledger_entries(listing: DataFrame, days: DataFrame, settings: str) -> DataFrame:
    """An entry for each listed file; one without staged rows has no days."""
    none = F.array().cast("array<date>")
    return listing.join(days, "file", "left").select(*IDENTITY, "path", F.coalesce("days", none).alias("days"),
                                                     F.lit(settings).alias("settings"))


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    return listing.join(ledger.select(*IDENTITY), IDENTITY, "left_anti")


def gone_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    return ledger.join(listing.select(*IDENTITY), IDENTITY, "left_anti")


def paths_by_connection(files: DataFrame) -> dict[str, list[str]]:
    """The files as lists for the readers, which hold any listing on the driver."""
    out: dict[str, list[str]] = {}
    for r in files.select("connection", "path").collect():
        out.setdefault(r["connection"], []).append(r["path"])
    return out


def settings_of(cfg: Config) -> str:
    """What decides how a raw row is staged; a target built under other settings is rebuilt."""
    return repr((cfg.raw_names, cfg.custom_columns, cfg.properties_to_pivot, str(cfg.event_filter), cfg.date_range_start,
                 cfg.preserve_source_case))
