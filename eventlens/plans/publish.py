"""Stored tables under catalog names.

``publish`` makes a database with one external table per stored table of a
target: typed columns with their descriptions, the partition column and the
target's own files as location, so nothing is copied.  After an incremental run it
is called again, which picks up new partitions.  ``publish_view`` persists a
view; ``staged_view`` makes one of the staged rows over raw files.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventlens.config import Config
from eventlens.operators.staging import stage_sql
from eventlens.plans.docs import DESCRIPTIONS
from eventlens.plans.pipeline import FIRST_EVENTS, PERSON_MONTHS, TABLES, Target

#: Partition column of every table that is published where it is stored.
PARTITIONED = {name: part for name, (part, _) in TABLES.items()} | {PERSON_MONTHS: "date_month", FIRST_EVENTS: "first_event_day"}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, target: str | Target, database: str, prefix: str = "") -> list[str]:
    """Make or refresh the catalog tables of a target; their names."""
    target = Target.of(target)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    names = []
    for table, part in PARTITIONED.items():
        if not target.has(spark, table):
            continue
        name = f"{quoted(database)}.{quoted(prefix + table)}"
        docs = DESCRIPTIONS.get(table, {})
        columns = ", ".join(
            f"{quoted(f.name)} {f.dataType.simpleString()}" + (f" COMMENT {_text(docs[f.name])}" if f.name in docs else "")
            for f in target.read(spark, table).schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {target.fmt} PARTITIONED BY ({quoted(part)}) LOCATION {_text(target.path(table))}")
        spark.sql(f"MSCK REPAIR TABLE {name}")
        names.append(f"{database}.{prefix}{table}")
    return names


def publish_view(spark: SparkSession, database: str, name: str, sql: str, comment: str = "") -> str:
    """Persist a view of ``sql``, which may read catalog tables and files, not temporary views."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    about = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)}{about} AS {sql}")
    return f"{database}.{name}"


def staged_view(spark: SparkSession, database: str, raw_path: str, cfg: Config, fmt: str = "parquet", name: str = "stg_event") -> str:
    """Persist the staged rows of raw files as a view (nothing is stored)."""
    raw = spark.read.format(fmt).load(raw_path)
    return publish_view(spark, database, name, stage_sql(raw, cfg, f"{fmt}.{quoted(raw_path)}"), "Staged events.")
