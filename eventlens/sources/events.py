"""Readers for raw event tables and the multi-connection union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.schema import EVENT_COLUMNS, raw_schema


def read_events(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """Read one raw event table: a catalog table name or a path.

    Parquet/ORC/Delta paths keep predicate pushdown and column pruning; the
    staging step selects only catalogued columns, so the scan reads no more.
    """
    if fmt == "table":
        return spark.read.table(source)
    return spark.read.format(fmt).load(source)


def read_events_csv(spark: SparkSession, path: str, extra: dict[str, T.DataType] | None = None,
                    schema: T.StructType | None = None, multi_line: bool = False,
                    mode: str = "FAILFAST") -> DataFrame:
    """CSV export of a raw event table with typed columns.

    JSON in quoted fields uses doubled quotes (with line breaks inside, pass
    ``multi_line``: such a file is then read by one task); a malformed row is an
    error unless ``mode`` says otherwise; ``time`` and ``loaded_at``
    are parsed as timestamps.  Columns of the file that are not in the
    schema are ignored by header matching.
    """
    schema = schema or raw_schema(extra)
    header = spark.read.option("header", True).csv(path).columns
    by_name = {f.name.lower(): f for f in schema.fields}
    file_schema = T.StructType([
        T.StructField(c, by_name[c.lower()].dataType if c.lower() in by_name else T.StringType(), True)
        for c in header])
    return (spark.read.schema(file_schema)
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("mode", mode)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .option("enforceSchema", False)
            .csv(path))


def conformed_raw(df: DataFrame, raw_names: dict[str, str] | None = None) -> DataFrame:
    """``df`` with its catalogued columns under their catalogue names and types
    (``try_cast``: dirty values become NULL); other columns as they are."""
    wanted = {(raw_names or {}).get(name, name).lower(): (name, dtype) for name, dtype, _ in EVENT_COLUMNS}
    out = []
    for f in df.schema.fields:
        name, dtype = wanted.get(f.name.lower(), (f.name, f.dataType))
        col = F.col("`" + f.name.replace("`", "``") + "`")
        out.append((col if f.dataType == dtype else col.try_cast(dtype)).alias(name))
    return df.select(*out)


def union_connections(sources: dict[str, DataFrame], preserve_case: bool = False,
                      raw_names: dict[str, str] | None = None) -> DataFrame:
    """UNION ALL of several raw event tables with a provenance column.

    Each connection is conformed to the catalogue's types first, so none's
    types decide for the others; a further column whose type differs between
    connections becomes a string.  Columns missing in one connection become
    NULL.  ``source_relation`` is the connection name, lower-cased unless
    ``preserve_case``.  A narrow union: no shuffle.
    """
    if not sources:
        raise ValueError("no sources given")
    frames = {name: conformed_raw(df, raw_names) for name, df in sources.items()}
    types: dict[str, set[str]] = {}
    for df in frames.values():
        for f in df.schema.fields:
            types.setdefault(f.name.lower(), set()).add(f.dataType.simpleString())
    tagged = []
    for name, df in frames.items():
        mixed = {f.name: F.col(f.name).cast("string") for f in df.schema.fields if len(types[f.name.lower()]) > 1}
        tagged.append(df.withColumns({**mixed, "source_relation": F.lit(name if preserve_case else name.lower())}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
