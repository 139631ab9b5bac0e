"""Table sinks: full rebuild, partition overwrite, delete+insert.

Targets are Parquet directories partitioned by a date column (the table
format is a parameter; Delta works the same where its jars are present).
Only the high-water mark (one scalar) ever reaches the driver.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
import zlib
from collections.abc import Iterator
from contextlib import closing, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.timeutil import shift_date


#: Folder value of rows whose partition column is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _jvm_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a write to ``path`` has ended: its marker file, or a Delta log."""
    fs, jpath = _jvm_path(spark, path)
    marker = "_delta_log" if fmt == "delta" else "_SUCCESS"
    return fs.exists(jpath) and fs.exists(_jvm_path(spark, f"{path.rstrip('/')}/{marker}")[1])


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _jvm_path(spark, path)
    fs.delete(jpath, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files in a folder (not in its subfolders)."""
    fs, jpath = _jvm_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [str(st.getPath()) for st in fs.listStatus(jpath) if st.isFile() and not st.getPath().getName().startswith(("_", "."))]


def clustered(df: DataFrame, partition_col: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Cluster rows before a date-partitioned write.

    Dates are dealt whole to the writing tasks (few files), and each task sorts
    its rows by date and cluster keys for min/max skipping.  AQE joins small
    dates and splits a big one over many tasks by its shuffled bytes, so no key
    is sampled: a sample would compute all of ``df`` after its last shuffle
    (the final aggregates and windows of a model) a second time.
    """
    keys = [partition_col, *(cluster_by or [])]
    return df.hint("rebalance", F.col(partition_col)).sortWithinPartitions(*keys)


def write_full(df: DataFrame, path: str, partition_col: str, cluster_by: list[str] | None = None,
               fmt: str = "parquet") -> None:
    """Full rebuild of a partitioned table."""
    (clustered(df, partition_col, cluster_by).write.format(fmt)
     .mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(partition_col).save(path))


def overwrite_partitions(df: DataFrame, path: str, partition_col: str, cluster_by: list[str] | None = None,
                         fmt: str = "parquet") -> None:
    """Incremental ``insert_overwrite``: replace exactly the date partitions
    present in ``df`` and leave all others untouched (S8)."""
    (clustered(df, partition_col, cluster_by).write.format(fmt)
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).save(path))


def partition_values(spark: SparkSession, path: str, partition_col: str, fmt: str = "parquet") -> set[str]:
    """Partition values present under ``path`` (a directory listing, no job;
    of a Delta table, whose folders say nothing, the distinct values)."""
    fs, jpath = _jvm_path(spark, path)
    if not fs.exists(jpath):
        return set()
    if fmt == "delta":
        rows = spark.read.format(fmt).load(path).select(F.col(partition_col).cast("string").alias("v")).distinct().collect()
        return {r["v"] if r["v"] is not None else NULL_PARTITION for r in rows}
    prefix = f"{partition_col}="
    return {st.getPath().getName()[len(prefix):] for st in fs.listStatus(jpath)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)}


@contextmanager
def staged_beside(spark: SparkSession, df: DataFrame, path: str, partition_col: str | None = None,
                  cluster_by: list[str] | None = None, fmt: str = "parquet") -> Iterator[tuple[DataFrame, str]]:
    """``df`` written beside ``path`` (the target's own file system) and read
    back; the copy is removed at the end."""
    staging = f"{path.rstrip('/')}__staging-{uuid.uuid4().hex}"
    try:
        writer = (clustered(df, partition_col, cluster_by) if partition_col else df).write.format(fmt)
        (writer.partitionBy(partition_col) if partition_col else writer).save(staging)
        yield spark.read.format(fmt).schema(df.schema).load(staging), staging
    finally:
        remove(spark, staging)


def drop_partitions(spark: SparkSession, path: str, partition_col: str, values: set[str], fmt: str = "parquet") -> None:
    if fmt == "delta":
        cond = F.col(partition_col).cast("string").isin(sorted(values))
        if values:
            from delta.tables import DeltaTable  # the Delta package ships it

            DeltaTable.forPath(spark, path).delete(cond)
        return
    fs, _ = _jvm_path(spark, path)
    for value in values:
        fs.delete(_jvm_path(spark, f"{path.rstrip('/')}/{partition_col}={value}")[1], True)


def _replaced(spark: SparkSession, df: DataFrame, path: str, partition_col: str, old: set[str],
              cluster_by: list[str] | None, fmt: str) -> set[str]:
    """Overwrite the partitions of ``df``'s rows; of the stored partitions ``old``,
    those that were replaced.

    ``df`` may read the table: a dynamic overwrite writes beside it and moves its
    folders in after the last task, so the rows are written once.  An old partition
    that holds the same files as before has no rows in ``df``."""
    if fmt == "delta":  # its folders say nothing: a staged copy tells the dates
        with staged_beside(spark, df, path, partition_col, cluster_by, fmt) as (slice_, staging):
            fresh = partition_values(spark, staging, partition_col, fmt)
            if fresh:
                overwrite_partitions(slice_, path, partition_col, cluster_by, fmt)
        return old & fresh
    folder = f"{path.rstrip('/')}/{partition_col}="
    before = {v: set(list_files(spark, folder + v)) for v in old}
    overwrite_partitions(df, path, partition_col, cluster_by, fmt)
    return {v for v, files in before.items() if set(list_files(spark, folder + v)) - files}


def overwrite_values(spark: SparkSession, df: DataFrame, path: str, partition_col: str, values: set[str],
                     cluster_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Replace the partitions ``values`` (date strings, or ``NULL_PARTITION``) with ``df``,
    whose rows belong to them; those without rows now are deleted after the write.

    ``df`` may read the table."""
    old = values & partition_values(spark, path, partition_col, fmt)
    drop_partitions(spark, path, partition_col, old - _replaced(spark, df, path, partition_col, old, cluster_by, fmt), fmt)


def _from(spark: SparkSession, path: str, partition_col: str, start: dt.date, fmt: str) -> set[str]:
    return {v for v in partition_values(spark, path, partition_col, fmt) if v != NULL_PARTITION and v >= start.isoformat()}


def overwrite_window(spark: SparkSession, df: DataFrame, path: str, partition_col: str,
                     start: dt.date, cluster_by: list[str] | None = None, fmt: str = "parquet",
                     present: list | None = None) -> None:
    """Replace every partition from ``start`` on with ``df``.

    A dynamic overwrite cannot delete a date that now has no rows (say a
    filter excluded all of it); such partitions are deleted after the write,
    so a failure in between leaves old rows and no hole.  When the caller knows
    the slice's dates (``present``: a bounded list, the days of the window),
    they are taken from it; otherwise the written folders tell them.
    """
    if present is not None:
        overwrite_partitions(df, path, partition_col, cluster_by, fmt=fmt)
        kept = {v if isinstance(v, str) else v.isoformat() for v in present}
        drop_partitions(spark, path, partition_col, _from(spark, path, partition_col, start, fmt) - kept, fmt)
        return
    old = _from(spark, path, partition_col, start, fmt)
    drop_partitions(spark, path, partition_col, old - _replaced(spark, df, path, partition_col, old, cluster_by, fmt), fmt)


def without_keys(rows: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key ``fresh`` lacks.  Always by a sort-merge join: the keys of
    many small batches, each broadcast, would all pass through the driver."""
    return rows.join(fresh.select(key).hint("merge"), key, "left_anti")


def delete_insert(spark: SparkSession, df: DataFrame, path: str, key: str, partition_col: str,
                  cluster_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Incremental ``delete+insert`` by unique key.

    Rows of the target whose key appears in ``df`` are replaced; other rows of
    the touched partitions are kept.  ``df`` is computed once, into a staged
    copy whose folders name the touched dates, so the target's scan is pruned
    by literals; the merged partitions replace the old ones when all of them
    are written (a dynamic overwrite may read the table it writes).
    """
    with staged_beside(spark, df, path, partition_col, fmt=fmt) as (fresh, staging):
        days = sorted(partition_values(spark, staging, partition_col, fmt))
        if not days:
            return
        existing = spark.read.format(fmt).load(path)
        kept = without_keys(existing.where(F.col(partition_col).cast("string").isin(days)), fresh, key)
        merged = kept.unionByName(fresh.select(*existing.columns), allowMissingColumns=True)
        overwrite_partitions(merged, path, partition_col, cluster_by, fmt)


#: Files under this size are small; a partition with so many of them has them joined.
SMALL_FILE, MANY_FILES = 32 << 20, 16
#: A table's upsert whose files are complete but may not all be in place.
PENDING = "_upsert.json"


def _sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the data files in a folder."""
    fs, jpath = _jvm_path(spark, path)
    if not fs.exists(jpath):
        return {}
    found = {st.getPath().getName(): st.getLen() for st in fs.listStatus(jpath) if st.isFile()}
    return {name: size for name, size in found.items() if not name.startswith(("_", "."))}


def _day_text(partition_col: str) -> Column:
    """The folder value of a row's partition."""
    return F.coalesce(F.col(partition_col).cast("string"), F.lit(NULL_PARTITION))


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Put the files of an upsert that was broken off in place, and remove those they replace."""
    path = path.rstrip("/")
    fs, pending = _jvm_path(spark, f"{path}/{PENDING}")
    if not fs.exists(pending):
        return
    with closing(fs.open(pending)) as stream:
        todo = json.loads(bytes(stream.readAllBytes()))
    for file in todo["new"]:
        source, to = _jvm_path(spark, f"{todo['staging']}/{file}")[1], _jvm_path(spark, f"{path}/{file}")[1]
        if fs.exists(source):  # else moved before
            fs.mkdirs(to.getParent())
            if not fs.rename(source, to):
                raise OSError(f"cannot move {source} to {to}")
    for file in todo["old"]:
        remove(spark, f"{path}/{file}")
    fs.delete(pending, False)
    remove(spark, todo["staging"])


def upsert_files(spark: SparkSession, fresh: DataFrame, path: str, key: str, partition_col: str,
                 cluster_by: list[str] | None = None, fmt: str = "parquet", changed: str | None = None) -> None:
    """``delete_insert`` for many small batches: of the touched partitions, only the files
    that hold a key of ``fresh`` are rewritten (found by the key column alone), the
    other rows are written beside them.  Small files that add up in a partition are
    rewritten with it, so a row is rewritten a few times, not once a batch.

    ``fresh`` is stored and not read from the table.  Where ``changed`` (a flag of ``fresh``)
    is false, a row that has its key stored is taken to be stored as it is.
    The merged rows are written beside the table and a list of what is to move in and
    what to go is left in it, then that is done; a later call ends one that broke off."""
    path = path.rstrip("/")
    finish_upsert(spark, path)
    days = sorted(r["day"] for r in fresh.select(_day_text(partition_col).alias("day")).distinct().collect())
    if not days:
        return
    existing = spark.read.format(fmt).load(path)
    flag = F.col(changed) if changed else F.lit(True)
    # of a stored row, no more than numbers is shuffled; a chance hit costs a rewrite
    hashed = F.xxhash64(key).alias("_h")
    held = (existing.where(_day_text(partition_col).isin(days) & F.col(key).isNotNull())
            .select(hashed, F.col(partition_col).alias("_d"), F.crc32(F.col("_metadata.file_name")).alias("_f")))
    found = (fresh.select(hashed, flag.alias("new")).join(held.hint("merge"), "_h", "left")
             .where(F.col("new") == F.col("_f").isNotNull()).select("new", "_d", "_f").distinct()
             .select("new", _day_text("_d").alias("day"), "_f").collect())  # at most the number of files
    hit = {(r["day"], r["_f"]) for r in found if r["new"]}
    rows = fresh
    if changed:
        rows = fresh.where(flag)
        if not all(r["new"] for r in found):  # unchanged rows that the table has lost
            gone = existing.where(_day_text(partition_col).isin(days)).select(key)
            rows = rows.unionByName(without_keys(fresh.where(~flag), gone, key))
    old = []
    for day in days:
        sizes = _sizes(spark, f"{path}/{partition_col}={day}")
        many = sum(size < SMALL_FILE for size in sizes.values()) >= MANY_FILES
        old += [f"{partition_col}={day}/{name}" for name, size in sorted(sizes.items())
                if (day, zlib.crc32(name.encode())) in hit or many and size < SMALL_FILE]
    merged = rows.select(*existing.columns)
    if old:
        stored = spark.read.format(fmt).schema(existing.schema).option("basePath", path).load([f"{path}/{f}" for f in old])
        merged = without_keys(stored, rows, key).unionByName(merged, allowMissingColumns=True)
    staging = f"{path}__staging-{uuid.uuid4().hex}"
    fs, pending = _jvm_path(spark, f"{path}/{PENDING}")
    try:
        clustered(merged, partition_col, cluster_by).write.format(fmt).partitionBy(partition_col).save(staging)
        folders = [f"{partition_col}={value}" for value in partition_values(spark, staging, partition_col)]
        new = [f"{folder}/{name}" for folder in folders for name in _sizes(spark, f"{staging}/{folder}")]
        part = _jvm_path(spark, f"{staging}/{PENDING}")[1]
        with closing(fs.create(part, True)) as stream:
            stream.write(json.dumps({"staging": staging, "new": new, "old": old}).encode())
        if not fs.rename(part, pending):
            raise OSError(f"cannot write {pending}")
    except BaseException:
        if not fs.exists(pending):
            remove(spark, staging)
        raise
    finish_upsert(spark, path)


def replace_table(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Rewrite a table that may also be an input of ``df``."""
    with staged_beside(spark, df, path, fmt=fmt) as (copy, _):
        copy.write.format(fmt).mode("overwrite").save(path)
    return spark.read.format(fmt).load(path)


def high_water_mark(spark: SparkSession, path: str, column: str, as_of: dt.date | None = None,
                    fmt: str = "parquet") -> dt.date | None:
    """``max(column)`` of an existing target, None for a missing or empty one.

    Capped at ``as_of`` so that future-dated rows cannot push the lookback
    forward and silently skip late data (N15).  A partition column makes
    this a directory listing, no job over file footers.
    """
    if not table_exists(spark, path, fmt):
        return None
    listed = [v for v in partition_values(spark, path, column, fmt) if v != NULL_PARTITION]
    if listed:
        value = dt.date.fromisoformat(max(listed)[:10])
    else:
        value = spark.read.format(fmt).load(path).agg(F.max(column).alias("m")).first()["m"]
    if isinstance(value, dt.datetime):
        value = value.date()
    return as_of if value is not None and as_of is not None and value > as_of else value


def lookback_start(hwm: dt.date, days: int = 0, months: int = 0) -> dt.date:
    """``hwm`` minus an interval in days or months."""
    return shift_date(hwm, days=-days, months=-months)
