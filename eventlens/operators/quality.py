"""Data-quality jobs (Q1-Q5) as distributed checks.

Each check returns a small summary DataFrame (never collects the data):
``unique``/``not_null`` count offending keys/rows, ``freshness`` grades the
latest load per connection, ``compare_row_counts`` and
``compare_row_sets`` (or, partition by partition,
``compare_partitions``) check a new build against a previous one.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_check(df: DataFrame, column: str, model: str) -> DataFrame:
    """Number of values of ``column`` that occur more than once (Q1, NULLs skipped)."""
    dupes = (df.where(F.col(column).isNotNull()).groupBy(column).count()
               .where(F.col("count") > 1))
    return dupes.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("test"),
        "failures")


def not_null_check(df: DataFrame, column: str, model: str) -> DataFrame:
    """Number of rows where ``column`` is NULL (Q2)."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("not_null").alias("test"),
        "failures")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def freshness_check(raw_or_staged: DataFrame, as_of: dt.datetime, warn_after_hours: int = 72,
                    error_after_hours: int = 96, loaded_at: str = "loaded_at") -> DataFrame:
    """Latest load time per connection against ``as_of`` (Q3):
    ``pass`` / ``warn`` / ``error``, or ``error`` when nothing was loaded."""
    rel = "source_relation" if "source_relation" in raw_or_staged.columns else None
    keys = [rel] if rel else []
    agg = raw_or_staged.groupBy(*keys).agg(F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at"))
    at = F.lit(as_of).cast("timestamp_ntz")
    hours = (F.unix_micros(at.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / 3.6e9
    return agg.select(
        *keys, "max_loaded_at", at.alias("checked_at"),
        hours.alias("hours_since_load"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(hours > error_after_hours, "error")
         .when(hours > warn_after_hours, "warn")
         .otherwise("pass").alias("status"),
    )


def compare_row_counts(prod: DataFrame, dev: DataFrame, model: str, only_mismatches: bool = True) -> DataFrame:
    """Row counts of two versions of a model (Q4).  Both counts come from one
    aggregation over the labelled union (no join of the two sides)."""
    both = prod.select(F.lit(1).alias("p"), F.lit(0).alias("d")).unionByName(
        dev.select(F.lit(0).alias("p"), F.lit(1).alias("d")))
    out = both.agg(F.sum("p").cast("long").alias("prod_rows"), F.sum("d").cast("long").alias("dev_rows"))
    out = out.select(F.lit(model).alias("model"),
                     F.coalesce("prod_rows", F.lit(0).cast("long")).alias("prod_rows"),
                     F.coalesce("dev_rows", F.lit(0).cast("long")).alias("dev_rows"))
    return out.where(F.col("prod_rows") != F.col("dev_rows")) if only_mismatches else out


def compare_row_sets(prod: DataFrame, dev: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """Distinct rows of either version missing from the other, labelled by side
    (Q5, U2, U3), with unstable columns excluded (P18).

    One aggregation over the labelled union: each side is computed once, rows
    combine map-side, and NULLs compare equal as grouping keys."""
    cols = [c for c in prod.columns if c not in set(exclude)]
    p, d = prod.select(*cols, F.lit(1).alias("_side")), dev.select(*cols, F.lit(2).alias("_side"))
    sides = p.unionByName(d).groupBy(*cols).agg(F.min("_side").alias("_low"), F.max("_side").alias("_high"))
    only = sides.where("_low = _high")
    return only.select(*cols, F.when(F.col("_low") == 1, "from prod").otherwise("from dev").alias("source"))


def partition_checksums(df: DataFrame, partition_col: str, exclude: list[str] = ()) -> DataFrame:
    """``partition_col, n_rows, sum_a, sum_b`` per partition: the sums of two 64-bit row
    hashes, which do not depend on the rows' order.  Combined map-side: a row for each
    partition and task is all that is shuffled."""
    cols = sorted(c for c in df.columns if c not in set(exclude))
    # a hash skips nulls, so their places are hashed too
    marks = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in cols])

    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), marks, *[F.col(f"`{c}`") for c in cols]).cast("decimal(38,0)"))

    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n_rows"), total(1).alias("sum_a"), total(2).alias("sum_b"))


def differing_partitions(prod: DataFrame, dev: DataFrame, partition_col: str, exclude: list[str] = ()) -> DataFrame:
    """``partition_col`` of the partitions whose rows differ (or that one side lacks)."""
    both = partition_checksums(prod, partition_col, exclude).unionByName(partition_checksums(dev, partition_col, exclude))
    sums = both.groupBy(partition_col).agg(F.count(F.lit(1)).alias("sides"), F.count_distinct("n_rows", "sum_a", "sum_b").alias("states"))
    return sums.where("sides = 1 OR states > 1").select(partition_col)


def compare_partitions(prod: DataFrame, dev: DataFrame, partition_col: str, exclude: list[str] = ()) -> DataFrame:
    """``compare_row_sets`` restricted to the partitions whose checksums differ.

    Rows of equal partitions are hashed where they lie and neither shuffled nor read
    again: the list of differing ones (dates, so bounded by the calendar) is a
    literal filter that prunes the second scan."""
    values = [r[0] for r in differing_partitions(prod, dev, partition_col, exclude).collect()]
    hit = F.col(partition_col).isin([v for v in values if v is not None])
    if None in values:
        hit = hit | F.col(partition_col).isNull()
    return compare_row_sets(prod.where(hit), dev.where(hit), exclude)
