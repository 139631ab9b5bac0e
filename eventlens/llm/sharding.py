"""Sharding by sampled splitters.

1. Every record gets a sort key, the pair (hash of its text, hash of its id),
   and a size in bytes.  Equal texts are neighbours in key order.
2. A sample of keys is drawn with probability in proportion to size; its
   weighted quantiles are the splitters of ``ranges`` fine ranges (at most
   ``max_ranges``).  The sample has about ``ranges * per_range`` rows, so its
   size has a fixed bound.
3. Records are dealt to the ranges; each range's bytes and rows are counted.
   A range that holds more than ``overfull`` times its share is sampled anew
   and subdivided, until none is left that more than one record shares.  As
   the id is part of the key, a hot text is subdivided too.
4. A running sum inside each range plus the ranges' offsets is the exact
   position of each record, in bytes and in rows, without a global sort.
   Shard boundaries are the byte quantiles; one that cuts a group of equal
   texts moves to the group's nearer edge where that shifts at most
   ``group_slack`` of a shard, so that only groups too large for that are cut.

Only the sample, the splitters and the ranges' totals reach the driver; their
sizes are bounded by ``ranges``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, unit_hash

Splitters = tuple[np.ndarray, np.ndarray]


def quantile_splitters(keys: np.ndarray, ties: np.ndarray, weights: np.ndarray, pieces: int) -> Splitters:
    """Up to ``pieces - 1`` distinct key pairs that cut the weighted sample evenly."""
    order = np.lexsort((ties, keys))
    keys, ties, upto = keys[order], ties[order], np.cumsum(weights[order])
    if not len(keys):
        return keys, ties
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, pieces) / pieces))
    pairs = np.unique(np.stack([keys[at], ties[at]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def range_of(keys: np.ndarray, ties: np.ndarray, splitters: Splitters) -> np.ndarray:
    """Number of splitter pairs at or before each (key, tie)."""
    sk, st = splitters
    low, high = np.searchsorted(sk, keys, "left"), np.searchsorted(sk, keys, "right")
    out = high.copy()
    at = np.flatnonzero(low < high)
    for key in np.unique(keys[at]):
        rows = at[keys[at] == key]
        a, b = low[rows[0]], high[rows[0]]
        out[rows] = a + np.searchsorted(st[a:b], ties[rows], "right")
    return out


def _with_range(df: DataFrame, splitters: Splitters) -> DataFrame:
    @F.pandas_udf("int")
    def find(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(range_of(key.to_numpy(np.int64), tie.to_numpy(np.int64), splitters).astype("int32"))

    return df.withColumn("range", find("key", "tie"))


def _sample(df: DataFrame, rate: float, seed: int) -> pd.DataFrame:
    """Rows drawn with probability ``min(1, size * rate)``, each standing for
    ``max(size, 1 / rate)`` bytes.  Copies of one record are drawn apart."""
    drawn = df.where(unit_hash(F.lit(seed), "key", "tie", F.monotonically_increasing_id()) < F.col("size") * rate)
    return drawn.select("key", "tie", F.greatest(F.col("size").cast("double"), F.lit(1.0 / rate)).alias("weight")).toPandas()


def shard_records(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_shards: int = 16,
    max_ranges: int = 4096,
    rows_per_range: int = 2000,
    per_range: int = 16,
    overfull: float = 3.0,
    group_slack: float = 0.02,
    seed: int = 17,
) -> DataFrame:
    """Deal all records to ``n_shards`` shards of nearly equal bytes.

    Returns ``id, size, text_crc32, shard, slot``: ``size`` is the text's UTF-8
    bytes plus 1, ``slot`` counts each shard's records from 0 without gaps.

    Null texts have size 1 and the checksum of no bytes (0); null ids are
    ordinary keys; repeated rows are placed one by one; an empty table gives
    an empty result; other columns are ignored.
    """
    raw = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(
        raw.select(
            "id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("key"),
            F.xxhash64("id").alias("tie"),
        ),
        "shard-keys",
    )
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    ranges = max(n_shards, min(max_ranges, n // rows_per_range))
    if not n:
        return rows.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    def counted(splitters: Splitters):
        got = _with_range(rows, splitters).groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.countDistinct("key", "tie").alias("keys"))
        return got.orderBy("range").toPandas()

    rate = ranges * per_range / total
    drawn = _sample(rows, rate, seed)
    splitters = quantile_splitters(drawn["key"].to_numpy(), drawn["tie"].to_numpy(), drawn["weight"].to_numpy(), ranges)
    totals = counted(splitters)
    share = total / ranges
    for again in range(1, 9):  # each round halves an overfull range at least
        full = totals[(totals["bytes"] > overfull * share) & (totals["keys"] > 1)]
        if not len(full):
            break
        over = _with_range(rows, splitters).where(F.col("range").isin([int(r) for r in full["range"]]))
        more = _sample(over, rate * 4**again, seed + again)
        inside = range_of(more["key"].to_numpy(np.int64), more["tie"].to_numpy(np.int64), splitters)
        pairs = [np.stack(splitters, axis=1)]
        for r, held in zip(full["range"], full["bytes"], strict=True):
            m = more[inside == r]
            pairs.append(np.stack(quantile_splitters(m["key"].to_numpy(np.int64), m["tie"].to_numpy(np.int64), m["weight"].to_numpy(), int(held / share) + 2), axis=1))
        joined = np.unique(np.concatenate(pairs), axis=0)
        if len(joined) == len(splitters[0]):
            break
        splitters = joined[:, 0], joined[:, 1]
        totals = counted(splitters)

    spark = docs.sparkSession
    offsets = spark.createDataFrame(
        pd.DataFrame({
            "range": totals["range"].astype("int32"),
            "bytes_before": (totals["bytes"].cumsum() - totals["bytes"]).astype("int64"),
            "rows_before": (totals["n"].cumsum() - totals["n"]).astype("int64"),
        })
    )
    in_range = Window.partitionBy("range").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = stored(
        _with_range(rows, splitters)
        .withColumns({"upto": F.sum("size").over(in_range), "nth": F.count(F.lit(1)).over(in_range)})
        .join(F.broadcast(offsets), "range")  # a row for each range: bounded
        .select("id", "size", "text_crc32", "key", (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("start"), (F.col("rows_before") + F.col("nth") - 1).alias("at")),
        "shard-places",
    )
    cuts = _boundaries(placed, total, n_shards, group_slack)
    shard = sum((F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    out = placed.withColumn("shard", shard)
    first = out.groupBy("shard").agg(F.min("at").alias("first"))
    return out.join(F.broadcast(first), "shard").select(  # n_shards rows
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot")
    )


def _boundaries(placed: DataFrame, total: int, n_shards: int, slack: float) -> list[int]:
    """Byte positions at which shards 1, 2, ... begin."""
    targets = [total * i // n_shards for i in range(1, n_shards)]
    hit = F.lit(False)
    for t in targets:
        hit = hit | ((F.col("start") < t) & (F.col("start") + F.col("size") > t))
    keys = placed.where(hit).select("key").distinct()  # n_shards - 1 at most
    groups = placed.join(F.broadcast(keys), "key").groupBy("key").agg(F.min("start").alias("a"), F.max(F.col("start") + F.col("size")).alias("b")).collect()
    cuts = []
    for t in targets:
        edges = [e for g in groups if g["a"] < t < g["b"] for e in (g["a"], g["b"])]
        near = min(edges, key=lambda e: abs(e - t), default=t)
        cuts.append(near if abs(near - t) <= slack * total / n_shards else t)
    return cuts
