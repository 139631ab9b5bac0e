"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard
transform.  A hash is the signed axis nearest to the rotated unit vector; a
table's bucket is made of ``hashes`` of them.  Every vector is stored in its
bucket of each table; a query also probes the buckets in which one hash takes
its next best axes.  Candidates are ranked by exact cosine on the original
vectors, in double precision.

Vectors of equal components are stored once, with as many of their smallest
ids as a result can hold, so a very common vector is one candidate.  The query
set meets the stored vectors in blocks: each pair of a query block and a part
of the index looks up its buckets and keeps the best ``k + 1`` per query, so no
candidate pair leaves its task.  Queries for which the tables give fewer
candidates than asked for are held against all vectors, in the same blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Queries, and stored vectors, that one task holds against each other.
QUERY_BLOCK, INDEX_PART = 1024, 8192


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two long)."""
    n = x.shape[1]
    x, step = x.copy(), 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / math.sqrt(n)


def rotations(dim: int, tables: int, hashes: int, seed: int) -> np.ndarray:
    """Random signs: table, hash, round, coordinate."""
    wide = 1 << max(0, (dim - 1).bit_length())
    return np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, hashes, 3, wide))


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Pseudo-rotation of the rows of ``x``, padded to the signs' length."""
    out = np.zeros((len(x), signs.shape[-1]))
    out[:, : x.shape[1]] = x
    for s in signs:
        out = hadamard(out * s)
    return out


def axes(y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` nearest signed axes of each row, nearest first, and how far
    each is behind the first.  Axis i is 2i, its opposite 2i + 1."""
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    order = np.argsort(-both, axis=1, kind="stable")[:, :most]
    value = np.take_along_axis(both, order, axis=1)
    return order, value[:, :1] - value


def buckets(x: np.ndarray, signs: np.ndarray, probes: int) -> np.ndarray:
    """Bucket numbers: row, table, probe (the own bucket first)."""
    tables, hashes, _, wide = signs.shape
    out = np.zeros((len(x), tables, probes), dtype=np.int64)
    for t in range(tables):
        best = [axes(rotated(x, signs[t, h]), min(probes, 2 * wide)) for h in range(hashes)]
        own = np.zeros(len(x), dtype=np.int64)
        for order, _ in best:
            own = own * (2 * wide) + order[:, 0]
        out[:, t, :] = (own * tables + t)[:, None]
        if probes > 1:  # exchange one hash's axis: the least loss first
            keys, losses = [], []
            for h, (order, loss) in enumerate(best):
                scale = (2 * wide) ** (hashes - 1 - h)
                for k in range(1, order.shape[1]):
                    keys.append((own + (order[:, k] - order[:, 0]) * scale) * tables + t)
                    losses.append(loss[:, k] ** 2)
            pick = np.argsort(np.stack(losses, axis=1), axis=1, kind="stable")[:, : probes - 1]
            out[:, t, 1 : 1 + pick.shape[1]] = np.take_along_axis(np.stack(keys, axis=1), pick, axis=1)
    return out


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def _with_keys(df: DataFrame, tables: int, hashes: int, probes: int, seed: int) -> DataFrame:
    """``node, vector, least`` with ``keys``: ``probes`` buckets of each table, table after table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signs: dict[int, np.ndarray] = {}
        for pdf in batches:
            for dim, same in pdf.groupby(pdf["vector"].map(len)):
                if dim not in signs:
                    signs[dim] = rotations(dim, tables, hashes, seed)
                for a in range(0, len(same), 1000):
                    part = same.iloc[a : a + 1000]
                    x = np.stack([np.asarray(v, dtype=float) for v in part["vector"]])
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    yield part.assign(keys=list(buckets(x, signs[dim], probes).reshape(len(x), -1)))

    return df.select("node", "vector", "least").mapInPandas(run, "node long, vector array<double>, least long, keys array<long>")


def cosines(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of ``x`` with each row, in double precision; scaled first where squares could overflow or vanish."""

    def tame(v: np.ndarray) -> np.ndarray:
        top = np.abs(v).max(axis=-1, keepdims=True)
        return np.where((top > 1e100) | (top < 1e-100), v / top, v)

    x, rows = tame(x), tame(rows)
    return (rows @ x) / np.sqrt((rows * rows).sum(axis=1) * (x @ x))


def _best(asked: DataFrame, index: DataFrame, tables: int, k: int, everything: bool) -> DataFrame:
    """The best ``k + 1`` candidate classes of each query in each index part: ``q, node, least, score``."""
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    parts = max(1, -(-index.count() // INDEX_PART))
    left = asked.select(F.col("node").alias("q"), "vector", "keys", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = index.select("node", "vector", "least", "keys", F.pmod(F.xxhash64("node", F.lit("part")), F.lit(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def run(_key, ask: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, rows in own.groupby(own["vector"].map(len)):
            x = np.stack([np.asarray(v, dtype=float) for v in rows["vector"]])
            keys = np.stack([np.asarray(v) for v in rows["keys"]])
            order = np.argsort(keys, axis=0, kind="stable")
            ranked = np.take_along_axis(keys, order, axis=0)
            node, least = rows["node"].to_numpy(), rows["least"].to_numpy()
            for q, vec, probes in zip(ask["q"], ask["vector"], ask["keys"], strict=True):
                if len(vec) != dim:
                    continue
                if everything:
                    near = np.arange(len(x))
                else:
                    hits = []
                    for t, wanted in enumerate(np.asarray(probes).reshape(tables, -1)):
                        low, high = np.searchsorted(ranked[:, t], wanted, "left"), np.searchsorted(ranked[:, t], wanted, "right")
                        hits += [order[a:b, t] for a, b in zip(low, high, strict=True) if a < b]
                    if not hits:
                        continue
                    near = np.unique(np.concatenate(hits))
                score = cosines(np.asarray(vec, dtype=float), x[near])
                top = np.lexsort((least[near], -score))[: k + 1]
                out += [(q, node[near[i]], least[near[i]], score[i]) for i in top]
        return pd.DataFrame(out, columns=["q", "node", "least", "score"])

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(run, "q long, node long, least long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    tables: int = 48,
    hashes: int = 2,
    probes: int = 128,
    seed: int = 3,
) -> DataFrame:
    """The ``k`` nearest rows of each query row: ``query_id, rank, id, score``.

    ``probes`` buckets of each table are looked up, whatever the number of vectors.
    Queries are the rows that ``is_query`` accepts, candidates all other rows.
    Null vectors, empty or zero ones and those with a null or non-finite
    component take no part, nor do null ids; vectors of different lengths are
    in different spaces.  Ties go to the smaller id.  Rows of equal id and
    vector are one; a query with fewer than ``k`` candidates gets them all; an
    empty table gives an empty result.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col(id_col).isNotNull() & usable(v)).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x + 0.0).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.withColumn("node", F.xxhash64("vector"))
    ids = stored(rows.select("id", "node", "asks"), "ann-ids")
    # a result holds k ids at most and may leave out the query's own
    few = ids.groupBy("node", "id").agg(F.max("asks").alias("asks"))
    few = few.withColumn("nth", F.row_number().over(Window.partitionBy("node", F.pmod("id", F.lit(64))).orderBy("id"))).where(F.col("nth") <= k + 1)
    few = few.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("nth") <= k + 1).select("node", F.col("id").alias("member"), "nth")
    few = stored(few, "ann-members")
    classes = rows.groupBy("node").agg(F.first("vector").alias("vector"), F.min("id").alias("least"), F.max("asks").alias("asks"))
    classes = stored(classes, "ann-classes")
    index = stored(_with_keys(classes, tables, hashes, 1, seed), "ann-index")
    asking = stored(_with_keys(classes.where("asks"), tables, hashes, probes, seed), "ann-queries")

    def top(df: DataFrame) -> DataFrame:
        """(q, member, score) of each query class, ``k + 1`` at most."""
        near = Window.partitionBy("q").orderBy(F.desc("score"), "least")
        order = Window.partitionBy("q").orderBy(F.desc("score"), "member")
        df = df.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
        return df.join(few, "node").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).select("q", "member", "score")

    found = stored(top(_best(asking, index, tables, k, False)), "ann-found")
    enough = found.groupBy("q").agg(F.count("*").alias("n")).where(F.col("n") > k).select(F.col("q").alias("node"))
    short = stored(asking.join(enough, "node", "left_anti"), "ann-short")
    if not short.isEmpty():
        found = found.join(short.select(F.col("node").alias("q")), "q", "left_anti").unionByName(top(_best(short, index, tables, k, True)))
    asked = ids.where("asks").select(F.col("id").alias("query_id"), F.col("node").alias("q")).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "member")
    ranked = asked.join(found, "q").where("member != query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("member").alias(id_col), "score")
