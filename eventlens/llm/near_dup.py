"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. One pass over the texts gives each document's distinct word shingles as
   64-bit hashes, ``bands * rows`` minima of them, a key per band of ``rows``
   minima, and the low ``bits`` bits of all minima packed into bit planes.
   Documents with equal sets form one class (its node is a hash of the set).
2. Nodes that share a band key are candidates.  Links inside a bucket are
   found in three rounds, of which none emits a bucket's pairs:
   twice, every member is held against one leader of its bucket; what links
   is merged into components; then, in buckets that still span several
   components, members of different components are compared in blocks: by
   their packed signatures, and where the collision-corrected estimate could
   reach the threshold by their sets' elements.  Pairs that fall short never leave their task.
3. Every candidate pair is confirmed by ``100 * |A & B| >= 80 * |A | B|`` on
   the full sets.  Confirmed links give the components.

A linked pair shares no band with probability ``(1 - j**rows) ** bands`` (3e-6
for j = 0.8 and the defaults); the estimate's cut is six standard deviations
below the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, shingle_hashes, stored, texts_of
from .components import connected_components

#: Members of a bucket, and about how many elements of their sets, that a task
#: holds against another such block.
BLOCK, BLOCK_ELEMENTS = 512, 1 << 20
SIGMAS = 6.0


def distinct_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin."""
    hashes, owner, _ = shingle_hashes(texts, n)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
        hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def set_node(hashes: np.ndarray) -> int:
    """A 64-bit name of a sorted set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def minima(hashes: np.ndarray, heads: np.ndarray, k: int) -> np.ndarray:
    """``k`` 32-bit minima of each set that begins at ``heads``."""
    out = np.empty((len(heads), k), dtype=np.uint64)
    with np.errstate(over="ignore"):
        factors = mix64(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for i in range(k):
            out[:, i] = np.minimum.reduceat((hashes * factors[i]) >> np.uint64(32), heads)
    return out


def band_keys(mins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(mins), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            out = mix64(out + mins[:, r : bands * rows : rows] + np.uint64(0x9E3779B97F4A7C15))
        return mix64(out + np.arange(bands, dtype=np.uint64)).view(np.int64)


def packed_bits(mins: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` bits of the minima: plane after plane, 64 minima a word."""
    n, k = mins.shape
    words = -(-k // 64)
    out = np.zeros((n, bits, words), dtype=np.uint64)
    for i in range(k):
        for b in range(bits):
            out[:, b, i // 64] |= ((mins[:, i] >> np.uint64(b)) & np.uint64(1)) << np.uint64(i % 64)
    return out.reshape(n, bits * words).view(np.int64)


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def document_signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int, bits: int) -> DataFrame:
    """``row_key, id, node, n_shingles, keys, planes`` of every document."""
    source = docs.select(_row_key(id_col, text_col).alias("row_key"), F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = texts_of(pdf["text"])
            for a, b in chunks(texts):
                hashes, starts = distinct_sets(texts[a:b], n)
                size = np.diff(starts)
                some = np.flatnonzero(size)
                node, keys, planes = [None] * (b - a), [[]] * (b - a), [[]] * (b - a)
                if len(some):
                    mins = minima(hashes, starts[some], bands * rows)
                    for at, key, plane in zip(some, band_keys(mins, bands, rows), packed_bits(mins, bits), strict=True):
                        node[at], keys[at], planes[at] = set_node(hashes[starts[at] : starts[at + 1]]), key, plane
                yield pd.DataFrame({"row_key": pdf["row_key"].iloc[a:b].to_numpy(), "id": pdf["id"].iloc[a:b].to_numpy(), "node": pd.array(node, dtype="Int64"), "n_shingles": size, "keys": keys, "planes": planes})

    out = source.mapInPandas(run, "row_key long, id string, node long, n_shingles long, keys array<long>, planes array<long>")
    return out.withColumn("id", F.col("id").cast("long"))


def _full_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, n: int) -> DataFrame:
    """``node, items`` for the nodes of ``wanted`` (``row_key, node``), from the whole texts."""
    source = docs.select(_row_key(id_col, text_col).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    source = source.join(wanted, "row_key").dropDuplicates(["row_key"]).select("node", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = texts_of(pdf["text"])
            for a, b in chunks(texts):
                hashes, starts = distinct_sets(texts[a:b], n)
                items = [hashes[starts[i] : starts[i + 1]].view(np.int64) for i in range(b - a)]
                yield pd.DataFrame({"node": pdf["node"].iloc[a:b].to_numpy(), "items": items})

    return source.mapInPandas(run, "node long, items array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("b_items"))
    shared = F.size(F.array_intersect("a_items", "b_items")).cast("long")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", shared.alias("shared"), (F.size("a_items") + F.size("b_items")).alias("sum"))
    return both.where(100 * F.col("shared") >= percent * (F.col("sum") - F.col("shared"))).select("a", "b")


def open_members(placed: DataFrame, facts: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of open buckets with their sets, whole: a cut element could
    coincide with another of its own set and be counted once for two."""
    return placed.join(facts, "node").join(sets.select("node", "items"), "node")


def block_links(rows: pd.DataFrame, percent: int, need: float, k: int, bits: int) -> pd.DataFrame:
    """Pairs of nodes of different components that may be linked: of one block
    (all rows on side 0), or between the two sides."""
    node, component, side = rows["node"].to_numpy(), rows["component"].to_numpy(), rows["side"].to_numpy()
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if (side == 1).any() else (np.arange(len(rows)),) * 2
    size = rows["n_shingles"].to_numpy()
    mask = component[left][:, None] != component[right][None, :]
    if left is right:
        mask &= np.triu(np.ones(mask.shape, dtype=bool), 1)
    x, y = size[left][:, None], size[right][None, :]
    mask &= 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
    if mask.any():
        planes = np.stack([np.asarray(p) for p in rows["planes"]]).view(np.uint64).reshape(len(rows), bits, -1)
        differs = np.zeros(mask.shape, dtype=np.int64)
        for w in range(planes.shape[2]):
            either = np.zeros(mask.shape, dtype=np.uint64)
            for b in range(bits):
                either |= planes[left, b, w][:, None] ^ planes[right, b, w][None, :]
            differs += np.bitwise_count(either)
        mask &= k - differs >= need
    at = np.argwhere(mask)
    if not len(at):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    a, b = left[at[:, 0]], right[at[:, 1]]
    used = np.unique(np.r_[a, b])
    place = np.zeros(len(rows), dtype=np.int64)
    place[used] = np.arange(len(used))
    items = [np.asarray(rows["items"].iloc[i]) for i in used]
    _, index, held_by = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    number = np.where(held_by > 1, np.cumsum(held_by > 1) - 1, -1)[index]  # elements of one row alone match nothing
    owner = np.repeat(np.arange(len(used)), [len(i) for i in items])
    shared = np.zeros(len(a), dtype=np.int64)
    width = int(number.max()) + 1
    for lo in range(0, max(width, 1), 1 << 15):  # so many elements at a time
        inside = (number >= lo) & (number < lo + (1 << 15))
        table = np.zeros((len(used), min(1 << 15, width - lo)), dtype=bool)
        table[owner[inside], number[inside] - lo] = True
        packed = np.packbits(table, axis=1)
        for s in range(0, len(a), 1 << 12):
            part = slice(s, s + (1 << 12))
            shared[part] += np.bitwise_count(packed[place[a[part]]] & packed[place[b[part]]]).sum(axis=1, dtype=np.int64)
    ok = 100 * shared >= percent * (size[a] + size[b] - shared)
    return pd.DataFrame({"a": np.minimum(node[a], node[b])[ok], "b": np.maximum(node[a], node[b])[ok]})


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 5,
    bits: int = 2,
) -> DataFrame:
    """Group documents whose ``n``-word shingle sets have similarity >= ``percent`` / 100.

    Returns ``id, n_shingles, component_id, kept, row_key, component``: the
    smallest id reachable over links and whether the row has it; ``component``
    is a number of the component, null for documents without words.

    A text of fewer than ``n`` words has its whole word sequence as its one
    shingle; one without words, or null, links with nothing.  Documents of
    equal sets are linked.  Null ids never become a component's id while it has
    another; in a component without any, ``component_id`` is null and ``kept``
    true.  Repeated rows are returned each.  An empty table gives no rows;
    other columns are ignored.  ``id_col`` must be integral.
    """
    k = bands * rows
    signed = stored(document_signatures(docs, id_col, text_col, n, bands, rows, bits), "near-signatures")
    classes = stored(
        signed.where("node is not null").groupBy("node").agg(
            F.min("id").alias("least_id"), F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("planes").alias("planes")
        ),
        "near-classes",
    )
    # a set of 3 shingles or fewer can equal another, but not come near it
    least = next(s for s in range(1, 101) if 100 * s >= percent * (s + 1)) if percent < 100 else 1 << 62
    keyed = classes.where(F.col("n_shingles") >= least).select("node", F.explode("keys").alias("key"))
    shared_keys = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    members = stored(keyed.join(shared_keys, "key").select("key", "node"), "near-members")
    wanted = classes.join(members.select("node").distinct(), "node").select("row_key", "node")
    sets = stored(_full_sets(docs, id_col, text_col, wanted, n), "near-sets")
    facts = classes.select("node", "n_shingles", "planes")

    match = percent / 100 + (1 - percent / 100) / 2**bits  # of two b-bit minima, at the threshold
    need = k * (match - SIGMAS * np.sqrt(match * (1 - match) / k))
    words = -(-k // 64)

    def differs(w: int) -> Column:
        out = F.lit(0).cast("long")
        for p in range(bits):
            i = p * words + w
            out = out.bitwiseOR(F.col("a_planes")[i].bitwiseXOR(F.col("b_planes")[i]))
        return F.bit_count(out)

    def similar() -> Column:
        """Whether sizes and packed signatures leave the pair a chance."""
        sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
        return sizes & (k - sum((differs(w) for w in range(words)), F.lit(0)) >= float(need))

    def of(df: DataFrame, x: str) -> DataFrame:
        return df.select(F.col("node").alias(x), F.col("n_shingles").alias(f"{x}_n"), F.col("planes").alias(f"{x}_planes"))

    edges = None
    placed = members.withColumn("component", F.col("node"))
    for turn in range(2):
        leaders = placed.groupBy("key").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("a"), F.min_by("component", F.xxhash64("node", F.lit(turn))).alias("a_component"))
        pairs = placed.join(leaders, "key").where(F.col("component") != F.col("a_component")).select("a", F.col("node").alias("b")).distinct()
        pairs = pairs.join(of(facts, "a"), "a").join(of(facts, "b"), "b").where(similar()).select("a", "b")
        found = _confirmed(pairs, sets, percent)
        edges = stored(found if edges is None else edges.unionByName(found), "near-edges")
        labels = connected_components(edges)
        placed = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("component"))
        split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).where("low != high")
        placed = stored(placed.join(split.select("key", "members"), "key"), "near-open")

    # what is left: members of different components, block by block
    open_rows = open_members(placed, facts, sets)
    held = placed.join(facts.select("node", "n_shingles"), "node").groupBy("key").agg(F.sum("n_shingles").alias("elements"))
    open_rows = open_rows.join(held, "key")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("elements") / BLOCK_ELEMENTS)).cast("int")
    open_rows = open_rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int"))
    facts_of = ["node", "component", "n_shingles", "planes", "items"]
    low = open_rows.select("key", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), "own")).alias("j"), F.lit(0).alias("side"), *facts_of)
    above = F.when(F.col("own") + 1 < blocks, F.sequence(F.col("own") + 1, blocks - 1))
    high = open_rows.select("key", F.explode(above).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), *facts_of)
    both = low.unionByName(high).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the rows of a group that may go on in the next batch
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            names = pdf[["key", "i", "j"]].to_numpy()
            heads = np.r_[0, 1 + np.flatnonzero((names[1:] != names[:-1]).any(axis=1)), len(pdf)]
            for start, stop in zip(heads[:-2], heads[1:-1], strict=True):
                yield block_links(pdf.iloc[start:stop], percent, float(need), k, bits)
            held = pdf.iloc[heads[-2] :]
        if held is not None and len(held):
            yield block_links(held, percent, float(need), k, bits)

    rest = both.mapInPandas(compare, "a long, b long").distinct()
    edges = stored(edges.unionByName(_confirmed(rest, sets, percent)), "near-edges")
    labels = connected_components(edges)

    names = classes.select("node", "least_id").join(labels, "node", "left").select("node", "least_id", F.coalesce("label", "node").alias("component"))
    names = names.join(names.groupBy("component").agg(F.min("least_id").alias("component_id")), "component").select("node", "component", "component_id")
    out = signed.select("row_key", "id", "node", "n_shingles").join(names, "node", "left")
    component_id = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept"), "row_key", "component")
