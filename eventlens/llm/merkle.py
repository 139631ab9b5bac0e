"""A Merkle manifest of a table: leaves, a tree per group, a root, and proofs.

A row's leaf is the sha256 of its fields, each written with its length.  Leaves
are numbered inside their group, so a node is the triple (group, level, index),
and a level is a table of nodes.

Going up, every level is joined with itself: a node meets its siblings at
computed indices (XOR with 1 for a binary tree; else the other slots of its
run, by offset), and rows in slot zero, which now hold their whole run, emit the
parent.  A level's node count is known beforehand, so no level is counted.
Groups end where one node is left; those subroots are the leaves of an upper
tree, built in the same way.

Going down, a node's path (slot and siblings, level by level) is its own entry
before its parent's path, an equijoin on (group, parent index).  Both ways the
levels shrink geometrically, so the work is a small multiple of the leaves
(and, for the paths' text, of their length, the logarithm of the leaves).

All joins are on node indices, each of which occurs once, so no group, however
large, is met by one task.  Numbers come from a range-partitioned sort and the
partitions' offsets, never from a window over a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Levels of paths that one plan joins.
PATH_STEP = 6


def field_text(value: Column) -> Column:
    """``-`` of a null, else the value's UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``at``: their place in ``order`` (nulls first), from 0 without gaps.

    ``rows`` must be a stored table; where the order leaves ties, their place
    in its files decides."""
    ties = ["_file", "_row"]
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    ordered = placed.repartitionByRange(*order, *ties).sortWithinPartitions(*order, *ties)
    # the id is the partition's number (33 bits up) and the row's inside it
    kept = stored(ordered.withColumn("_id", F.monotonically_increasing_id()).drop(*ties), name)
    part, nth = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    held = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = held.select("_part", before.alias("_before"))  # a row for each partition of the sort
    return kept.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("at", F.col("_before") + nth).drop("_part", "_before", "_id")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``g, idx, n, h, ...`` with ``slot`` and ``sibs``, the run's other digests left to right."""
    slot = F.col("idx") % arity
    out = nodes.withColumn("slot", slot.cast("int"))
    found = []
    for j in range(1, arity):
        if arity == 2:
            key = F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
        else:
            key = F.col("idx") - slot + (slot + j) % arity
        other = nodes.select(F.col("g"), F.col("idx").alias(f"_at{j}"), F.col("h").alias(f"_h{j}"))
        out = out.withColumn(f"_at{j}", key).join(other, ["g", f"_at{j}"], "left")
        found.append(F.struct(F.col(f"_at{j}").alias("i"), F.col(f"_h{j}").alias("h")))
    there = F.filter(F.array(*found), lambda s: s["h"].isNotNull())
    sibs = F.transform(F.array_sort(there), lambda s: s["h"])
    return out.withColumn("sibs", sibs).drop(*[f"_{c}{j}" for j in range(1, arity) for c in ("at", "h")])


def climb(leaves: DataFrame, largest: int, arity: int, name: str) -> list[DataFrame]:
    """All levels of the trees over ``leaves`` (``g, idx, n, h``; ``n`` is the group's
    number of nodes), each stored.  ``largest`` is the greatest ``n``."""
    levels = [stored(with_siblings(leaves, arity), f"{name}-0")]
    while largest > 1:
        runs = levels[-1].where((F.col("n") > 1) & (F.col("slot") == 0))
        parents = runs.select(
            "g",
            (F.col("idx") - F.col("slot")).alias("idx"),
            F.ceil(F.col("n") / arity).cast("long").alias("n"),
            digest("h", F.array_join("sibs", "")).alias("h"),
        ).withColumn("idx", F.expr(f"idx div {arity}"))
        largest = -(-largest // arity)
        levels.append(stored(with_siblings(parents, arity), f"{name}-{len(levels)}"))
    return levels


def descend(levels: list[DataFrame], ends: DataFrame, arity: int) -> DataFrame:
    """The lowest level's rows with ``path``, bottom up, on to that of ``ends``
    (``g, path``: what lies above each group's last node)."""
    above = None
    for i, level in reversed(list(enumerate(levels))):
        own = level if i == 0 else level.select("g", "idx", "n", "slot", "sibs")
        here = own.where("n = 1").join(ends, "g")
        if above is not None:
            up = above.select("g", F.col("idx").alias("_up"), F.col("path").alias("_path"))
            entry = F.array(F.struct("slot", "sibs"))
            met = own.where("n > 1").withColumn("_up", F.expr(f"idx div {arity}")).join(up, ["g", "_up"])
            here = here.unionByName(met.withColumn("path", F.concat(entry, F.col("_path"))).drop("_up", "_path"))
        # upper levels are small: storing one now and then keeps the plans short
        above = stored(here, "merkle-paths") if i and i % PATH_STEP == 0 else here
    return above


def proof(path: Column) -> Column:
    """The digest of all siblings on a path, level by level, left to right."""
    return digest(F.array_join(F.flatten(F.transform(path, lambda p: p["sibs"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def step(acc: Column, p: Column) -> Column:
        left = F.array_join(F.slice(p["sibs"], F.lit(1), p["slot"]), "")
        right = F.array_join(F.slice(p["sibs"], p["slot"] + 1, F.size(p["sibs"])), "")
        return digest(left, acc, right)

    return F.aggregate(path, leaf, step)


@dataclass
class Manifest:
    """``rows``: ``id, leaf, claimed`` (the leaf of the claimed values), ``subroot, root,
    path``; ``groups``: ``group, n, subroot``; ``root``: None of an empty table."""

    rows: DataFrame
    groups: DataFrame
    root: str | None


def merkle_manifest(docs: DataFrame, fields: list[str], group_col: str, id_col: str, claimed: dict[str, Column] | None = None, arity: int = 2) -> Manifest:
    """The manifest of ``docs``: a tree for each value of ``group_col`` with its
    leaves by ascending ``id_col``, and a tree over the subroots by ascending group.

    ``claimed`` gives other values of some fields, for rows to be checked
    against the manifest: their leaf is ``claimed``.

    Null fields have a text of their own; a null group is a group, the first; null
    ids come first in theirs; rows equal in group and id go by their leaf, equal
    ones are leaves each.  A group of one has its leaf as subroot.  An empty table
    gives no rows and no root.  Other columns, whatever their names, are ignored.
    """
    if arity < 2:
        raise ValueError("arity must be 2 or more")
    claimed = claimed or {}
    leaf = digest(*[field_text(F.col(f)) for f in fields])
    again = digest(*[field_text(claimed.get(f, F.col(f))) for f in fields]) if claimed else F.lit(None).cast("string")
    leaves = stored(docs.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf.alias("h"), again.alias("claimed")), "merkle-leaves")
    placed = numbered(leaves, ["grp", "id", "h"], "merkle-order")

    counted = stored(placed.groupBy("grp").agg(F.count("*").alias("n"), F.min("at").alias("start")), "merkle-groups")
    groups = stored(numbered(counted, ["grp"], "merkle-group-order").withColumnRenamed("at", "g"), "merkle-groups")
    n_groups, largest = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    named = groups.select(F.col("grp").alias("_grp"), "g", "n", "start")
    nodes = placed.join(named, placed["grp"].eqNullSafe(F.col("_grp"))).select("g", (F.col("at") - F.col("start")).alias("idx"), "n", "h", "id", "claimed")
    levels = climb(nodes, largest, arity, "merkle-level")

    subroots = levels[0].where("n = 1").select("g", "h")
    for level in levels[1:]:
        subroots = subroots.unionByName(level.where("n = 1").select("g", "h"))
    subroots = stored(subroots, "merkle-subroots")
    tops = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(n_groups).cast("long").alias("n"), "h")
    upper = climb(tops, n_groups, arity, "merkle-upper")
    last = upper[-1].select("h").first()
    root = last[0] if last else None

    bare = docs.sparkSession.sql("SELECT CAST(0 AS BIGINT) AS g, CAST(array() AS ARRAY<STRUCT<slot: INT, sibs: ARRAY<STRING>>>) AS path")
    ends = stored(descend(upper, bare, arity).select(F.col("idx").alias("g"), "path", F.col("h").alias("subroot")), "merkle-ends")
    paths = descend(levels, ends.select("g", "path"), arity)
    rows = paths.join(ends.select("g", "subroot"), "g").select("id", F.col("h").alias("leaf"), "claimed", "subroot", F.lit(root).cast("string").alias("root"), "path")
    named_roots = groups.join(subroots, "g").select(F.col("grp").alias(group_col), "n", F.col("h").alias("subroot"))
    return Manifest(rows, named_roots, root)


def verified(manifest: Manifest, id_col: str = "id") -> DataFrame:
    """``id_col, leaf, subroot, root, proof_sha256, folded_root, verified``: each row's claimed
    leaf (without one its own) folded along the original siblings, and whether that is the root."""
    folded = fold(F.coalesce("claimed", "leaf"), F.col("path"))
    out = manifest.rows.select(F.col("id").alias(id_col), "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
