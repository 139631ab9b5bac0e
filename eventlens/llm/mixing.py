"""Mixing sources to target weights by hierarchical budgeting.

A tree of ``levels`` columns (say domain, language, source) has a weight per
node.  The token budget flows down: each node shares its budget among its
children by weight, and a child takes at most its supply, the tokens below it
times ``max_epochs``.  What a child can't take goes to its siblings by weight
(water filling); only when a whole subtree is exhausted is there a rest for
its parent's siblings, because a node's supply is the sum of its leaves'.

Each leaf then takes a token prefix of seeded epochs: all its documents as
often as the budget holds whole epochs, then the first documents of one more
epoch, in an order drawn by (seed, document), up to the budget.

The tree is an aggregate with a row per leaf; budgets are windows over it.
The end of a leaf's prefix needs a running sum, and a leaf may hold a third of
all rows: it is cut into buckets of about ``rows_per_bucket`` documents by the
drawn number, bucket totals tell in which bucket the prefix ends, and only that
bucket's rows are summed one by one.  What remains is a row per leaf (whole
epochs, last drawn number of the partial one), against which the documents are
held in one pass: texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: A leaf table of up to so many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_LEAVES = 50_000


def word_count(text: Column) -> Column:
    """Words of a text: runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw_key(seed: int, value: Column) -> Column:
    """A 60-bit number drawn by seed and value: the head of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _on(left: DataFrame, right: DataFrame, names: list[str], mark: str) -> Column:
    """Null-safe equality of ``names`` with the columns ``mark + name`` of ``right``."""
    same = F.lit(True)
    for c in names:
        same = same & left[c].eqNullSafe(right[mark + c])
    return same


def budgets(leaves: DataFrame, levels: list[str], budget: float, weights: dict[int, DataFrame] | None = None) -> DataFrame:
    """``leaves`` (level columns, ``supply``) with each leaf's whole-token ``quota``.

    ``budget`` is the root's budget.  ``weights[d]`` maps the values of the
    first ``d + 1`` levels to a positive ``weight``; nodes without one get 1.
    Null level values are nodes of their own.

    Water filling among the children of a node, without iteration: in the
    order of supply / weight, a child is exhausted if its supply is at most
    its share of what the earlier children left, ``weight * rest / weights
    still to come``.  The test holds for a prefix of that order; all later
    children get their weight times the first later one's level.
    """
    leaves = leaves.withColumn("_root", F.lit(1))
    parent = leaves.groupBy("_root").agg(F.least(F.sum("supply").cast("double"), F.lit(float(budget))).alias("node_budget"))
    for depth in range(len(levels)):
        above, own = ["_root", *levels[:depth]], ["_root", *levels[: depth + 1]]
        nodes = leaves.groupBy(*own).agg(F.sum("supply").alias("node_supply"))
        table = (weights or {}).get(depth)
        if table is None:
            nodes = nodes.withColumn("weight", F.lit(1.0))
        else:
            given = table.select(*[F.col(c).alias(f"w_{c}") for c in own[1:]], F.col("weight").cast("double").alias("given"))
            nodes = nodes.join(given, _on(nodes, given, own[1:], "w_"), "left").select(*own, "node_supply", F.coalesce("given", F.lit(1.0)).alias("weight"))
        up = parent.select(*[F.col(c).alias(f"p_{c}") for c in above], "node_budget")
        nodes = nodes.join(up, _on(nodes, up, above, "p_")).select(*own, "node_supply", "weight", "node_budget")
        among = Window.partitionBy(*above)
        order = among.orderBy(F.col("node_supply") / F.col("weight"), own[-1])
        earlier = F.coalesce(F.sum("node_supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        to_come = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        nodes = nodes.withColumns({"rest": F.col("node_budget") - earlier, "to_come": to_come})
        nodes = nodes.withColumn("full", F.col("node_supply") * F.col("to_come") <= F.col("weight") * F.col("rest"))
        open_ratio = F.when(~F.col("full"), F.struct(F.col("node_supply") / F.col("weight"), own[-1]))
        level = F.min_by(F.when(~F.col("full"), F.col("rest") / F.col("to_come")), open_ratio).over(among)
        share = F.when(F.col("full"), F.col("node_supply").cast("double")).otherwise(F.col("weight") * F.col("level"))
        parent = nodes.withColumn("level", level).select(*own, share.alias("node_budget"))
    got = parent.select(*[F.col(c).alias(f"g_{c}") for c in levels], "node_budget")
    return leaves.join(got, _on(leaves, got, levels, "g_")).drop("_root").select(*[c for c in leaves.columns if c != "_root"], F.least(F.round("node_budget").cast("long"), F.col("supply")).alias("quota"))


def leaf_prefixes(slim: DataFrame, names: list[str], budget_share: float, max_epochs: int, weights: dict[int, DataFrame] | None, rows_per_bucket: int) -> DataFrame:
    """A row per leaf: its levels, ``quota``, ``whole`` epochs, and the last
    (``end_draw``, ``end_tie``) of its partial epoch, null where that is empty.

    ``slim`` has the levels, ``tokens``, ``draw`` and ``tie`` of each document.
    """
    leaves = slim.groupBy(*names).agg(F.sum("tokens").alias("leaf_tokens"), F.count("*").alias("rows")).withColumn("supply", F.col("leaf_tokens") * max_epochs)
    leaves = stored(leaves, "mix-leaves")
    total = leaves.agg(F.sum("leaf_tokens")).first()[0] or 0
    quotas = budgets(leaves, names, float(int(total * budget_share)), weights)
    quotas = quotas.withColumn("whole", F.floor(F.col("quota") / F.col("leaf_tokens")))
    quotas = stored(quotas.select(*[F.col(c).alias(f"q_{c}") for c in names], "quota", "whole", (F.col("quota") - F.col("whole") * F.col("leaf_tokens")).alias("rest"), F.ceil(F.col("rows") / rows_per_bucket).alias("buckets")), "mix-quotas")
    bucket = F.floor(F.col("draw") / F.lit(float(1 << 60)) * F.col("buckets"))
    small = quotas.count() <= BROADCAST_LEAVES
    dealt = slim.join(F.broadcast(quotas) if small else quotas, _on(slim, quotas, names, "q_")).withColumn("bucket", bucket)
    totals = dealt.groupBy(*names, "bucket", "rest").agg(F.sum("tokens").alias("bucket_tokens"))
    order = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = totals.withColumn("offset", F.coalesce(F.sum("bucket_tokens").over(order), F.lit(0))).where("offset < rest and offset + bucket_tokens >= rest")
    ends = ends.select(*[F.col(c).alias(f"e_{c}") for c in names], F.col("bucket").alias("e_bucket"), "offset")  # a row per leaf at most
    in_end = dealt.join(F.broadcast(ends) if small else ends, _on(dealt, ends, names, "e_") & (F.col("bucket") == F.col("e_bucket")))
    units = in_end.groupBy(*names, "draw", "tie", "rest", "offset").agg(F.sum("tokens").alias("unit_tokens"))
    running = Window.partitionBy(*names).orderBy("draw", "tie").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("start", F.col("offset") + F.coalesce(F.sum("unit_tokens").over(running), F.lit(0))).where("start < rest")
    last = units.groupBy(*names).agg(F.max(F.struct("draw", "tie")).alias("end"))
    last = last.select(*[F.col(c).alias(f"l_{c}") for c in names], "end.draw", "end.tie")
    out = quotas.select(*[F.col(f"q_{c}").alias(c) for c in names], "quota", "whole")
    return out.join(last, _on(out, last, names, "l_"), "left").select(*names, "quota", "whole", F.col("draw").alias("end_draw"), F.col("tie").alias("end_tie"))


def mix(
    docs: DataFrame,
    levels: list[Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    budget_share: float = 0.5,
    max_epochs: int = 3,
    weights: dict[int, DataFrame] | None = None,
    seed: int = 13,
    rows_per_bucket: int = 2000,
    out_col: str = "epochs",
) -> DataFrame:
    """The selected rows of ``docs`` with ``out_col``, how often each is taken (1 or more).

    ``levels`` gives the value of each of the tree's levels, top first;
    ``weights[d]`` has columns ``level0`` ... ``leveld`` and ``weight``.  The
    budget is ``budget_share`` of all tokens.  A leaf's partial epoch takes
    documents whose tokens begin before the quota's end.

    Tokens are words; texts without any (null and empty ones too) are never
    taken.  Null level values form nodes of their own.  Rows of one id and text
    are taken together.  An empty table gives an empty result.  A column of
    ``docs`` named ``out_col`` is replaced.
    """
    names = [f"level{i}" for i in range(len(levels))]
    text = F.col(text_col).cast("string")
    drawn = [draw_key(seed, F.col(id_col)), draw_key(seed, text)]
    slim = docs.select(*[v.alias(n) for n, v in zip(names, levels, strict=True)], word_count(text).alias("tokens"), drawn[0].alias("draw"), drawn[1].alias("tie"))
    slim = stored(slim.where("tokens > 0"), "mix-slim")
    prefix = stored(leaf_prefixes(slim, names, budget_share, max_epochs, weights, rows_per_bucket), "mix-prefixes")
    prefix = prefix.select(*[F.col(c).alias(f"_mix_{c}") for c in names], F.col("whole").alias("_mix_whole"), F.struct(F.col("end_draw").alias("draw"), F.col("end_tie").alias("tie")).alias("_mix_end"))
    if prefix.count() <= BROADCAST_LEAVES:
        prefix = F.broadcast(prefix)
    same = F.lit(True)
    for n, v in zip(names, levels, strict=True):
        same = same & v.eqNullSafe(F.col(f"_mix_{n}"))
    in_last = F.struct(drawn[0].alias("draw"), drawn[1].alias("tie")) <= F.col("_mix_end")
    epochs = F.col("_mix_whole") + F.when(F.col("_mix_end.draw").isNotNull() & in_last, 1).otherwise(0)
    with_words = docs.where(text.rlike(r"[^\x20\x09-\x0D]"))
    kept = [F.col(c) for c in docs.columns if c != out_col]
    return with_words.join(prefix, same).select(*kept, epochs.cast("long").alias(out_col)).where(F.col(out_col) > 0)
