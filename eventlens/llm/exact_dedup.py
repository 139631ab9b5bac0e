"""Exact duplicates by recipes of content-defined chunks, in Spark SQL functions alone.

1. A text is cut where its content says so: at the first end of a sentence or
   line at least ``MIN_CHUNK`` characters on, else after ``MAX_CHUNK``.  Equal
   passages of different texts fall into step after a chunk or two.
2. Chunks are deduplicated to identifiers: two 64-bit hashes of a chunk under
   a salt.  The identifiers are verified against the distinct chunks, each of
   which a map task sends once; should two different chunks share one, all
   are named anew under the next salt.  So equal identifiers mean equal chunks.
3. A text is now its recipe, the ordered list of its chunks' identifiers.
   Equal recipes mean equal texts.  Recipes are named and verified likewise,
   and what is grouped and joined from here on is 16 bytes a row.

A document's text is read where it lies, twice; it never moves as a whole.
Groups are aggregates, combined map-side.  A group with more than one row in
``HOT_SHARE`` meets its rows by broadcast, and of such groups there are fewer
than ``HOT_SHARE``; the other groups meet theirs in a join by name.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fewest and most characters of a chunk that is not its text's last.
MIN_CHUNK, MAX_CHUNK = 256, 2048
#: A group is hot from this part of all rows on.
HOT_SHARE = 1024

Namer = Callable[[Column, int], tuple[Column, Column]]


def chunks_of(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The chunks of a text in order, as an array; joined, they are the text.

    A text that is not valid UTF-8 is one chunk (a regular expression would
    see replacement characters)."""
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most - 1}}}?[.!?\n]|.{{1,{most}}}"), F.lit(0))
    return F.when(F.is_valid_utf8(text), cut).otherwise(F.array(text))


def hashed_names(value: Column, salt: int) -> tuple[Column, Column]:
    """Two 64-bit hashes of a value under a salt."""
    return F.xxhash64(F.lit(2 * salt), value), F.xxhash64(F.lit(2 * salt + 1), value)


def verified_salt(values: DataFrame, namer: Namer = hashed_names) -> int:
    """The first salt under which no two different values (column ``value``) share a name."""
    for salt in count():
        a, b = namer(F.col("value"), salt)
        named = values.groupBy(a.alias("a"), b.alias("b"), "value").agg(F.lit(1).alias("one"))
        if named.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return salt
    raise AssertionError("unreachable")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalize: Callable[[Column], Column] | None = None, namer: Namer = hashed_names) -> DataFrame:
    """One row per row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after ``normalize`` (by default as they
    are).  Of a group the row with the largest id stays, ``keep_id``;
    ``group_size`` counts its rows and ``text_sha256`` is that of the
    normalised text in UTF-8.

    A null text counts as empty, and empty texts are equal.  A null id is the
    smallest; a group without ids has a null ``keep_id`` and keeps one row.  Of
    rows that repeat the largest id one is kept.  An empty table gives an empty
    result; other columns, whatever their names, are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), (normalize(text) if normalize else text).alias("text"))
    # the generator keeps the cutting from being evaluated once for each use
    cut = texts.select("id", "text", F.explode(F.array(chunks_of(F.col("text")))).alias("chunks"))

    salt = verified_salt(cut.select(F.explode("chunks").alias("value")), namer)
    named = F.transform("chunks", lambda c: F.array(*namer(c, salt)))
    recipes = stored(cut.select("id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.flatten(named).alias("value")), "dedup-recipes")

    a, b = namer(F.col("value"), verified_salt(recipes.select("value"), namer))
    rows = stored(recipes.groupBy(a.alias("a"), b.alias("b"), "id", "sha").agg(F.count("*").alias("copies")), "dedup-rows")
    groups = stored(rows.groupBy("a", "b").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")), "dedup-groups")

    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.col("group_size") * HOT_SHARE > total
    often = F.broadcast(groups.where(hot))  # fewer than HOT_SHARE rows of 32 bytes
    met = rows.join(often, ["a", "b"]).unionByName(rows.join(often, ["a", "b"], "left_anti").join(groups.where(~hot), ["a", "b"]))
    # rows equal in id and text differ in nothing: they were counted, and are laid out again
    each = met.select("id", "sha", "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return each.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
