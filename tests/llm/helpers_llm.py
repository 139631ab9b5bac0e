"""Small document tables with every awkward case."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; extra columns of a user's table may have them.
CLASHES = ("node", "key", "keys", "range", "score", "block", "size", "tokens", "level0", "draw", "tie", "id", "component", "kept", "row_key", "shard", "ids", "base", "rank", "start", "at", "y", "label", "quota", "whole")

SYLLABLES = "an er on th ti ing re he ou ed".split()


def word(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3)))


def text(r: random.Random, n: int) -> str:
    return " ".join(word(r) for _ in range(n))


def rows(seed: int = 1, n: int = 120) -> list[tuple]:
    """Ordinary texts, exact and near copies, repeated rows, nulls, empty, tiny and long texts."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.2:
            t = r.choice(out)[1]
        elif out and kind < 0.45:
            words = (r.choice(out)[1] or "x").split(" ")
            for _ in range(max(1, len(words) // 30)):
                words[r.randrange(len(words))] = word(r)
            t = " ".join(words)
        else:
            t = text(r, r.choice([1, 2, 3, 5, 8, 30, 60]))
        out.append((i, t, r.choice(["en", "fr", None]), r.choice(["src0", "src0", "src1", "src2", "other", None]), len(t)))
    out += [(n, None, "en", "src0", None), (n + 1, "", None, "src1", 0), (n + 2, " \t\n", "en", "src1", 3), (n + 3, text(r, 6000), "en", "src3", 0), (n + 4, "é😀 ñ x " * 5, "fr", "src0", 0), (None, "no id here at all", "en", "src0", 0), (None, None, None, None, None)]
    out += [out[3], out[3], out[n]]  # repeated rows
    return out


def docs(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def with_clashes(df):
    """``df`` with extra columns of awkward names and null values."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES])
