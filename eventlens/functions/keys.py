"""Generated keys.

``surrogate_key`` hashes its parts the way warehouse-built tables do: every
part cast to string, NULL replaced by a fixed placeholder, parts joined by
``-``, then md5 (hex).  ``concat_key`` is the plain ``a || '-' || b`` key of
the daily and monthly tables (NULL-propagating like ``||``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.schema import SURROGATE_NULL


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts) -> Column:
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(p).cast("string"), F.lit(SURROGATE_NULL)) for p in parts]))


def surrogate_key_sql(*parts: str) -> str:
    """SQL text of ``surrogate_key`` over column names (for wide projections)."""
    inner = ", ".join(f"coalesce(cast(`{p}` as string), '{SURROGATE_NULL}')" for p in parts)
    return f"md5(concat_ws('-', {inner}))"


def concat_key(*parts) -> Column:
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit("-"))
        out.append(_col(p).cast("string"))
    return F.concat(*out)
