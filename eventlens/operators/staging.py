"""Staged event table (D1) and all-time first events.

``stage_events`` is one narrow projection over the raw scan: global filter
on raw names (P6), conform to the 44-column catalogue with typed NULLs for
missing columns (P1/P2), provenance (S3), pass-through columns (P3), then
``date_day`` (P4) and ``event_type`` (P5).  No shuffle; Catalyst prunes the
raw scan to the columns the downstream plan actually uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.timeutil import sql_filter
from eventlens.schema import EVENT_COLUMNS


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def conformed_columns(raw: DataFrame, raw_names: dict[str, str] | None = None) -> list[str]:
    """SQL projections onto the catalogue: present columns cast when their
    type differs (``try_cast``: dirty values become NULL), missing ones typed
    NULLs.  Text, so a 44-column projection is one call into the JVM."""
    present = {f.name.lower(): f for f in raw.schema.fields}
    out = []
    for name, dtype, alias in EVENT_COLUMNS:
        target = _q(alias or name)
        field = present.get((raw_names or {}).get(name, name).lower())
        if field is None:
            out.append(f"CAST(NULL AS {dtype.simpleString()}) AS {target}")
        elif field.dataType == dtype:
            out.append(f"{_q(field.name)} AS {target}")
        else:
            out.append(f"try_cast({_q(field.name)} AS {dtype.simpleString()}) AS {target}")
    return out


def _projections(raw: DataFrame, cfg: Config) -> tuple[list[str], list[str]]:
    """SQL of the staged columns: those of the raw row, and those made from them."""
    rel = "CAST(source_relation AS STRING)" if "source_relation" in raw.columns else _lit(cfg.source_name)
    if not cfg.preserve_source_case:
        rel = f"lower({rel})"
    custom = [f"{c.transform_sql or _q(c.name)} AS {_q(c.output_name)}" for c in cfg.custom_columns]
    made = ["to_date(occurred_at) AS date_day", "lower(event_type_original_casing) AS event_type"]
    return [*conformed_columns(raw, cfg.raw_names), f"{rel} AS source_relation", *custom], made


def stage_events(raw: DataFrame, cfg: Config) -> DataFrame:
    cond = sql_filter(cfg.event_filter)
    if cond is not None:
        raw = raw.where(cond)
    fields, made = _projections(raw, cfg)
    return raw.selectExpr(*fields).selectExpr("*", *made)


def stage_sql(raw: DataFrame, cfg: Config, relation: str) -> str:
    """The staged rows as SQL over ``relation``, whose columns are those of ``raw``."""
    if cfg.event_filter is not None and not isinstance(cfg.event_filter, str):
        raise ValueError("a view needs event_filter as SQL text")
    fields, made = _projections(raw, cfg)
    where = f" WHERE {cfg.event_filter}" if cfg.event_filter else ""
    return f"SELECT *, {', '.join(made)} FROM (SELECT {', '.join(fields)} FROM {relation}{where})"


def missing_columns(raw: DataFrame, raw_names: dict[str, str] | None = None) -> list[str]:
    """Output names of catalogue columns that ``raw`` does not have: NULL on
    every row staged from it (and from it alone)."""
    present = {f.name.lower() for f in raw.schema.fields}
    names = raw_names or {}
    return [alias or name for name, _, alias in EVENT_COLUMNS if names.get(name, name).lower() not in present]


def _lit(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def user_first_events(stg: DataFrame) -> DataFrame:
    """All-time first day per person, connection and event type (A1).

    Computed on the staged table, i.e. before dedupe and before
    ``date_range_start`` (N17).  Partial aggregation makes it skew-safe.
    """
    return (stg.groupBy("people_id", "source_relation", "event_type")
               .agg(F.min("date_day").alias("first_event_day")))
