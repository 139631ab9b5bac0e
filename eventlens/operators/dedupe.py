"""De-duplicated event table.

Reference semantics: within (insert_id, people_id, event_type, date_day,
source_relation) keep the row with the smallest ``mp_processing_time_ms``
(``row_number() = 1``).  NULL keys group together (N3); NULL processing
times sort last and ties are broken by ``loader_row_id`` then ``occurred_at``
then the rest of the row (N2), so the winner is deterministic.

Plan: the winner of a group is an aggregate, ``min_by(row, order)``.
Aggregates combine map-side, so a hot group (e.g. every event without an
insert_id for one anonymous user and day) is reduced to one row per map task
before the shuffle, and the row may hold columns that have no order (maps).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.config import Config, PivotProperty
from eventlens.functions.json_props import json_property_sql, variant_property_sql
from eventlens.functions.keys import surrogate_key_sql
from eventlens.functions.timeutil import lit_date

DEDUPE_KEYS = ["insert_id", "people_id", "event_type", "date_day", "source_relation"]


def with_unique_event_id(stg: DataFrame) -> DataFrame:
    return stg.selectExpr(f"{surrogate_key_sql(*DEDUPE_KEYS)} AS unique_event_id", "*")


def date_range_filtered(stg: DataFrame, cfg: Config) -> DataFrame:
    """Events with a time (P7), from ``date_range_start`` on where it is set."""
    if cfg.date_range_start is None:
        return stg.where(F.col("occurred_at").isNotNull())
    return stg.where(F.col("occurred_at") >= lit_date(cfg.date_range_start).cast("timestamp_ntz"))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# order of the winning row: smallest processing time (NULL last), then the
# loader row id, then the event time; a hash of the rest breaks full ties
ORDER_SQL = ["isnull(mp_processing_time_ms)", "mp_processing_time_ms", "loader_row_id", "occurred_at"]


def _order(payload: list[T.StructField], order_sql: list[str]) -> str:
    """The order as fields of a struct, full ties broken by a hash of ``payload``."""
    # a map has no hash of its own; its JSON does
    hashed = ", ".join(f"to_json(named_struct('v', {_q(f.name)}))" if "map<" in f.dataType.simpleString() else _q(f.name)
                       for f in payload)
    return ", ".join(f"'_o{i}', {o}" for i, o in enumerate([*order_sql, f"xxhash64({hashed})"]))


def keep_first(df: DataFrame, keys: list[str], order_sql: list[str]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order_sql`` tuple."""
    payload = [f for f in df.schema.fields if f.name not in keys]
    order = _order(payload, order_sql)
    row = ", ".join(f"'{f.name}', {_q(f.name)}" for f in payload)
    winner = F.expr(f"min_by(named_struct({row}), named_struct({order}))").alias("_w")
    return (df.groupBy(*keys).agg(winner)
              .selectExpr(*[_q(k) for k in keys], *[f"_w.{_q(f.name)} AS {_q(f.name)}" for f in payload]))


def packed(df: DataFrame, keys: list[str], order_sql: list[str], sparse: Iterable[str] = (), made: Iterable[str] = (),
           tags: Iterable[str] = ()) -> tuple[DataFrame, list[str]] | None:
    """``keep_first`` for state that is kept: ``keys`` and a struct ``_w`` whose smallest
    value is the first row, and the SQL that takes the row's columns from it.

    A column of the order is held once, ``made`` ones (a function of the keys) not at all, and the
    ``sparse`` ones together as one null where a row has none of them.  ``tags`` (SQL) are
    held as ``_w._t0`` and so on; of fully equal rows, the one with the smallest tags comes first.
    None where a column has no order (a map)."""
    payload = [f for f in df.schema.fields if f.name not in keys]
    if any(kind in f.dataType.simpleString() for f in payload for kind in ("map<", "variant", "interval")):
        return None
    at = {o: f"_w._o{i}" for i, o in enumerate(order_sql)}
    names = [f.name for f in payload if f.name not in at and f.name not in set(made)]
    rare = [n for n in names if n in set(sparse)]
    held = [n for n in names if n not in rare]
    row = "".join(f", '_t{i}', {t}" for i, t in enumerate(tags)) + "".join(f", '_v{i}', {_q(n)}" for i, n in enumerate(held))
    if rare:
        some = " OR ".join(f"{_q(n)} IS NOT NULL" for n in rare)
        row += f", '_r', CASE WHEN {some} THEN named_struct({', '.join(f"'_v{i}', {_q(n)}" for i, n in enumerate(rare))}) END"
    at |= {n: f"_w._v{i}" for i, n in enumerate(held)} | {n: f"_w._r._v{i}" for i, n in enumerate(rare)}
    taken = [f"{at[f.name]} AS {_q(f.name)}" for f in payload if f.name in at]
    return df.selectExpr(*[_q(k) for k in keys], f"named_struct({_order(payload, order_sql)}{row}) AS _w"), taken


def dedupe_events(stg: DataFrame, cfg: Config, apply_date_range: bool = True,
                  columns: list[str] | None = None, absent: Iterable[str] = ()) -> DataFrame:
    """De-duplicated events.  ``columns`` narrows the payload to what the
    caller needs (keys, ``unique_event_id`` and run columns always come out):
    the winner struct is opaque to column pruning, so selecting first keeps
    the shuffle narrow when only metrics are derived.

    ``absent`` names columns that the raw tables of *all* staged rows lack
    (``missing_columns(raw)``); they are left out of the shuffle and come
    back as typed NULLs."""
    src = date_range_filtered(stg, cfg) if apply_date_range else stg
    pivots = [p if isinstance(p, PivotProperty) else PivotProperty(p) for p in cfg.properties_to_pivot]
    out_cols = list(stg.columns)
    if columns is not None:
        keep = set(DEDUPE_KEYS) | set(columns) | {"mp_processing_time_ms", "loader_row_id", "occurred_at"}
        if pivots:
            keep.add("event_properties")
        src = src.select(*[c for c in stg.columns if c in keep])
        out_cols = [c for c in stg.columns if c in set(columns) | set(DEDUPE_KEYS)]
    nulls = set(absent) & set(src.columns) - set(DEDUPE_KEYS) - {"mp_processing_time_ms", "loader_row_id", "occurred_at"}
    if pivots:
        nulls.discard("event_properties")
    types = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    carried = with_unique_event_id(src).select(*[c for c in ["unique_event_id", *src.columns] if c not in nulls])
    first = keep_first(carried, DEDUPE_KEYS, ORDER_SQL)
    return event_table(first, cfg, [f"CAST(NULL AS {types[c]}) AS {_q(c)}" if c in nulls else _q(c) for c in out_cols])


def event_table(winners: DataFrame, cfg: Config, columns_sql: list[str]) -> DataFrame:
    """The event table's columns from de-duplicated rows: ``columns_sql`` of the staged
    ones, then the record's rank, the run date and the pivoted properties."""
    pivots = [p if isinstance(p, PivotProperty) else PivotProperty(p) for p in cfg.properties_to_pivot]
    source, value = "event_properties", json_property_sql
    if pivots and cfg.pivot_method == "variant":
        winners = winners.selectExpr("*", "try_parse_json(event_properties) AS _properties")
        source, value = "_properties", variant_property_sql
    return winners.selectExpr(
        "unique_event_id", *columns_sql,
        "CAST(1 AS BIGINT) AS nth_event_record", f"DATE'{cfg.as_of_date.isoformat()}' AS run_date",
        *[f"{value(source, p.name)} AS {_q(p.output_name)}" for p in pivots])
