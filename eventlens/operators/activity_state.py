"""Trailing activity as state: a 28-bit day mask per person and event type.

Bit i of a mask says whether the person was active for the type i days before
the state's day.  A day's flags are bit tests (``mask & 1`` active today,
``mask != 0`` active in 28 days, ``mask & 127`` in 7, a set bit above the first
on an active day a repeat user), and a day later the mask is shifted by one.

An incremental run holds the state of the day before its range.  State and the
range's events meet in one aggregation: the state's mask, shifted by the
range's length, and one bit per active day, combined by ``bit_or`` (map-side, in
any order).  Every day of the range then reads its 28 bits of the long.  No
earlier event is read, no window is needed, and a person is one row whatever
its number of events.  ``MAX_RANGE`` days fit into a long beside the mask; a
longer range takes the sweep of ``eventlens.operators.daily``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.timeutil import lit_date, shift_date
from eventlens.operators.daily import OUT_KEYS, PERSON_KEYS, finish
from eventlens.operators.spine import days_between

#: Days of a mask, and the bits that hold them.
MASK_DAYS, MASK = 28, (1 << 28) - 1
#: Days of a range that fit into a long with the mask before it (sign bit unused).
MAX_RANGE = 63 - MASK_DAYS


def _known(ev: DataFrame) -> DataFrame:
    """Persons and types without a name never count."""
    return ev.where(F.col("people_id").isNotNull() & F.col("event_type").isNotNull())


def state_at(ev: DataFrame, day: dt.date) -> DataFrame:
    """``PERSON_KEYS, mask`` of ``day``, from the events of the 28 days that end there."""
    first = shift_date(day, days=1 - MASK_DAYS)
    held = _known(ev).where(F.col("date_day").between(lit_date(first), lit_date(day)))
    bit = F.expr(f"shiftleft(1L, datediff(DATE'{day.isoformat()}', date_day))")
    return held.groupBy(*PERSON_KEYS).agg(F.bit_or(bit).alias("mask"))


def _joint(state: DataFrame, ev: DataFrame, state_day: dt.date, end: dt.date) -> DataFrame:
    """``PERSON_KEYS, bits``: bit i is the day ``end`` - i, back to 28 days before the range."""
    days = (end - state_day).days
    if not 0 <= days <= MAX_RANGE:
        raise ValueError(f"a range of {days} days does not fit into a mask")
    old = state.select(*PERSON_KEYS, F.shiftleft("mask", days).alias("bits"))
    act = _known(ev).where((F.col("date_day") > lit_date(state_day)) & (F.col("date_day") <= lit_date(end)))
    new = act.select(*PERSON_KEYS, F.expr(f"shiftleft(1L, datediff(DATE'{end.isoformat()}', date_day))").alias("bits"))
    return old.unionByName(new).groupBy(*PERSON_KEYS).agg(F.bit_or("bits").alias("bits"))


def advance(state: DataFrame, ev: DataFrame, state_day: dt.date, day: dt.date) -> DataFrame:
    """The state of ``day``, from that of ``state_day`` and the events since.  Who was
    not active for 28 days leaves it."""
    mask = F.col("bits").bitwiseAND(F.lit(MASK).cast("long"))
    return _joint(state, ev, state_day, day).select(*PERSON_KEYS, mask.alias("mask")).where("mask != 0")


def daily_from_state(state: DataFrame, ev: DataFrame, first: DataFrame, known_types: DataFrame, state_day: dt.date, cfg: Config) -> DataFrame:
    """The daily table's rows after ``state_day``, to the end of the calendar.

    ``ev`` needs the events after ``state_day`` only, ``first`` the first events of
    those days, and ``known_types`` (connection, type) those types whose calendar
    began before; equal to ``daily_events`` over all events."""
    end = cfg.spine_end
    days = (end - state_day).days
    after, upto = lit_date(shift_date(state_day, days=1)), lit_date(end)
    if cfg.date_range_start is not None and cfg.date_range_start > state_day:
        after = lit_date(cfg.date_range_start)
    zero = F.lit(0).cast("long")

    def part(df: DataFrame, **given) -> DataFrame:
        names = ["e", "u", "nw", "rp", "t28", "t7"]
        return df.select(*OUT_KEYS, *[given.get(n, zero).alias(n) for n in names])

    bits = _joint(state, ev, state_day, end).select(
        "source_relation", "event_type", "bits", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("back"))
    seen = bits.select(
        "source_relation", "event_type", F.date_sub(upto, F.col("back")).alias("date_day"),
        F.expr(f"shiftright(bits, back) & {MASK}L").alias("mask")).where("mask != 0")
    today = F.col("mask").bitwiseAND(F.lit(1).cast("long")) == 1
    persons = seen.groupBy(*OUT_KEYS).agg(
        F.count_if(today).alias("u"), F.count_if(today & (F.col("mask") > 1)).alias("rp"),
        F.count(F.lit(1)).alias("t28"), F.count_if(F.expr("(mask & 127L) != 0")).alias("t7"))
    in_range = F.col("date_day").between(lit_date(shift_date(state_day, days=1)), upto)
    events = _known(ev).where(in_range).groupBy(*OUT_KEYS).agg(F.count(F.lit(1)).alias("e"))
    begun = first.where((F.col("first_event_day") > lit_date(state_day)) & (F.col("first_event_day") <= upto))
    fresh = _known(begun).withColumnRenamed("first_event_day", "date_day").where(F.col("date_day") >= after)
    fresh = fresh.groupBy(*OUT_KEYS).agg(F.count(F.lit(1)).alias("nw"))
    # every type has a row on every day of its calendar
    types = known_types.select("source_relation", "event_type", after.alias("from_day")).unionByName(
        begun.select("source_relation", "event_type", F.greatest("first_event_day", after).alias("from_day")))
    starts = types.groupBy("source_relation", "event_type").agg(F.min("from_day").alias("from_day")).where(F.col("from_day") <= upto)
    idle = starts.select("source_relation", "event_type", F.explode(days_between(F.col("from_day"), upto)).alias("date_day"))
    rows = part(persons, u=F.col("u"), rp=F.col("rp"), t28=F.col("t28"), t7=F.col("t7"))
    for other in (part(events, e=F.col("e")), part(fresh, nw=F.col("nw")), part(idle)):
        rows = rows.unionByName(other)
    total = rows.groupBy(*OUT_KEYS).agg(*[F.sum(c).alias(c) for c in ("e", "u", "nw", "rp", "t28", "t7")])
    return finish(total.select(
        *OUT_KEYS, F.col("e").alias("number_of_events"), F.col("u").alias("number_of_users"),
        F.col("nw").alias("number_of_new_users"), F.col("rp").alias("number_of_repeat_users"),
        F.col("t28").alias("trailing_users_28d"), F.col("t7").alias("trailing_users_7d")), cfg)
