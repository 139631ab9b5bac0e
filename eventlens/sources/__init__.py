"""Sources (raw event readers, connection union, test-table adapters) and sinks."""

from eventlens.sources.events import read_events, read_events_csv, union_connections
from eventlens.sources.sinks import (
    delete_insert,
    high_water_mark,
    lookback_start,
    overwrite_partitions,
    write_full,
)

__all__ = [
    "delete_insert",
    "high_water_mark",
    "lookback_start",
    "overwrite_partitions",
    "read_events",
    "read_events_csv",
    "union_connections",
    "write_full",
]
