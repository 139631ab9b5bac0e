"""Streaming entry points: micro-batches that feed the incremental run, and a stateful dedupe."""

from eventlens.streaming.dedupe import start_dedupe
from eventlens.streaming.ingest import start_ingest, touched_days

__all__ = ["start_dedupe", "start_ingest", "touched_days"]
