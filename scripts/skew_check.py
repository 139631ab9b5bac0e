"""Hot-key experiment: does one actor holding a third of all rows hurt?

usage: python scripts/skew_check.py [sf_dir] [copies] [event_log_dir]

Derives from the driver's ``events`` table (in memory, nothing written) a
variant in which every third event belongs to one anonymous actor with no
person, device or insert id, replicated ``copies`` times with shifted ids.
Times the library plans (aggregate dedupe, minute-grain sessions) with and
without the hot actor and reports the longest task of each job from the event
log.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventlens.config import Config  # noqa: E402
from eventlens.operators.dedupe import dedupe_events  # noqa: E402
from eventlens.operators.sessions import session_columns, sessions  # noqa: E402
from eventlens.operators.staging import stage_events  # noqa: E402
from eventlens.session import local_session  # noqa: E402

CFG = Config(source_name="test.events", as_of_date="2024-01-30")


def hot_raw(spark, sf_dir: str, copies: int) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    # narrow replication (no join): every row is exploded into ``copies`` copies
    x = ev.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    hot = (x.event_id % 3) == 0
    eid = x.event_id + x.copy * F.lit(10**9)
    return x.select(
        F.col("event_type").alias("name"), F.col("ts").alias("time"),
        F.when(hot, F.lit(None)).otherwise((x.user_id + x.copy * 100000).cast("string")).alias("distinct_id"),
        F.when(hot, F.lit(None)).otherwise(eid.cast("string")).alias("insert_id"),
        eid.cast("string").alias("loader_row_id"), eid.alias("mp_processing_time_ms"),
    )


def max_task_ms(log_dir: str) -> dict[int, int]:
    import zstandard

    out: dict[int, int] = {}
    for f in glob.glob(f"{log_dir}/*/events_*"):
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                info = e["Task Info"]
                dur = info["Finish Time"] - info["Launch Time"]
                sid = e["Stage ID"]
                out[sid] = max(out.get(sid, 0), dur)
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    log_dir = sys.argv[3] if len(sys.argv) > 3 else None
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else {}
    spark = local_session(8, extra=extra)
    stg = stage_events(hot_raw(spark, sf, copies), CFG)
    cases = {
        "dedupe": lambda: dedupe_events(stg, CFG),
        "sessions_minute_grain": lambda: sessions(dedupe_events(stg, CFG, columns=session_columns(CFG)), CFG),
    }
    result = {"rows": stg.count(), "copies": copies}
    for name, build in cases.items():
        build().write.format("noop").mode("overwrite").save()  # warm
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        result[name] = round(time.perf_counter() - t0, 2)
    spark.stop()
    if log_dir:
        result["max_task_ms_per_stage"] = max_task_ms(log_dir)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
