"""Command-line job: build or refresh the tables from raw event tables.

    python -m eventlens --source prod.app=s3://bucket/raw/app \\
        --source prod.web=s3://bucket/raw/web --target s3://bucket/analytics \\
        --as-of 2024-01-30 --mode incremental --config options.json

``--source`` is ``name=path`` (repeatable; one source may omit the name),
``--format`` the raw format (``parquet``, ``delta``, ``csv`` or ``table`` for
catalog names).  Files of parquet, orc and json are taken in through the file
ledger: an incremental run reads new files only.  ``--target-format`` is the stored
tables' format, ``--database`` publishes them under catalog names.  ``--config`` is a JSON object of ``Config`` fields (custom
columns, pivots, filters, session options...).  Submit with ``spark-submit``
or run under any SparkSession; the session's own settings are kept.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from eventlens.config import Config
from eventlens.plans.pipeline import Target, run_checks, run_full, run_incremental
from eventlens.plans.publish import publish
from eventlens.sources.events import read_events, read_events_csv, union_connections
from eventlens.sources.ledger import FileSource, RawFiles

#: Formats whose files the ledger follows.
FILE_FORMATS = ("parquet", "orc", "json")


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="eventlens", description=__doc__.split("\n\n")[0])
    p.add_argument("--source", action="append", required=True, help="name=path, repeatable")
    p.add_argument("--format", default="parquet")
    p.add_argument("--target", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--mode", choices=["full", "incremental"], default="incremental")
    p.add_argument("--strategy", choices=["insert_overwrite", "delete+insert"], default="insert_overwrite")
    p.add_argument("--target-format", default="parquet")
    p.add_argument("--database", help="catalog database for the tables")
    p.add_argument("--config", help="JSON file with Config fields")
    p.add_argument("--check", action="store_true", help="run key checks on the tables; exit 1 on failures")
    return p.parse_args(argv)


def load_raw(spark: SparkSession, sources: list[str], fmt: str, default_name: str = "default.event"):
    def read(path):
        return read_events_csv(spark, path) if fmt == "csv" else read_events(spark, path, fmt)

    # a name has no slash: what follows one (a partition folder, say) is part of a path
    named = [s.split("=", 1) if "/" not in s.split("=", 1)[0] and "=" in s else [None, s] for s in sources]
    if len(named) == 1 and named[0][0] is None:
        named[0][0] = default_name
    if any(name is None for name, _ in named):
        raise SystemExit("with several sources every --source needs a name=")
    if fmt in FILE_FORMATS:
        return RawFiles({name: FileSource(path, fmt) for name, path in named})
    return union_connections({name: read(path) for name, path in named})


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parse_args(argv)
    options = {}
    if args.config:
        with open(args.config) as fh:
            options = json.load(fh)
    cfg = Config(as_of_date=args.as_of, **options)
    spark = spark or SparkSession.builder.appName("eventlens").getOrCreate()
    raw = load_raw(spark, args.source, args.format, cfg.source_name)
    target = Target(args.target, args.target_format)
    if args.mode == "full":
        run_full(spark, raw, cfg, target)
    else:
        run_incremental(spark, raw, cfg, target, strategy=args.strategy)
    if args.database:
        publish(spark, target, args.database)
    if args.check:
        failed = [r for r in run_checks(spark, target).collect() if r["failures"]]
        for r in failed:
            print(f"check failed: {r['model']}.{r['column_name']} {r['test']}: {r['failures']}")
        if failed:
            raise SystemExit(1)


if __name__ == "__main__":
    main()
