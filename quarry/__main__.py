"""Command line for scheduled batch runs.

    python -m quarry run-manifest --manifest jobs.csv --specs mypkg.datasets:specs \
        --out /shared/datasets --as-of 2024-01-31 [--columns '{"sql_name": "sqlファイル名"}']

The manifest is a CSV (with header) or Parquet table with one row per job;
``--specs`` names a function returning ``{sql_name: DatasetSpec}``. Jobs are
selected (J2), validated (J7) and run (J1); the audit table and run log go
under ``--out``. The exit code is 1 when any job failed. With ``--inputs`` (JSON
map of SQL name to input paths) only jobs run whose input files changed since
they last succeeded.

    python -m quarry prune-versions --target /shared/datasets/orders.parquet --keep 2

deletes what the readers of a versioned dataset no longer need.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
import sys
import uuid

from quarry.plans.jobs import job_summary, jobs_from_manifest, run_manifest
from quarry.plans.refresh import refresh
from quarry.session import build_session
from quarry.sinks.versions import prune_versions


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m quarry")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run-manifest", help="run the jobs of a manifest table")
    run.add_argument("--manifest", required=True)
    run.add_argument("--specs", required=True, help="module:function returning {sql_name: DatasetSpec}")
    run.add_argument("--out", required=True)
    run.add_argument("--audit", help="audit table path (default: <out>/_audit)")
    run.add_argument("--as-of", default=dt.date.today().isoformat())
    run.add_argument("--columns", default="{}", help="JSON map of JobSpec field -> manifest column")
    run.add_argument("--parallelism", type=int, default=1)
    run.add_argument("--retries", type=int, default=0, help="further attempts of a job whose source fails")
    run.add_argument("--timeout", type=float, default=None, help="seconds that a job may take")
    run.add_argument("--committed", action="store_true", help="versioned outputs; appends may be repeated")
    run.add_argument("--run-id", default=None, help="with --committed: the id of a run that is run again")
    run.add_argument("--inputs", help="JSON map of SQL name -> input paths: run only jobs whose files changed")
    run.add_argument("--listing", help="where the listing of input files is kept (default: <out>/_listing)")
    run.add_argument("--master", default=None)
    prune = sub.add_parser("prune-versions", help="delete old versions of a versioned dataset")
    prune.add_argument("--target", required=True)
    prune.add_argument("--keep", type=int, default=2, help="replaced states that stay readable")
    prune.add_argument("--older-than", type=float, default=86_400, help="seconds that a reader or a job may take")
    prune.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = build_session(args.master, app_name="quarry-batch")
    if args.command == "prune-versions":
        for number in prune_versions(spark, args.target, args.keep, args.older_than):
            print(number)
        return 0
    return _run_manifest(spark, args)


def _run_manifest(spark, args) -> int:
    module, _, attr = args.specs.partition(":")
    specs = getattr(importlib.import_module(module), attr)()
    reader = spark.read.option("header", True)
    manifest = reader.parquet(args.manifest) if args.manifest.endswith(".parquet") else reader.csv(args.manifest)
    as_of = dt.date.fromisoformat(args.as_of)
    jobs = jobs_from_manifest(manifest, as_of, json.loads(args.columns))
    audit_path = args.audit or f"{args.out.rstrip('/')}/_audit"
    settings = {"run_id": args.run_id or uuid.uuid4().hex, "parallelism": args.parallelism, "retries": args.retries,
                "timeout_s": args.timeout, "committed": args.committed}
    if args.inputs:
        listing = args.listing or f"{args.out.rstrip('/')}/_listing"
        audit = refresh(spark, jobs, specs, json.loads(args.inputs), listing, as_of, args.out, audit_path, **settings)
    else:
        audit = run_manifest(spark, jobs, specs, as_of, args.out, audit_path, **settings)
    for row in audit.select("display_name", "target", "row_count", "result", "error").collect():
        print("\t".join("" if v is None else str(v) for v in row))
    failed = job_summary(audit).first()["failed"]
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
