"""Command line: ``python -m ridelake {load,run,report} --warehouse PATH ...``

  load    clean and load CSV trip files into the raw table (exactly once per file)
  run     load, rebuild the models, run the checks (exit 1 if any fails)
  report  load report and per-file summary of the raw table
"""

from __future__ import annotations

import argparse
import json
import sys


def _files(spark, args) -> list[str]:
    if args.files:
        return list(args.files)
    if args.dir:
        from .sources.files import list_files
        return [r[0] for r in list_files(spark, args.dir, args.pattern, recursive=True).select("path").orderBy("path").collect()]
    return []


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ridelake")
    p.add_argument("command", choices=["load", "run", "report"])
    p.add_argument("--warehouse", required=True, help="root folder of the raw table and the models")
    p.add_argument("--files", nargs="*", help="CSV files to load")
    p.add_argument("--dir", help="folder of CSV or zipped CSV files to load; names are paths below it")
    p.add_argument("--pattern", default="*.{csv,csv.gz,zip}", help="file name glob within --dir")
    p.add_argument("--loaded-at", help="load timestamp (default: now)")
    p.add_argument("--reload", action="store_true", help="load files even if already committed")
    p.add_argument("--strict", action="store_true", help="treat empty text as missing")
    p.add_argument("--speed-guard", default="exact", choices=["exact", "all"], help="which trips get a speed")
    p.add_argument("--master", help="Spark master (default: from the environment)")
    args = p.parse_args(argv)

    from .operators.quality import ChecksFailed, file_summary, quality_report, raise_on_failure
    from .operators.sinks import load_trip_files, read_raw
    from .plans.pipeline import Warehouse, build_models, run_checks
    from .session import build_session

    spark = build_session(args.master)
    wh = Warehouse(args.warehouse.rstrip("/"))
    if args.command == "report":
        raw = read_raw(spark, wh.raw)
        quality_report(raw).show(truncate=False)
        file_summary(raw).orderBy("source_file").show(truncate=False)
        return 0
    report = load_trip_files(spark, _files(spark, args), wh.raw, loaded_at=args.loaded_at,
                             skip_committed=not args.reload, empty_as_missing=args.strict,
                             landing=args.dir)
    print(json.dumps(report))
    if args.command == "load":
        return 0
    tables = build_models(spark, wh, args.strict, args.speed_guard)
    results = run_checks(tables)
    results.show(100, truncate=False)
    try:
        raise_on_failure(results)
    except ChecksFailed as e:
        print(f"checks failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
