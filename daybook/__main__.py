"""Command line: ``python -m daybook <command> --root <lake> ...``.

    run       [--process-date D] [--generate N] gated daily run: Bronze check, transform,
                                                checks, load; the date defaults to yesterday
    backfill  --start D --end D [--load] [--resume]   all dates in one job per layer; missing dates
                                                are reported
    late                                        take in files that came since their dates were run
    headers                                     files whose header differs from the declared columns
    vacuum                                      remove what old commits of the tables name
    generate  --process-date D --rows N         synthetic Bronze for a date
    load      --process-date D                  publish Gold of a date to the mart
    check-bronze, transform, check-layers, check-mart   --process-date D: one step of a run
    ingest                                      process every newly landed Bronze date, then stop
    explain   --process-date D | --start D --end D   print the formatted plans of a run
    report    --process-date D | --start D --end D   the quality report (failed checks listed)

run, backfill --load and load publish to a relational mart as well with --jdbc-url (and
--jdbc-table, --jdbc-property name=value for user, password and driver).

Prints one JSON line with what was done. On a cluster the master comes from spark-submit.
"""

from __future__ import annotations

import argparse
import datetime
import json
import logging
import sys


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="daybook", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=["run", "backfill", "generate", "load", "ingest",
                                        "explain", "report", "check-bronze", "transform",
                                        "check-layers", "check-mart", "late", "headers", "vacuum"])
    ap.add_argument("--root", required=True, help="lake root (bronze/, silver/, gold/, mart/)")
    ap.add_argument("--bronze-root", default=None, help="Bronze landing folder if elsewhere")
    ap.add_argument("--process-date")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--rows", type=int, default=1_000_000)
    ap.add_argument("--generate", type=int, default=0, help="generate N events before a run")
    ap.add_argument("--load", action="store_true", help="backfill: also load the mart")
    ap.add_argument("--resume", action="store_true", help="backfill: skip what an earlier run finished")
    ap.add_argument("--checkpoint", default=None, help="ingest: stream checkpoint folder")
    ap.add_argument("--jdbc-url", default=None, help="also load this database")
    ap.add_argument("--jdbc-table", default="daily_metrics")
    ap.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
    ap.add_argument("--master", default=None)
    ap.add_argument("--verbose", action="store_true", help="log the pipeline's steps")
    args = ap.parse_args(argv)
    if args.verbose:
        logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    from daybook.operators import generate
    from daybook.plans import pipeline
    from daybook.session import get_session
    from daybook.sources import bronze, versions
    from daybook.streaming import ingest

    spark = get_session(app=f"daybook-{args.command}", master=args.master)
    paths = pipeline.Paths.under(args.root, bronze_root=args.bronze_root)

    def gen(spark_, paths_, date, n=None):
        bronze.write_bronze(generate.generate_events(spark_, date, n or args.rows), paths_.bronze)

    jdbc = {}
    if args.jdbc_url:
        jdbc = {"jdbc_url": args.jdbc_url, "jdbc_table": args.jdbc_table,
                "jdbc_props": dict(p.split("=", 1) for p in args.jdbc_property)}
    out: dict = {"command": args.command}
    if args.command == "run":
        if not args.process_date:
            today = datetime.datetime.now(datetime.timezone.utc).date()
            args.process_date = (today - datetime.timedelta(days=1)).isoformat()
        steps = pipeline.run_gated(
            spark, paths, args.process_date,
            generate=(lambda s, p, d: gen(s, p, d, args.generate)) if args.generate else None,
            **jdbc)
        out.update(date=args.process_date, silver_rows=steps["layers"]["silver"],
                   gold_rows=steps["layers"]["gold"], mart_rows=steps["mart_rows"])
    elif args.command == "backfill":
        res = pipeline.backfill(spark, paths, args.start, args.end, resume=args.resume)
        if args.load and res.dates:
            pipeline.load(spark, paths, res.dates, **jdbc)
        out.update(dates=res.dates, missing=res.missing, cleared=res.cleared_gold)
    elif args.command == "late":
        res = pipeline.apply_late_files(spark, paths)
        if res.dates:
            pipeline.load(spark, paths, res.dates, **jdbc)
        out.update(dates=res.dates, cleared=res.cleared_gold)
    elif args.command == "headers":
        bad = pipeline.header_report(spark, paths).where("NOT passed")
        out.update(files=bad.count())
        bad.show(100, truncate=False)
    elif args.command == "vacuum":
        out.update({name: len(versions.vacuum(spark, at)) for name, at in (
            ("silver", paths.silver), ("gold", paths.gold), ("mart", paths.mart),
            ("files", paths.files), ("revenue_parts", paths.revenue_parts), ("user_parts", paths.user_parts))})
    elif args.command == "generate":
        gen(spark, paths, args.process_date)
        out.update(date=args.process_date, rows=args.rows)
    elif args.command == "load":
        out.update(date=args.process_date,
                   cleared=pipeline.load(spark, paths, [args.process_date], **jdbc))
    elif args.command == "check-bronze":
        out.update(date=args.process_date,
                   files=bronze.require_bronze(spark, paths.bronze, args.process_date))
    elif args.command == "transform":
        res = pipeline.daily_run(spark, paths, args.process_date)
        out.update(dates=res.dates, cleared=res.cleared_gold)
    elif args.command == "check-layers":
        out.update(date=args.process_date, **pipeline.check_layers(spark, paths, args.process_date))
    elif args.command == "check-mart":
        out.update(date=args.process_date,
                   mart_rows=pipeline.check_mart_count(spark, paths, args.process_date))
    elif args.command == "ingest":
        q = ingest.start(spark, paths, checkpoint=args.checkpoint, available_now=True)
        q.awaitTermination()
        progress = q.recentProgress
        out.update(batches=sum(1 for p in progress if p["numInputRows"] > 0),
                   new_files=sum(p["numInputRows"] for p in progress))
    elif args.command == "explain":
        dates = ([args.process_date] if args.process_date
                 else pipeline.date_range(args.start, args.end))
        for name, df in pipeline.plans_for(spark, paths, dates).items():
            print(f"== {name} ==", file=sys.stderr)
            df.explain("formatted")
        out.update(dates=dates)
    elif args.command == "report":
        dates = ([args.process_date] if args.process_date
                 else pipeline.date_range(args.start, args.end))
        rows = pipeline.quality_report(spark, paths, dates).collect()  # dates x checks rows
        out.update(dates=dates, checks=len(rows),
                   failed=sorted([r.process_date.isoformat(), r.check, r.observed, r.expected]
                                 for r in rows if not r.passed))
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
