"""Command line: run the jobs.

  python -m cirrus normalize --data-dir DIR --out OUT [--year Y] [--station S] [--max-records N] [--by-day]
  python -m cirrus normalize --kafka SERVERS [--topic noaa.raw] --out OUT        (streaming)
  python -m cirrus analytics --normalized OUT | --readings JSON  --results RES [--only uc01,uc03]
  python -m cirrus stream    --uc uc01|all --readings JSON_DIR | --normalized OUT | --kafka SERVERS [--topic T]  --results RES
  python -m cirrus serve     --results RES --query s01 --from TS --to TS [--window-size 24h] [--list-name hottest]
  python -m cirrus compact   --results RES                                       (also while streams write)

Result tables live under RES/<table name>; batch runs rewrite them, streaming
jobs append micro-batches that ``serve`` reads merged by primary key.
"""

from __future__ import annotations

import argparse
import os

from cirrus.schema import SINKS
from cirrus.session import build_session


def _readings(spark, args):
    from cirrus.plans.normalize import read_normalized
    from cirrus.sources.readings import read_readings, with_event_time

    if args.normalized:
        return with_event_time(read_normalized(spark, args.normalized)[0])
    return read_readings(spark, args.readings)


def load_results(spark, root: str) -> dict:
    from cirrus.sources.sinks import is_table, read_table

    paths = {uc: f"{root.rstrip('/')}/{spec.name}" for uc, spec in SINKS.items()}
    return {uc: read_table(spark, SINKS[uc], path) for uc, path in paths.items() if is_table(spark, path)}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="cirrus", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)
    n = sub.add_parser("normalize")
    g = n.add_mutually_exclusive_group(required=True)
    g.add_argument("--data-dir")
    g.add_argument("--kafka")
    n.add_argument("--topic", default="noaa.raw")
    n.add_argument("--out", required=True)
    n.add_argument("--year")
    n.add_argument("--station")
    n.add_argument("--max-records", type=int)
    n.add_argument("--by-day", action="store_true", help="file readings by day")
    a = sub.add_parser("analytics")
    g = a.add_mutually_exclusive_group(required=True)
    g.add_argument("--normalized")
    g.add_argument("--readings")
    a.add_argument("--results", required=True)
    a.add_argument("--only")
    s = sub.add_parser("stream")
    s.add_argument("--fresh", action="store_true", help="empty the result tables and forget the checkpoints first")
    s.add_argument("--uc", required=True, choices=sorted(SINKS) + ["all"])
    g = s.add_mutually_exclusive_group(required=True)
    g.add_argument("--readings")
    g.add_argument("--normalized")
    g.add_argument("--kafka")
    s.add_argument("--topic", default="weather.readings")
    s.add_argument("--results", required=True)
    v = sub.add_parser("serve")
    v.add_argument("--results", required=True)
    v.add_argument("--query", required=True)
    v.add_argument("--from", dest="t_from", required=True)
    v.add_argument("--to", dest="t_to", required=True)
    v.add_argument("--window-size", default="24h")
    v.add_argument("--list-name", default="hottest")
    v.add_argument("--limit", type=int, help="print so many rows (default: all)")
    c = sub.add_parser("compact")
    c.add_argument("--results", required=True)
    args = p.parse_args(argv)
    spark = build_session(master=os.environ.get("CIRRUS_MASTER"))

    if args.cmd == "normalize" and args.kafka:
        from cirrus.sources.kafka import raw_events, read_topic
        from cirrus.streaming.jobs import start_normalizer

        raw = raw_events(read_topic(spark, args.kafka, args.topic))
        start_normalizer(spark, raw, args.out).awaitTermination()
    elif args.cmd == "normalize":
        from cirrus.plans.normalize import run_normalizer

        run_normalizer(spark, args.data_dir, args.out, args.year, args.station, args.max_records, args.by_day)
    elif args.cmd == "analytics":
        from cirrus.plans import usecases as U
        from cirrus.sources.bookings import bookings_frame
        from cirrus.sources.sinks import write_table

        readings = _readings(spark, args)
        wanted = args.only.split(",") if args.only else sorted(SINKS)
        for uc in wanted:
            df = U.user_notifications(readings, bookings_frame(spark)) if uc == "uc08" else U.ANALYTICS[uc](readings)
            write_table(df, SINKS[uc], os.path.join(args.results, SINKS[uc].name))
    elif args.cmd == "stream":
        from cirrus.sources.bookings import bookings_frame
        from cirrus.sources.readings import parse_readings_split, read_normalized_stream, read_readings_split
        from cirrus.streaming.jobs import start, start_dead_letters

        dead = None
        if args.normalized:
            readings = read_normalized_stream(spark, args.normalized)
        elif args.kafka:
            from cirrus.sources.kafka import read_topic

            readings, dead = parse_readings_split(read_topic(spark, args.kafka, args.topic))
        else:
            readings, dead = read_readings_split(spark, args.readings, stream=True)
        if dead is not None:
            start_dead_letters(spark, dead, os.path.join(args.results, "dead_letters"))
        if args.uc == "all":
            from cirrus.streaming.jobs import start_all

            start_all(spark, readings, args.results, bookings_frame(spark), fresh=args.fresh)
            spark.streams.awaitAnyTermination()
            return
        kwargs = {"bookings": bookings_frame(spark)} if args.uc == "uc08" else {}
        q = start(spark, args.uc, readings, os.path.join(args.results, SINKS[args.uc].name), fresh=args.fresh, **kwargs)
        q.awaitTermination()
    elif args.cmd == "serve":
        from cirrus.plans.serving import serve_stored

        out = serve_stored(spark, args.results, f"s{args.query[-2:]}", args.t_from, args.t_to, args.window_size, args.list_name)
        out = out.limit(args.limit) if args.limit else out
        print("\t".join(out.columns))
        for row in out.toLocalIterator():
            print("\t".join("" if v is None else str(v) for v in row))
    elif args.cmd == "compact":
        from cirrus.sources.sinks import compact, is_table

        for spec in SINKS.values():
            path = os.path.join(args.results, spec.name)
            if is_table(spark, path):
                compact(spark, spec, path)


if __name__ == "__main__":
    main()
