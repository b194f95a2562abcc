"""Command line entry points: the scheduled jobs and the speed layer.

  python -m tributary.cli ingest  --root R --csv PATH --load-id ID
  python -m tributary.cli batch   --root R --run-id ID [--full]
  python -m tributary.cli recover --root R --run-id ID [--mode recompute|replace]
  python -m tributary.cli compact --root R --table silver|gold_minute|dlq|bronze|alerts
  python -m tributary.cli stream  --root R --servers HOST:PORT --topic T [--catalog CSV]
  python -m tributary.cli stream  --root R --messages FOLDER [--once] [--catalog CSV]

``stream`` runs until a query fails (then it ends with that error); ``--once`` takes what is
there and ends.

Every command raises on failure (non-zero exit), so a scheduler's retries see it.
"""

from __future__ import annotations

import argparse

from tributary.plans.batch import ingest_landing, run_batch
from tributary.plans.recovery import recover_dlq
from tributary.plans.store import Store
from tributary.session import get_spark
from tributary.sources.readers import file_value_stream, kafka_value_stream, payload_stream, read_catalog_csv
from tributary.streaming.progress import supervise
from tributary.streaming.runner import run_to_the_end, start_speed_layer

TABLES = {"silver": "silver", "gold_minute": "minute", "dlq": "dlq", "bronze": "bronze", "alerts": "alerts"}


def stream(spark, store: Store, args) -> None:
    if bool(args.messages) == bool(args.servers and args.topic):
        raise SystemExit("stream needs either --messages or --servers and --topic")
    values = (file_value_stream(spark, args.messages) if args.messages
              else kafka_value_stream(spark, args.servers, args.topic))
    catalog = read_catalog_csv(spark, args.catalog) if args.catalog else None
    queries = start_speed_layer(spark, payload_stream(values), store, f"{store.root}/checkpoints", catalog=catalog,
                                available_now=args.once, processing_time=args.trigger)
    if args.once:
        run_to_the_end(queries)
    else:
        supervise(queries)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tributary")
    ap.add_argument("command", choices=["ingest", "batch", "recover", "compact", "stream"])
    ap.add_argument("--root", required=True, help="shared folder holding the tables")
    ap.add_argument("--csv")
    ap.add_argument("--load-id")
    ap.add_argument("--run-id")
    ap.add_argument("--full", action="store_true", help="re-read all of Bronze")
    ap.add_argument("--mode", default="recompute", choices=["recompute", "replace"])
    ap.add_argument("--table", choices=sorted(TABLES))
    ap.add_argument("--servers")
    ap.add_argument("--topic")
    ap.add_argument("--messages", help="folder of Parquet messages (source, bronze_id, value)")
    ap.add_argument("--catalog", help="catalog CSV, for the alert digests")
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--once", action="store_true", help="take what is there, then end")
    args = ap.parse_args(argv)
    spark = get_spark(f"tributary-{args.command}")
    store = Store(spark, args.root)
    if args.command == "ingest":
        print(ingest_landing(spark, store, args.csv, args.load_id))
    elif args.command == "batch":
        run_batch(spark, store, args.run_id, incremental=not args.full).show(truncate=False)
    elif args.command == "recover":
        recover_dlq(spark, store, args.run_id, mode=args.mode).show(truncate=False)
    elif args.command == "stream":
        stream(spark, store, args)
    else:
        print(getattr(store, TABLES[args.table]).compact())


if __name__ == "__main__":
    main()
