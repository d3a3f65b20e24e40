"""Command line of the job: ``spark-submit -m cambio`` or ``python -m cambio <command> ...``."""

from __future__ import annotations

import argparse
from datetime import datetime

from cambio.plans.daily import Warehouse, run_daily_load
from cambio.schemas import POLL_FIAT, POLL_VOLUME, default_rules
from cambio.session import build_session, shuffle_settings
from cambio.sinks.catalog import define_tables
from cambio.sources.landing import documents_of_poll, read_documents, stream_documents
from cambio.sources.poll_api import poll_to_landing, stream_polls
from cambio.streaming.incremental import run_available


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cambio")
    commands = top.add_subparsers(dest="command", required=True)

    define = commands.add_parser("define", help="create the catalog tables")
    define.add_argument("--database", required=True)
    define.add_argument("--buckets", type=int, default=32)
    define.add_argument("--reset", action="store_true", help="drop them first")

    poll = commands.add_parser("poll", help="poll the quote service into the landing folder")
    poll.add_argument("--base-url", required=True)
    poll.add_argument("--landing", required=True)
    poll.add_argument("--coins", default="btc,eth,dai")
    poll.add_argument("--fiat", default=POLL_FIAT)
    poll.add_argument("--volume", type=float, default=POLL_VOLUME)
    poll.add_argument("--every", type=int, metavar="SECONDS", help="keep polling; --landing then is for this stream alone")
    poll.add_argument("--checkpoint", help="of the stream, with --every")

    for name, text in (("daily", "load one landed poll"), ("stream", "load every poll landed since the last run")):
        command = commands.add_parser(name, help=text)
        command.add_argument("--landing", required=True)
        command.add_argument("--warehouse", required=True)
        command.add_argument("--parts", type=int, default=64, help="parts of the quotes table, fixed by its first load")
        command.add_argument("--publish", metavar="DATABASE", help="copy the tables into this database afterwards")
        command.add_argument("--shuffle-gb", type=float, help="largest expected shuffle; sizes its partitions")
        command.add_argument("--alert-to", help="recipient of the default alert rule")
        if name == "daily":
            command.add_argument("--poll-ts", type=datetime.fromisoformat, required=True)
            command.add_argument("--run-ts", type=datetime.fromisoformat, help="load time; default: now, UTC")
        else:
            command.add_argument("--checkpoint", required=True)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    sized = shuffle_settings(args.shuffle_gb) if getattr(args, "shuffle_gb", None) else {}
    spark = build_session(f"cambio-{args.command}", **sized)
    if args.command == "define":
        define_tables(spark, args.database, args.buckets, args.reset)
        return
    if args.command == "poll":
        options = {"coins": args.coins, "fiat": args.fiat, "volume": str(args.volume)}
        if args.every:
            if not args.checkpoint:
                raise SystemExit("--every needs --checkpoint")
            stream_polls(spark, args.landing, args.checkpoint, args.base_url, args.every, **options).awaitTermination()
        else:
            poll_to_landing(spark, args.landing, args.base_url, **options)
        return
    warehouse = Warehouse(spark, args.warehouse, args.parts)
    rules = default_rules(spark, args.alert_to) if args.alert_to else None
    if args.command == "daily":
        documents = documents_of_poll(read_documents(spark, args.landing), args.poll_ts)
        run_daily_load(warehouse, documents, args.run_ts, rules=rules)
    else:
        run_available(warehouse, stream_documents(spark, args.landing), args.checkpoint, rules=rules)
    if args.publish:
        warehouse.publish(args.publish)


if __name__ == "__main__":
    main()
