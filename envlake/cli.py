"""python -m envlake.cli {ingest,pipeline,load,backfill,gold,migrate,collect} ..."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import functions as F

from .domain import CONTRACTS, WATER, WEATHER
from .plans import collector, medallion, relational, reports
from .session import session
from .sources import raw


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="envlake", description="Environmental readings, from endpoints to reports.")
    commands = top.add_subparsers(dest="command", required=True)
    one = commands.add_parser("ingest", help="read an endpoint into a raw batch")
    one.add_argument("--url", required=True)
    one.add_argument("--dataset", required=True, choices=sorted(CONTRACTS))
    one.add_argument("--raw", required=True)
    one.add_argument("--token")
    one.add_argument("--label")
    one.add_argument("--per-minute", type=int, default=30)
    one.add_argument("--timeout", type=float, default=15.0)
    for name, text in (("pipeline", "raw batches to tables to the star schema"), ("load", "raw batches to the relational model and the tables"), ("backfill", "load some days again")):
        two = commands.add_parser(name, help=text)
        for option in ("--raw", "--silver"):
            two.add_argument(option, required=True)
        for option in ("--states", "--cities", "--stations"):
            two.add_argument(option, help="a register; needed until the tables have a snapshot of it")
        two.add_argument("--relational", required=name == "load", help="the folder of the relational model")
        two.add_argument("--legacy", action="append", default=[], help="an old wide table, which must hold no rows when rows are loaded")
        if name == "pipeline":
            two.add_argument("--gold", required=True)
            two.add_argument("--only-gold", action="store_true")
            two.add_argument("--first")
            two.add_argument("--last")
        elif name == "load":
            two.add_argument("--dataset", choices=sorted(CONTRACTS))
        else:
            two.add_argument("--dataset", required=True, choices=sorted(CONTRACTS))
            two.add_argument("--first", required=True)
            two.add_argument("--end", required=True, help="the day after the last")
            two.add_argument("--replace", action="store_true")
    gold = commands.add_parser("gold", help="one report")
    gold.add_argument("--report", required=True, choices=["statistics", "zscore", "alerts", "star"])
    gold.add_argument("--silver", required=True)
    gold.add_argument("--out", required=True)
    gold.add_argument("--first")
    gold.add_argument("--last")
    gold.add_argument("--limit", type=float, default=3.0)
    gold.add_argument("--factor", type=float, default=1.5)
    move = commands.add_parser("migrate", help="old wide tables to the relational model")
    move.add_argument("--relational", required=True)
    move.add_argument("--stations", required=True, help="the folder of the tables whose snapshot has the stations")
    move.add_argument("--water", help="the old table of water readings")
    move.add_argument("--weather", help="the old table of weather readings")
    move.add_argument("--archive", help="where the old tables are moved when all is done")
    move.add_argument("--confirm", action="store_true", required=True)
    take = commands.add_parser("collect", help="daily climate of municipalities' stations")
    take.add_argument("--url", required=True)
    take.add_argument("--token", default=os.environ.get("ENVLAKE_TOKEN", ""), help="or ENVLAKE_TOKEN")
    take.add_argument("--municipality", action="append", required=True, metavar="UF:ID")
    take.add_argument("--first", required=True)
    take.add_argument("--last", required=True)
    take.add_argument("--out", required=True)
    take.add_argument("--per-minute", type=int, default=30)
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session(f"envlake-{args.command}")
    if args.command == "ingest":
        done = raw.ingest(spark, args.url, args.dataset, args.raw, args.label, args.token, args.per_minute, args.timeout)
        print(done)
        return int(not done.ok)
    if args.command == "collect":
        if not args.token.strip():
            print("the collector needs a token", file=sys.stderr)
            return 1
        found = collector.collect(spark, args.url, [tuple(m.split(":", 1)) for m in args.municipality], args.first, args.last, args.token, per_minute=args.per_minute)
        found.select("uf", "id_municipio", "id_estacao", F.to_json("climate").alias("climate")).write.mode("append").json(args.out)
        return 0
    if args.command == "migrate":
        old = {name: path for name, path in ((WATER.name, args.water), (WEATHER.name, args.weather)) if path}
        archive = {path: f"{args.archive.rstrip('/')}/{name}" for name, path in old.items()} if args.archive else None
        stations = medallion.stored_registers(spark, args.stations)[0]
        print(relational.migrate({name: spark.read.parquet(path) for name, path in old.items()}, args.relational, stations, archive))
        return 0
    if args.command == "gold":
        measures = reports.read_measures(spark, args.silver, args.first, args.last)
        if args.report == "statistics":
            reports.statistics_report(measures, args.out, args.first, args.last)
        elif args.report == "zscore":
            reports.z_score_report(measures, args.out, args.limit, args.first, args.last)
        elif args.report == "star":
            reports.publish_star(measures, medallion.stored_registers(spark, args.silver), args.out, args.silver, args.factor, args.limit)
        else:
            reports.alert_report(measures, args.out, args.factor, args.limit, args.first, args.last)
        return 0
    given = (args.states, args.cities, args.stations)
    make = (lambda: medallion.registers(spark, raw.states(spark, args.states), raw.cities(spark, args.cities), raw.stations(spark, args.stations))) if all(given) else None
    registered = medallion.stored_registers(spark, args.silver, make)
    if args.command == "pipeline":
        print(medallion.run(spark, args.raw, args.silver, args.gold, registered, args.first, args.last, args.only_gold, args.relational, args.legacy))
    elif args.command == "load":
        print(medallion.load(spark, args.raw, args.silver, registered[0], [args.dataset] if args.dataset else None, args.relational, args.legacy))
    else:
        print(medallion.backfill(spark, args.raw, args.silver, registered[0], args.dataset, args.first, args.end, args.replace, args.relational, args.legacy))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
