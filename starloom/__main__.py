"""Run a load: ``python -m starloom <load> …`` (or this file through ``spark-submit``)."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from starloom.plans import jobs
from starloom.session import configure


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="starloom", description="Star-schema loads on Spark.")
    loads = parser.add_subparsers(dest="load", required=True)

    lake = loads.add_parser("music-lake", help="rebuild the music lake, or one month of it")
    lake.add_argument("source")
    lake.add_argument("target")
    lake.add_argument("--month", type=lambda text: datetime.strptime(text, "%Y-%m"), help="YYYY-MM: refresh this month only")
    lake.add_argument("--song-partitions", default="year", help="comma-separated")
    lake.add_argument("--max-rejects", type=int, default=0, help="lines per source that may be set aside, -1: any number")

    store = loads.add_parser("music-store", help="insert into the relational music tables")
    store.add_argument("database")
    store.add_argument("song_path")
    store.add_argument("log_path")
    store.add_argument("--plays-key", default="", help="comma-separated columns that make a play known")
    store.add_argument("--first-song-per-file", action="store_true")
    store.add_argument("--user-parts", type=int, default=16, help="parts of the users table, when it is created")

    warehouse = loads.add_parser("music-warehouse", help="stage, load and check the music warehouse")
    warehouse.add_argument("database")
    warehouse.add_argument("log_path", help="may hold {run.year} and {run.month}")
    warehouse.add_argument("song_path")
    warehouse.add_argument("--run", type=datetime.fromisoformat, default=None, help="run time, default now")
    warehouse.add_argument("--json-paths")
    warehouse.add_argument("--variant", choices=["scheduled", "warehouse"], default="scheduled")
    warehouse.add_argument("--fact-mode", choices=["append-new", "append"], default="append-new")
    warehouse.add_argument("--dimension-mode", choices=["delete-load", "append-only"], default="delete-load")
    warehouse.add_argument("--incremental-time", action=argparse.BooleanOptionalAction, help="default: unless dimensions are appended to")
    warehouse.add_argument("--buckets", type=int, default=8, help="buckets of songs and plays, when the tables are created")

    travel = loads.add_parser("travel-lake", help="rebuild the travel lake")
    for name in ("labels", "airports", "demographics", "immigration", "target"):
        travel.add_argument(name)
    travel.add_argument("--immigration-format", default="parquet")

    for load in (store, warehouse):
        load.add_argument("--location")
    return parser


def _columns(text: str) -> tuple[str, ...]:
    return tuple(c.strip() for c in text.split(",") if c.strip())


def run(spark: SparkSession, arguments: Sequence[str]) -> object:
    """Run the load the arguments name; returns what the load returns."""
    args = _parser().parse_args(arguments)
    if args.load == "music-lake":
        options = {"song_partitions": _columns(args.song_partitions), "max_rejects": None if args.max_rejects < 0 else args.max_rejects}
        if args.month:
            return jobs.refresh_music_lake(spark, args.source, args.target, args.month, **options)
        return jobs.run_music_lake(spark, args.source, args.target, **options)
    if args.load == "music-store":
        return jobs.run_music_store(spark, jobs.StoreConfig(
            args.database, args.song_path, args.log_path, _columns(args.plays_key), args.first_song_per_file,
            args.location, args.user_parts))
    if args.load == "music-warehouse":
        return jobs.run_music_warehouse(spark, jobs.WarehouseConfig(
            args.database, args.log_path, args.song_path, args.json_paths, args.fact_mode, args.dimension_mode,
            args.location, args.variant, args.incremental_time, args.buckets), args.run or datetime.now())
    return jobs.run_travel_lake(spark, jobs.TravelSources(
        args.labels, args.airports, args.demographics, args.immigration, args.immigration_format), args.target)


def main() -> None:
    _parser().parse_args(sys.argv[1:])  # complain before a session starts
    run(configure(SparkSession.builder.appName("starloom").getOrCreate()), sys.argv[1:])


if __name__ == "__main__":
    main()
