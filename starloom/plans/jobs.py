"""End-to-end loads: the music lake, store and warehouse, and the travel lake.

Text sources are parsed once into columnar scratch tables and every output is built from those.
Outputs that do not depend on each other are submitted to the session together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from contextvars import copy_context
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from starloom import schemas
from starloom.operators import loads, quality
from starloom.operators.conflicts import insert_if_absent, without_stored
from starloom.operators.ids import surrogate_id
from starloom.operators.releases import Layout, Load, Releases, Visible
from starloom.plans import music, travel
from starloom.session import materialize, scratch_tables
from starloom.sources import labels, staging
from starloom.sources.catalogue import stage_changed
from starloom.sources.files import read_csv, read_table


def run_together(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Submit independent jobs to one session at the same time; returns their results, the first error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(spark)(job)) for job in jobs]
        return [done.result() for done in running]


# --- music lake -----------------------------------------------------------------------------
TIME_PARTITIONS = ("year", "month")


def _stage(
    spark: SparkSession, songs: str, events: str, target: str, max_rejects: int | None, anew: bool,
) -> tuple[DataFrame, DataFrame]:
    """Songs and plays; lines that do not fit go to ``target/rejects``, or fail the load beyond the budget.

    The parsed songs stay in ``target/catalogue``, so a later load parses only the song files that have changed.
    """
    def set_aside(name: str, staged: staging.Staged | None) -> None:
        if staged is not None and staged.reject_count:
            loads.write_parquet(staged.rejects, f"{target}/rejects/{name}")

    def stage_songs() -> DataFrame:
        rows, staged = stage_changed(
            spark, songs, f"{target}/catalogue", schemas.LAKE_SONGS, max_rejects, "half_up", anew)
        set_aside("songs", staged)
        return rows

    def stage_events() -> DataFrame:
        staged = staging.stage_json(spark, events, schemas.LAKE_EVENTS, max_rejects, "half_up")
        set_aside("events", staged)
        return music.only_plays(staged.rows)

    return tuple(run_together(spark, [stage_songs, stage_events]))


def run_music_lake(
    spark: SparkSession, source: str, target: str, song_partitions: Sequence[str] = ("year",), max_rejects: int | None = 0,
) -> dict[str, str]:
    """Rebuild the whole lake from ``source/song_data`` and ``source/log_data``.

    Songs go into one directory per year, sorted by artist within it; pass
    ``("year", "artist_id")`` for one directory per artist where the artists are few.
    A line that is no JSON object or has a value that its column cannot hold is rejected whole, never loaded with a
    null in its place. More than ``max_rejects`` of them in either source stop the load; up to that number (None: any)
    they are kept as they are, with the columns at fault, in ``target/rejects/songs`` and ``target/rejects/events``.
    Returns the path of each table.
    """
    with scratch_tables(spark):
        songs, plays = _stage(spark, f"{source}/song_data", f"{source}/log_data", target, max_rejects, anew=True)
        return _write_lake(spark, songs, plays, target, song_partitions)


def _write_lake(
    spark: SparkSession, songs: DataFrame, events: DataFrame, target: str, song_partitions: Sequence[str],
) -> dict[str, str]:
    tables = music.build_star(events, songs, "lake")
    layouts = {"songs": tuple(song_partitions), "time": TIME_PARTITIONS, "songplays": TIME_PARTITIONS}
    sorting = {"songs": ("artist_id",), "time": ("start_time",), "songplays": ("start_time",)}
    paths = {name: f"{target}/{name}" for name in tables}
    run_together(spark, [
        lambda name=name, df=df: loads.write_parquet(
            df, paths[name], layouts.get(name, ()), sort_by=sorting.get(name, ()))
        for name, df in tables.items()
    ])
    return paths


def refresh_music_lake(
    spark: SparkSession, source: str, target: str, run_ts: datetime,
    logs: str = "log_data/{run.year}/{run.month}", song_partitions: Sequence[str] = ("year",), max_rejects: int | None = 0,
) -> dict[str, str]:
    """Load only the run's month: ``source/log_data/<year>/<month>``, and the song files that have changed.

    The month's directories of ``time`` and ``songplays`` are replaced, so a rerun changes
    nothing; dimension rows that are not stored yet are appended. The lake must exist, and the
    month's files must hold plays of that month only: others would replace their own month's
    directories, so they are refused. ``max_rejects`` is as in ``run_music_lake``.
    """
    with scratch_tables(spark):
        logs = staging.scoped_path(logs, run_ts)
        songs, plays = _stage(spark, f"{source}/song_data", f"{source}/{logs}", target, max_rejects, anew=False)
        return _refresh_lake(spark, songs, plays, target, run_ts, logs, song_partitions)


def _refresh_lake(
    spark: SparkSession, songs: DataFrame, events: DataFrame, target: str, run_ts: datetime, logs: str,
    song_partitions: Sequence[str],
) -> dict[str, str]:
    start = F.col("start_time")
    strays = music.play_times(events).filter((F.year(start) != run_ts.year) | (F.month(start) != run_ts.month))
    if not strays.isEmpty():
        raise quality.QualityError(f"{logs} holds plays of other months")
    tables = music.build_star(events, songs, "lake")
    # Ids count from 0 in every load; the month in front keeps them apart from those of other loads.
    first_id = (run_ts.year * 100 + run_ts.month) << 40
    tables["songplays"] = tables["songplays"].withColumn("songplay_id", F.col("songplay_id") + F.lit(first_id))
    paths = {name: f"{target}/{name}" for name in tables}

    def add_rows(name: str) -> None:
        df = tables[name]
        stored = spark.read.schema(df.schema).parquet(paths[name]).select(*df.columns)
        partitions = tuple(song_partitions) if name == "songs" else ()
        loads.write_parquet(df.subtract(stored), paths[name], partitions, mode="append")

    run_together(spark, [
        *[lambda name=name: loads.write_parquet(
            tables[name], paths[name], TIME_PARTITIONS, sort_by=("start_time",), refresh_partitions=True)
          for name in ("time", "songplays")],
        *[lambda name=name: add_rows(name) for name in ("songs", "artists", "users")],
    ])
    return paths


# --- relational music store -----------------------------------------------------------------
@dataclass(frozen=True)
class StoreConfig:
    """Where the store load reads from and what makes a play known already.

    Without ``plays_key`` a rerun appends the plays again, as generated ids never conflict; with
    it, plays whose key is stored are skipped. ``first_song_per_file`` reads one song per file.
    Users are kept in ``user_parts`` parts; a load rewrites those that its users fall into.
    """

    database: str
    song_path: str
    log_path: str
    plays_key: tuple[str, ...] = ()
    first_song_per_file: bool = False
    location: str | None = None
    user_parts: int = 16


def run_music_store(spark: SparkSession, config: StoreConfig) -> DataFrame:
    """Songs, artists, times, users and songplays, published together; existing keys are respected.

    Songs, artists and times already stored stay as they are, users get the level of their
    latest play, plays are appended. Required columns and lengths are counted while the new rows are written, keys and
    references are checked on the new rows and the stored ones in their reach, so the check does not grow with the
    tables. Returns the violations per constraint; if there are any it raises, and every table stays as it was.
    """
    declared = schemas.STORE
    releases = Releases(
        spark, config.database, declared, {"users": Layout(part_by=("user_id",), parts=config.user_parts)}, config.location)

    with scratch_tables(spark), releases.load() as load:
        def read_songs() -> DataFrame:
            return materialize(staging.load_json(
                spark, config.song_path, schemas.STAGING_SONGS, first_only=config.first_song_per_file), "songs")

        def read_plays() -> DataFrame:
            return materialize(music.only_plays(staging.load_json(spark, config.log_path, schemas.STAGING_EVENTS)), "plays")

        songs, events = run_together(spark, [read_songs, read_plays])
        times = music.play_times(events)
        known_times = loads.stored_within(times, releases.table("time"), "start_time")
        parts = releases.touched("users", music.user_rows(events))
        load_rows = {
            "songs": insert_if_absent(music.build_songs(songs, "none"), releases.table("songs"), ["song_id"], prune=True),
            "artists": insert_if_absent(music.build_artists(songs, "none"), releases.table("artists"), ["artist_id"], prune=True),
            "time": music.build_time(without_stored(times, known_times, ["start_time"])),
            "users": music.build_users(events, existing=releases.rows_of_parts("users", parts)),
        }
        run_together(spark, [
            lambda t=t, df=df: load.write(t, df, rules=schemas.CONSTRAINTS[t], parts=parts) for t, df in load_rows.items()])
        new = {t: load.rows(t) for t in load_rows}
        catalogue = music.catalogue_of(*[releases.table(t).unionByName(new[t]) for t in ("songs", "artists")])
        stored = releases.table("songplays") if config.plays_key else None
        if "start_time" in config.plays_key:
            stored = loads.stored_within(times, stored, "start_time")
        plays = music.build_songplays(events, catalogue, ids=None, known=stored, known_by=config.plays_key)
        first_id = _next_id(releases)
        numbered = surrogate_id(plays, "songplay_id", dense=True, order=["start_time"], start=first_id)
        load.write(
            "songplays", numbered.select(*declared["songplays"].fieldNames()), rules=schemas.CONSTRAINTS["songplays"])
        load.note("songplays", str(first_id + load.seen["songplays"]["rows"]))
        reach = new | {"time": known_times.unionByName(new["time"]), "songplays": load.rows("songplays")}
        keys = {t: {r: v for r, v in rules.items() if r in ("primary_key", "references")} for t, rules in schemas.CONSTRAINTS.items()}
        found = [tuple(r) for r in quality.check_declared(reach, keys).collect()]  # one row per constraint
        found += [(t, c, n) for t in schemas.CONSTRAINTS for c, n in load.violations(t).items()]
        report = spark.createDataFrame(found, quality.VIOLATIONS)
        quality.enforce(report)
        load.publish()
    return report


def _next_id(releases: Releases) -> int:
    """The id after the largest stored one, as the last load has noted it."""
    return int(releases.visible("songplays").note or 1)


# --- scheduled music warehouse --------------------------------------------------------------
@dataclass(frozen=True)
class WarehouseConfig:
    """Where a scheduled load reads from and how it writes.

    ``log_path`` may hold ``{run.year}`` and ``{run.month}``. ``variant`` is ``scheduled`` (hashed
    play ids) or ``warehouse`` (ids that count up). ``fact_mode`` is ``append-new`` (a rerun adds
    nothing, needs hashed ids) or ``append`` (a rerun appends the plays again).
    ``incremental_time`` adds the new plays' times instead of deriving the time table from every
    stored play; the outcome is the same. It is the default unless dimensions are appended to. It takes effect where the
    time table is known to hold the times of just the stored plays, else the table is derived anew.
    Songs and plays are in ``buckets`` buckets by song, so that joining them needs no shuffle.
    """

    database: str
    log_path: str
    song_path: str
    json_paths: str | None = None
    fact_mode: str = "append-new"
    dimension_mode: str = "delete-load"
    location: str | None = None
    variant: str = "scheduled"
    incremental_time: bool | None = None
    buckets: int = 8


def run_music_warehouse(spark: SparkSession, config: WarehouseConfig, run_ts: datetime) -> DataFrame:
    """Stage events and songs, build the fact and the dimensions, publish all of them together, then check every table.

    Every row is written once, to where it stays. A value its table does not allow (null, too long) is counted on the
    way; it stops the load before readers see anything of it. Returns the check results; raises if a table is empty.
    """
    if config.fact_mode not in ("append", "append-new"):
        raise ValueError(f"unknown fact mode {config.fact_mode!r}")
    if config.dimension_mode not in ("append-only", "delete-load"):
        raise ValueError(f"unknown load mode {config.dimension_mode!r}")
    if config.variant != "scheduled" and (config.fact_mode == "append-new" or config.incremental_time):
        raise ValueError("ids that count up differ on every run; use fact_mode='append', incremental_time=False")
    scheduled = config.variant == "scheduled"
    declared = schemas.WAREHOUSE if scheduled else schemas.COUNTED_WAREHOUSE
    rules = schemas.WAREHOUSE_CONSTRAINTS if scheduled else schemas.COUNTED_CONSTRAINTS
    by_song = Layout(bucket_by=("song_id",), buckets=config.buckets, sort_by=("song_id",))
    layouts = {
        "songs": replace(by_song, statistics=("song_id", "artist_id", "year", "duration")),
        "songplays": replace(by_song, lookup=("user_id", "session_id"), statistics=("start_time", "user_id", "song_id", "session_id")),
    }
    releases = Releases(spark, config.database, declared, layouts, config.location)
    keep = config.dimension_mode == "append-only"

    with scratch_tables(spark), releases.load() as load:
        def write(table: str, rows: DataFrame, keep: bool, **options) -> None:
            load.write(table, rows, keep, rules.get(table), **options)

        def stage_events() -> None:
            path, schema = staging.scoped_path(config.log_path, run_ts), declared["staging_events"]
            if config.json_paths is None:
                events = staging.load_json(spark, path, schema)
            else:
                events = staging.load_json_paths(spark, path, staging.read_json_paths(spark, config.json_paths), schema)
            write("staging_events", events, keep=False)

        def stage_songs() -> None:
            songs = staging.load_json_repaired(spark, config.song_path, declared["staging_songs"])
            write("staging_songs", songs, keep=False)

        run_together(spark, [stage_events, stage_songs])
        load.enforce()
        events, songs = load.rows("staging_events"), load.rows("staging_songs")
        variant = music.VARIANTS[config.variant]
        first_id = _next_id(releases)
        known = None
        if config.fact_mode == "append-new":
            known = loads.stored_within(music.play_times(events, variant.precision), releases.table("songplays"), "start_time")
        tables = music.build_star(events, songs, variant, first_id, known)

        def write_plays() -> None:
            computed = {"songplay_id": music.hashed_id()} if variant.ids == "hash" else {}
            write("songplays", tables["songplays"], keep=True, computed=computed)

        dimensions = ["songs", "users", "artists"] + ["time"] * variant.time_distinct
        run_together(spark, [write_plays, *[lambda t=t: write(t, tables[t], keep) for t in dimensions]])
        if variant.ids == "dense":
            load.note("songplays", str(first_id + load.seen["songplays"]["rows"]))
        if not variant.time_distinct:
            _write_times(load, config, variant, rules)
        load.enforce()
        load.publish()

    checked = ("songs", "users", "artists", "time", "songplays")
    run_together(spark, [lambda t=t: loads.refresh_statistics(spark, releases.stored(t), columns=False) for t in checked])
    return quality.run_sql_checks(spark, quality.not_empty_checks([releases.name(t) for t in checked]))


def _write_times(load: Load, config: WarehouseConfig, variant: music.Variant, rules: dict) -> None:
    """The time table, from the plays: those of this load, if the table stands for just the plays stored before."""
    releases, plays = load.releases, load.rows("songplays")
    before, incremental = releases.visible("songplays"), config.incremental_time
    incremental = config.dimension_mode == "delete-load" if incremental is None else incremental
    grows = incremental and releases.visible("time").note == _stands_for(before)
    if not grows:
        plays = releases.table("songplays").unionByName(plays)
    keep = grows or config.dimension_mode == "append-only" and not incremental
    times = music.build_time(plays, variant.weekday, distinct=False)
    load.write("time", times, keep, rules.get("time"), note="" if keep and not grows else _stands_for(load.after["songplays"]))


def _stands_for(plays: Visible) -> str:
    return f"songplays {plays.first}-{plays.last}"


# --- travel lake ----------------------------------------------------------------------------
@dataclass(frozen=True)
class TravelSources:
    """Paths of the travel sources; the immigration table may be in any installed format.

    ``blocks`` are ranges of lines of the label file; with ``label_lines_per_file=False`` the lines of several label
    files are numbered through, in name order.
    """

    labels: str
    airports: str
    demographics: str
    immigration: str
    immigration_format: str = "parquet"
    blocks: tuple[labels.LabelBlock, ...] = (labels.COUNTRIES, labels.CITIES, labels.STATES)
    label_lines_per_file: bool = True


LABEL_TABLES = {"country_code": "countries", "city_code": "cities", "state_code": "states"}


def run_travel_lake(spark: SparkSession, sources: TravelSources, target: str) -> dict[str, str]:
    """Code lists, airports, demographics and immigration; each is checked before it is written.

    A line of a code list that holds no ``=`` stops the load.
    Generated ids are unique by construction, so tables keyed by one are only checked for rows.
    Returns the path of each table.
    """
    with scratch_tables(spark):
        return _write_travel(spark, sources, target)


def _write_travel(spark: SparkSession, sources: TravelSources, target: str) -> dict[str, str]:
    lines = labels.numbered_lines(spark, sources.labels, sources.label_lines_per_file)
    dropped = labels.lines_without_pair(lines, sources.blocks).collect()  # one row per block
    if dropped:
        raise quality.QualityError("; ".join(f"{r['label']}: {r['lines']} lines without '='" for r in dropped))
    airports = travel.build_airports(read_csv(spark, sources.airports, schemas.AIRPORTS_CSV))
    demographics = travel.build_demographics(read_csv(spark, sources.demographics, schemas.DEMOGRAPHICS_CSV, ";"))
    immigration = travel.build_immigration(
        read_table(spark, sources.immigration, sources.immigration_format, schemas.IMMIGRATION_SOURCE))

    def keyed(key: str) -> Callable[[DataFrame], object]:
        return lambda df: quality.data_quality_check(df, key)

    plan = [(LABEL_TABLES[b.code], travel.build_labels(lines, b), keyed(b.code), ()) for b in sources.blocks]
    plan += [
        ("airports", airports, keyed("airport_id"), ()),
        ("demographic", demographics, quality.check_not_empty, ("state",)),
        ("immigration", immigration, quality.check_not_empty, TIME_PARTITIONS),
    ]
    paths = {name: f"{target}/{name}" for name, *_ in plan}
    run_together(spark, [
        lambda name=name, df=df, check=check, layout=layout: loads.gated_write(
            df, [check], lambda rows: loads.write_parquet(rows, paths[name], layout))
        for name, df, check, layout in plan
    ])
    return paths
