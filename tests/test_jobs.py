"""Whole loads on small files, run twice."""

import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from fixtures import EVENTS, SONGS, SUNDAY, event
from pyspark.sql import functions as F

from starloom.__main__ import run
from starloom.operators.quality import QualityError
from starloom.plans import jobs
from starloom.schemas import IMMIGRATION_SOURCE, STAGING_EVENTS, STAGING_SONGS
from starloom.session import scratch_dir
from starloom.sources.labels import COUNTRIES, LabelBlock


def as_json(schema, row):
    return json.dumps({f.name: float(v) if hasattr(v, "as_tuple") else v for f, v in zip(schema, row) if v is not None})


def write_json(path, schema, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(as_json(schema, r) + "\n" for r in data))


@pytest.fixture
def source(tmp_path):
    """Songs in nested folders, one log file per month."""
    for i, row in enumerate(SONGS):
        write_json(tmp_path / "song_data" / "A" / str(i) / "s.json", STAGING_SONGS, [row])
    write_json(tmp_path / "log_data" / "2018" / "11" / "e.json", STAGING_EVENTS, EVENTS[:5])
    write_json(tmp_path / "log_data" / "2018" / "12" / "e.json", STAGING_EVENTS, EVENTS[5:])
    return tmp_path


def counts(spark, paths):
    return {name: spark.read.parquet(path).count() for name, path in paths.items()}


FULL = {"songs": 5, "artists": 3, "users": 5, "time": 4, "songplays": 6}


@pytest.mark.parametrize("song_partitions", [("year",), ("year", "artist_id")])
def test_music_lake(spark, source, tmp_path, song_partitions):
    for _ in range(2):
        paths = jobs.run_music_lake(spark, str(source), str(tmp_path / "lake"), song_partitions)
    assert counts(spark, paths) == FULL
    assert not list(Path(scratch_dir(spark)).glob("plays-*"))  # scratch tables are gone
    assert (tmp_path / "lake" / "songplays" / "year=2018" / "month=12").is_dir()
    songs = spark.read.parquet(paths["songs"])
    assert set(songs.columns) == {"song_id", "title", "duration", "year", "artist_id"}


def test_music_lake_refresh_reads_one_month(spark, source, tmp_path):
    target = str(tmp_path / "lake")
    paths = jobs.run_music_lake(spark, str(source), target)
    december = EVENTS[5:] + [event(SUNDAY + 30 * 86400000, 4, 60, 0, "Duo", "Tune", 1.0, first="Di")]
    write_json(source / "log_data" / "2018" / "12" / "e.json", STAGING_EVENTS, december)
    write_json(source / "log_data" / "2018" / "11" / "e.json", STAGING_EVENTS, [])  # not read
    for _ in range(2):
        jobs.refresh_music_lake(spark, str(source), target, datetime(2018, 12, 31))
    assert counts(spark, paths) == FULL | {"users": 6, "time": 5, "songplays": 7}
    write_json(source / "log_data" / "2018" / "12" / "e.json", STAGING_EVENTS, december + EVENTS[:1])
    with pytest.raises(QualityError, match="other months"):
        jobs.refresh_music_lake(spark, str(source), target, datetime(2018, 12, 31))
    assert counts(spark, paths) == FULL | {"users": 6, "time": 5, "songplays": 7}


@pytest.mark.parametrize("incremental_time", [False, True])
def test_warehouse(spark, source, tmp_path, incremental_time):
    (tmp_path / "paths.json").write_text(json.dumps({"jsonpaths": [f"$['{f.name}']" for f in STAGING_EVENTS]}))
    config = jobs.WarehouseConfig(
        "wh_test", f"{source}/log_data/{{run.year}}/{{run.month}}", f"{source}/song_data",
        json_paths=str(tmp_path / "paths.json"), location=str(tmp_path / "wh"))

    def sizes():
        return {t: spark.table(f"wh_test.`{t}`").count() for t in FULL}

    # bulk loads cut 200.5 and 200.9 to 200, so both match
    november = {"songs": 5, "artists": 3, "users": 4, "time": 5, "songplays": 5}
    config = replace(config, incremental_time=incremental_time)
    for _ in range(2):
        report = jobs.run_music_warehouse(spark, config, datetime(2018, 11, 30))
        assert sizes() == november
    assert report.filter("passed").count() == 5
    jobs.run_music_warehouse(spark, config, datetime(2018, 12, 31))
    assert sizes() == november | {"users": 1, "time": 9, "songplays": 9}
    assert dict(spark.table("wh_test.`time`").dtypes)["weekday"] == "string"
    times = spark.table("wh_test.`time`").select("start_time")
    assert rows(times) == rows(spark.table("wh_test.songplays").select("start_time"))
    again = replace(config, fact_mode="append", dimension_mode="append-only")
    jobs.run_music_warehouse(spark, again, datetime(2018, 12, 31))
    assert sizes()["songplays"] == 13 and sizes()["songs"] == 10
    with pytest.raises(ValueError):
        jobs.run_music_warehouse(spark, replace(config, fact_mode="merge"), datetime(2018, 12, 31))
    spark.sql("DROP DATABASE wh_test CASCADE")


def test_warehouse_with_counted_ids(spark, source, tmp_path):
    config = jobs.WarehouseConfig(
        "wh_counted", f"{source}/log_data", f"{source}/song_data", location=str(tmp_path / "wh"),
        variant="warehouse", fact_mode="append")
    for run in (1, 2):
        jobs.run_music_warehouse(spark, config, datetime(2018, 11, 30))
        ids = sorted(r[0] for r in spark.table("wh_counted.songplays").select("songplay_id").collect())
        assert ids == list(range(1, 14 * run + 1))
    assert spark.table("wh_counted.`time`").count() == 3
    assert {str(r["duration"]) for r in spark.table("wh_counted.songs").filter("song_id = 'S1'").collect()} == {"201"}
    with pytest.raises(ValueError, match="count up"):
        jobs.run_music_warehouse(spark, replace(config, fact_mode="append-new"), datetime(2018, 11, 30))
    spark.sql("DROP DATABASE wh_counted CASCADE")


def test_store(spark, source, tmp_path):
    config = jobs.StoreConfig("store_test", f"{source}/song_data", f"{source}/log_data/2018/11", location=str(tmp_path / "st"))

    def table(name):
        return spark.table(f"store_test.`{name}`")

    def sizes():
        return {t: table(t).count() for t in FULL}

    jobs.run_music_store(spark, config)
    november = {"songs": 4, "artists": 2, "users": 2, "time": 3, "songplays": 4}
    assert sizes() == november
    assert rows(table("users"), "user_id", "first_name", "level") == [(1, "Ann", "paid"), (2, "Bob", "free")]
    jobs.run_music_store(spark, config)  # generated ids never conflict: the plays are there twice
    assert sizes() == november | {"songplays": 8}
    keyed = replace(config, plays_key=("start_time", "user_id", "session_id"))
    jobs.run_music_store(spark, keyed)
    assert sizes() == november | {"songplays": 8}
    december = replace(keyed, log_path=f"{source}/log_data/2018/12", first_song_per_file=True)
    report = jobs.run_music_store(spark, december)
    assert sizes() == november | {"users": 3, "time": 4, "songplays": 10}
    assert sorted(r["songplay_id"] for r in table("songplays").collect()) == list(range(1, 11))
    assert report.filter("violations > 0").isEmpty() and report.count() == 18
    spark.sql("DROP DATABASE store_test CASCADE")


def test_warehouse_fails_on_an_empty_table(spark, source, tmp_path):
    write_json(source / "log_data" / "2018" / "11" / "e.json", STAGING_EVENTS, EVENTS[4:5])
    config = jobs.WarehouseConfig("wh_empty", f"{source}/log_data/2018/11", f"{source}/song_data", location=str(tmp_path / "wh"))
    with pytest.raises(QualityError):
        jobs.run_music_warehouse(spark, config, datetime(2018, 11, 30))
    spark.sql("DROP DATABASE wh_empty CASCADE")


def test_loads_stop_before_they_store_what_a_table_does_not_allow(spark, source, tmp_path):
    """A play without a user, and a title beyond the declared length: no table but staging has changed."""
    nobody = event(SUNDAY, None, 60, 0, "Duo", "Tune", 1.0)
    write_json(source / "log_data" / "2018" / "12" / "e.json", STAGING_EVENTS, [*EVENTS[5:], nobody])
    config = jobs.WarehouseConfig("wh_stop", f"{source}/log_data", f"{source}/song_data", location=str(tmp_path / "wh"))
    counted = replace(config, database="wh_stop2", variant="warehouse", fact_mode="append", location=str(tmp_path / "wh2"))
    store = jobs.StoreConfig("st_stop", f"{source}/song_data", f"{source}/log_data/2018/11", location=str(tmp_path / "st"))
    for load in (config, counted):
        with pytest.raises(QualityError, match="not null user_id"):
            jobs.run_music_warehouse(spark, load, datetime(2018, 12, 31))
    long = dict(zip(STAGING_SONGS.fieldNames(), SONGS[0])) | {"song_id": "S9", "title": "t" * 300}
    write_json(source / "song_data" / "A" / "9" / "s.json", STAGING_SONGS, [tuple(long.values())])
    with pytest.raises(QualityError, match="length title"):
        jobs.run_music_store(spark, store)
    for database in ("wh_stop", "wh_stop2", "st_stop"):
        assert all(spark.table(f"{database}.`{t}`").isEmpty() for t in FULL)
        spark.sql(f"DROP DATABASE {database} CASCADE")


def travel_sources(spark, tmp_path, airports):
    (tmp_path / "labels.sas").write_text("header\n  582 =  'MEXICO'\n  689 =  'BRAZIL'\n")
    (tmp_path / "airports.csv").write_text("h," * 11 + "h\n" + airports)
    (tmp_path / "demographics.csv").write_text("h;" * 11 + "h\nQuincy;MA;41.0;1;2;3;4;5;2.39;MA;White;5\n")
    spark.range(6).select(*[
        (F.col("id") if f.name == "cicid" else F.lit(2016 if f.name == "i94yr" else 4)).cast(f.dataType).alias(f.name)
        for f in IMMIGRATION_SOURCE
    ]).write.mode("overwrite").parquet(str(tmp_path / "immigration"))
    block = LabelBlock("country_code", "country", 1, 3, COUNTRIES.code_trim, COUNTRIES.label_trim)
    return jobs.TravelSources(*[str(tmp_path / n) for n in ("labels.sas", "airports.csv", "demographics.csv", "immigration")], blocks=(block,))


AIRPORT = 'K1,heliport,A,1,NA,US,US-PA,X,K1,,,"1, 2"\n'


def test_travel_lake(spark, tmp_path):
    sources = travel_sources(spark, tmp_path, AIRPORT)
    for _ in range(2):
        paths = jobs.run_travel_lake(spark, sources, str(tmp_path / "lake"))
    assert counts(spark, paths) == {"countries": 2, "airports": 1, "demographic": 1, "immigration": 6}
    assert (tmp_path / "lake" / "immigration" / "year=2016" / "month=4").is_dir()
    assert (tmp_path / "lake" / "demographic" / "state=MA").is_dir()


def test_travel_lake_with_the_full_label_file(spark, tmp_path):
    sources = travel_sources(spark, tmp_path, AIRPORT)
    lines = ["/* comment */"] * 1100
    lines[10:298] = [f"  {i} =  'COUNTRY {i}'" for i in range(10, 298)]
    lines[303:962] = [f"   'C{i}'\t=\t'CITY {i}, AK      '" for i in range(303, 962)]
    lines[982:1036] = [f"\t'S{i}'='STATE {i}'" for i in range(982, 1036)]
    (tmp_path / "labels.sas").write_text("\n".join(lines) + "\n")
    paths = jobs.run_travel_lake(spark, replace(sources, blocks=jobs.TravelSources.blocks), str(tmp_path / "lake"))
    found = counts(spark, paths)
    assert (found["countries"], found["cities"], found["states"]) == (288, 659, 54)
    assert spark.read.parquet(paths["countries"]).filter("country_code = 297").first()["country"] == "COUNTRY 297"
    assert spark.read.parquet(paths["cities"]).filter("city_code = 'C303'").first()["city"] == "CITY 303, AK      "
    assert spark.read.parquet(paths["states"]).filter("state_code = 'S1035'").first()["state"] == "STATE 1035"


def test_travel_lake_stops_at_a_repeated_key(spark, tmp_path):
    sources = travel_sources(spark, tmp_path, AIRPORT + AIRPORT.replace("heliport", "closed"))
    with pytest.raises(QualityError, match="airport_id"):
        jobs.run_travel_lake(spark, sources, str(tmp_path / "lake"))
    assert not (tmp_path / "lake" / "airports").exists()


def test_jobs_run_together_and_report_errors(spark):
    done = []
    jobs.run_together(spark, [lambda i=i: done.append(spark.range(i).count()) for i in range(1, 5)])
    assert sorted(done) == [1, 2, 3, 4]

    def fail():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        jobs.run_together(spark, [fail])
    assert rows(spark.range(1)) == [(0,)]


def test_command_line(spark, source, tmp_path):
    target = str(tmp_path / "lake")
    paths = run(spark, ["music-lake", str(source), target])
    assert counts(spark, paths) == FULL
    assert run(spark, ["music-lake", str(source), target, "--month", "2018-12"]) == paths
    assert counts(spark, paths) == FULL
    report = run(spark, [
        "music-warehouse", "cli_wh", f"{source}/log_data/{{run.year}}/{{run.month}}", f"{source}/song_data",
        "--run", "2018-11-30", "--location", str(tmp_path / "wh")])
    assert report.count() == 5
    run(spark, ["music-store", "cli_st", f"{source}/song_data", f"{source}/log_data", "--plays-key", "start_time,user_id", "--location", str(tmp_path / "st")])
    assert spark.table("cli_st.songplays").count() == 6
    for database in ("cli_wh", "cli_st"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    with pytest.raises(SystemExit):
        run(spark, ["unknown"])
