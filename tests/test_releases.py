"""Loads that take effect together, rewrite parts, and count what a table does not allow while they write."""

import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from fixtures import EVENTS, SONGS
from pyspark.sql import functions as F
from test_jobs import FULL, write_json

from starloom.operators import loads, quality
from starloom.operators.conflicts import upsert_columns
from starloom.operators.quality import QualityError
from starloom.operators.releases import Layout, Load, Releases
from starloom.plans import jobs, query_tables
from starloom.schemas import LONG, STAGING_EVENTS, STAGING_SONGS, STRING, table
from starloom.sources import catalogue, staging
from starloom.sources.catalogue import stage_changed

PAIRS = table(key=LONG, value=STRING)


@pytest.fixture
def database(spark, tmp_path):
    name = f"rel_{abs(hash(str(tmp_path)))}"
    yield name, str(tmp_path / "db")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def pairs(spark, *data):
    return spark.createDataFrame(list(data), PAIRS)


def test_tables_change_together(spark, database):
    releases = Releases(spark, database[0], {"a": PAIRS, "b": PAIRS}, location=database[1])
    assert releases.table("a").isEmpty() and releases.table("a").schema == PAIRS
    with releases.load() as load:
        load.write("a", pairs(spark, (1, "x")))
        load.write("b", pairs(spark, (1, "y")))
        assert rows(load.rows("a")) == [(1, "x")] and releases.table("a").isEmpty() and releases.table("b").isEmpty()
        load.publish()
    with releases.load() as load:
        load.write("a", pairs(spark, (2, "x")))
        load.write("b", pairs(spark, (2, "y")), keep=False)
        assert rows(releases.table("a")) == [(1, "x")] and rows(releases.table("b")) == [(1, "y")]
        load.publish()
    assert rows(releases.table("a")) == [(1, "x"), (2, "x")] and rows(releases.table("b")) == [(2, "y")]
    with releases.load() as load:  # a table replaced by no rows, the other not touched
        load.write("b", pairs(spark), keep=False)
        load.publish()
    again = Releases(spark, database[0], {"a": PAIRS, "b": PAIRS}, location=database[1])
    assert rows(again.table("a")) == [(1, "x"), (2, "x")] and again.table("b").isEmpty()
    with pytest.raises(ValueError):
        with releases.load() as load:
            load.write("a", pairs(spark).select("key"))
    with pytest.raises(ValueError):
        Releases(spark, "no name", {})


def test_broken_loads_leave_nothing_behind(spark, database):
    releases = Releases(spark, database[0], {"a": PAIRS}, location=database[1])
    with releases.load() as load:
        load.write("a", pairs(spark, (1, "x")))
        load.publish()
    with pytest.raises(RuntimeError):
        with releases.load() as load:
            load.write("a", pairs(spark, (2, "lost")))
            raise RuntimeError
    assert rows(releases.table("a")) == [(1, "x")]
    with releases.load() as load:
        load.write("a", pairs(spark, (3, "y")))
        load.publish()
    assert rows(releases.table("a")) == [(1, "x"), (3, "y")]


def folders(place):
    return {str(p.relative_to(place)) for p in Path(place).glob("*_loads/**/load=*")}


def test_folders_are_removed_a_load_after_they_stopped_to_count(spark, database):
    releases = Releases(spark, database[0], {"a": PAIRS}, location=database[1])
    for i in (1, 2, 3):
        with releases.load() as load:
            load.write("a", pairs(spark, (i, "x")), keep=False)
            load.publish()
    # load 3 found load 1 as what counted before load 2, so a query begun then could still run
    assert folders(database[1]) == {f"a_loads/load={i}" for i in (1, 2, 3)}
    with releases.load():
        pass
    assert folders(database[1]) == {"a_loads/load=2", "a_loads/load=3"}


def test_parts_are_rewritten_alone(spark, database):
    layout = {"users": Layout(part_by=("key",), parts=16)}
    releases = Releases(spark, database[0], {"users": PAIRS}, layout, database[1])

    def upsert(new):
        with releases.load() as load:
            parts = releases.touched("users", new)
            stored = releases.rows_of_parts("users", parts)
            load.write("users", upsert_columns(new.withColumn("at", F.lit(load.number)), stored, ["key"], ["at"], ["value"]), parts=parts)
            load.publish()
        return load, parts

    _, parts = upsert(spark.range(400).selectExpr("id as key", "'old' as value"))
    assert parts == list(range(16)) and releases.table("users").count() == 400
    load, parts = upsert(pairs(spark, (3, "new"), (7, "new"), (1000, "new")))
    assert 1 <= len(parts) <= 3 and load.seen["users"]["rows"] < 400 * 3 / 16 * 2
    assert len([f for f in folders(database[1]) if f.endswith("load=2")]) == len(parts)
    found = dict(rows(releases.table("users")))
    assert len(found) == 401 and {k for k, v in found.items() if v == "new"} == {3, 7, 1000}
    plan = releases.rows_of_parts("users", parts)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan.split("PartitionFilters: [")[1]
    with pytest.raises(ValueError):
        with releases.load() as load:
            load.write("users", pairs(spark, (1, "x")))
    fewer = Releases(spark, database[0], {"users": PAIRS}, {"users": Layout(part_by=("key",), parts=4)}, database[1])
    assert fewer.layouts["users"].parts == 16  # as the table was created


def test_rules_are_counted_in_the_write(spark, database):
    releases = Releases(spark, database[0], {"a": PAIRS}, location=database[1])
    evaluated = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            evaluated.add(len(batch))
            yield batch

    source = pairs(spark, (1, "x"), (None, "long"), (2, None)).repartition(2).mapInPandas(look, PAIRS)
    with releases.load() as load:
        load.write("a", source, rules={"not_null": ["key", "value"], "lengths": {"value": 3}})
        assert load.seen["a"] == {"rows": 3, "not null key": 1, "not null value": 1, "length value": 1}
        with pytest.raises(QualityError, match="not null key: 1 rows"):
            load.enforce()
    assert evaluated.value == 3  # the source was computed once


def test_bucketed_tables_join_without_a_shuffle(spark, database, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    by_key = Layout(bucket_by=("key",), buckets=4, sort_by=("key",))
    releases = Releases(spark, database[0], {"a": PAIRS, "b": PAIRS}, {"a": by_key, "b": by_key}, database[1])
    for _ in range(2):
        with releases.load() as load:
            for t in ("a", "b"):
                load.write(t, spark.range(300).selectExpr("id % 50 as key", "'x' as value"))
            load.publish()
    joined = releases.table("a").join(releases.table("b"), "key")
    assert joined.count() == 50 * 12 * 12
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


# --- whole loads that break off -------------------------------------------------------------
@pytest.fixture
def source(tmp_path):
    for i, row in enumerate(SONGS):
        write_json(tmp_path / "song_data" / str(i) / "s.json", STAGING_SONGS, [row])
    write_json(tmp_path / "log_data" / "2018" / "11" / "e.json", STAGING_EVENTS, EVENTS[:5])
    write_json(tmp_path / "log_data" / "2018" / "12" / "e.json", STAGING_EVENTS, EVENTS[5:])
    return tmp_path


def contents(spark, database):
    return {t: rows(spark.table(f"{database}.`{t}`")) for t in FULL}


@pytest.mark.parametrize("kind", ["warehouse", "store"])
def test_a_load_broken_off_at_any_step_changes_nothing(spark, source, tmp_path, database, monkeypatch, kind):
    def run(month):
        if kind == "store":
            jobs.run_music_store(spark, jobs.StoreConfig(
                database[0], f"{source}/song_data", f"{source}/log_data/2018/{month}", ("start_time", "user_id"), location=database[1]))
        else:
            jobs.run_music_warehouse(spark, jobs.WarehouseConfig(
                database[0], f"{source}/log_data/{{run.year}}/{{run.month}}", f"{source}/song_data", location=database[1]), datetime(2018, month, 28))

    run(11)
    before = contents(spark, database[0])
    write, publish, steps = Load.write, Load.publish, []
    monkeypatch.setattr(Load, "write", lambda self, name, *a, **k: (steps.append(name), write(self, name, *a, **k))[1])
    run(11)  # adds nothing new
    names = [*dict.fromkeys(steps)]
    assert set(FULL) <= set(names)
    kept = contents(spark, database[0])
    assert kept == before

    def breaks(at, early):
        def broken(self, name, *a, **k):
            if name == at and early:
                raise RuntimeError(at)
            write(self, name, *a, **k)
            if name == at:
                raise RuntimeError(at)
        return broken

    for i, name in enumerate(names):
        monkeypatch.setattr(Load, "write", breaks(name, early=i % 2 == 0))
        with pytest.raises(RuntimeError, match=name):
            run(12)
        assert contents(spark, database[0]) == before
    monkeypatch.setattr(Load, "write", write)
    monkeypatch.setattr(Load, "publish", lambda self: (_ for _ in ()).throw(RuntimeError("publish")))
    with pytest.raises(RuntimeError, match="publish"):
        run(12)
    assert contents(spark, database[0]) == before
    monkeypatch.setattr(Load, "publish", publish)
    run(12)
    after = contents(spark, database[0])
    assert all(len(after[t]) >= 1 for t in FULL) and after["songplays"] != before["songplays"]


def test_time_grows_by_the_batch_and_is_derived_anew_when_it_has_to_be(spark, source, database):
    config = jobs.WarehouseConfig(
        database[0], f"{source}/log_data/{{run.year}}/{{run.month}}", f"{source}/song_data", location=database[1])
    releases = Releases(spark, database[0], jobs.schemas.WAREHOUSE, location=database[1])

    def times(**options):
        jobs.run_music_warehouse(spark, replace(config, **options), datetime(2018, 12, 28))
        stored = rows(spark.table(f"{database[0]}.`time`").select("start_time"))
        return stored, releases.visible("time")

    jobs.run_music_warehouse(spark, config, datetime(2018, 11, 28))
    assert releases.visible("time").first == 1
    stored, seen = times()
    plays = rows(spark.table(f"{database[0]}.songplays").select("start_time"))
    assert stored == plays and (seen.first, seen.last) == (1, 2)  # grown
    stored, seen = times(incremental_time=False)
    assert stored == plays and seen.first == 3  # derived anew
    stored, seen = times(dimension_mode="append-only")
    assert len(stored) == 2 * len(plays) and not seen.note  # all plays' times once more, as asked for
    stored, seen = times()
    assert stored == plays and seen.first == 5  # the table did not stand for the stored plays


def test_loaded_warehouse_joins_songs_without_a_shuffle(spark, source, database, conf):
    jobs.run_music_warehouse(spark, jobs.WarehouseConfig(
        database[0], f"{source}/log_data", f"{source}/song_data", location=database[1], buckets=4), datetime(2018, 11, 28))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    joined = spark.sql(f"SELECT p.start_time, s.title FROM {database[0]}.songplays p JOIN {database[0]}.songs s ON p.song_id = s.song_id")
    assert joined.count() == 7
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


# --- rejects --------------------------------------------------------------------------------
ORDER = table(id=LONG, price=jobs.schemas.NUMERIC, file=STRING, line=STRING)
LINES = [
    '{"id": 1, "price": 1.5, "file": "f", "line": "l"}', '{"id": "2", "price": "", "extra": 1}', "", "  ", '{"id": "two", "price": 3, "line": "x"}',
    '{"id": 4, "price": "high"}', '{"id": "five", "price": "low"}', '{"id": 6, "price"', "[1, 2]", '[{"id": 7}]', "plain", '{"id": 8.5}', "{}",
    '{"id": null, "price": null}',
]


def test_rejects_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("\n".join(LINES) + "\n")
    staged = staging.stage_json(spark, str(tmp_path), ORDER, max_rejects=None)
    assert sorted((r["id"] or 0, str(r["price"]), r["file"], r["line"]) for r in staged.rows.collect()) == [
        (0, "None", None, None), (0, "None", None, None), (1, "1.50000", "f", "l"), (2, "None", None, None)]
    assert staged.rejected == {"line": 4, "id": 3, "price": 2, "file": 0} and (staged.row_count, staged.reject_count) == (4, 8)
    bad = {r["line"]: (r["columns"], r["file"].rsplit("/", 1)[1]) for r in staged.rejects.collect()}
    assert bad['{"id": "five", "price": "low"}'] == (["id", "price"], "x.json") and bad["plain"] == (["line"], "x.json") and len(bad) == 8
    assert staged.within(8) is staged
    with pytest.raises(QualityError, match="8 rejected lines, 7 allowed"):
        staging.stage_json(spark, str(tmp_path), ORDER, max_rejects=7)
    by_path = staging.stage_json(spark, str(tmp_path), table(a=STRING, b=LONG), None, json_paths=["$['line']", "$.id"])
    assert by_path.rejected == {"line": 4, "a": 0, "b": 3}
    with pytest.raises(ValueError):
        staging.stage_json(spark, str(tmp_path), ORDER, json_paths=["$.id"])
    empty = staging.stage_json(spark, str(tmp_path), table(a=STRING), None)
    assert empty.row_count == 8


def test_lake_sets_rejects_aside_within_its_budget(spark, source, tmp_path):
    log = source / "log_data" / "2018" / "12" / "e.json"
    wrong = json.loads(log.read_text().splitlines()[0]) | {"ts": "yesterday"}
    log.write_text(log.read_text() + json.dumps(wrong) + "\nnonsense\n")
    fine = json.loads((source / "song_data" / "0" / "s.json").read_text()) | {"duration": 200.123456789, "artist_latitude": 40.123456789}
    (source / "song_data" / "0" / "s.json").write_text(json.dumps(fine) + "\n")
    target = str(tmp_path / "lake")
    with pytest.raises(QualityError, match="ts: 1"):
        jobs.run_music_lake(spark, str(source), target)
    assert not Path(target, "songplays").exists() and not Path(target, "songs").exists()
    paths = jobs.run_music_lake(spark, str(source), target, max_rejects=2)
    assert spark.read.parquet(paths["songplays"]).filter("start_time is null").isEmpty()
    assert sorted(r["columns"] for r in spark.read.parquet(f"{target}/rejects/events").collect()) == [["line"], ["ts"]]
    assert not Path(target, "rejects", "songs").exists()
    kept = spark.read.parquet(paths["songs"]).filter("song_id = 'S1'").first()
    assert kept["duration"] == 200.123456789  # as it stands in the file
    with pytest.raises(QualityError):
        jobs.refresh_music_lake(spark, str(source), target, datetime(2018, 12, 31))
    jobs.refresh_music_lake(spark, str(source), target, datetime(2018, 12, 31), max_rejects=None)


def test_row_counters_name_what_they_count(spark):
    found = pairs(spark, (1, "abc"), (None, "a")).agg(*[c.alias(n) for n, c in quality.row_counters(
        {"not_null": ["key"], "lengths": {"value": 2}, "primary_key": ["key"]}).items()]).first().asDict()
    assert found == {"not null key": 1, "length value": 1}


# --- statistics, lookups, and sources that are parsed once ----------------------------------
def test_statistics_of_all_loads_are_merged(spark, database):
    schema = table(key=LONG, value=STRING, at=jobs.schemas.TIMESTAMP)
    releases = Releases(spark, database[0], {"a": schema}, {"a": Layout(statistics=("key", "value", "at"))}, database[1])

    def loaded(low, high, keep=True):
        with releases.load() as load:
            load.write("a", spark.range(low, high).selectExpr(
                "id", "if(id % 4 = 0, null, concat('v', id % 100))", "timestamp_ntz '2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)"), keep)
            load.publish()
        return {r["column_name"]: r for r in releases.statistics("a").collect()}

    loaded(0, 5_000)
    found = loaded(4_000, 10_000)
    key, value, at = found["key"], found["value"], found["at"]
    assert (key["row_count"], key["null_count"], key["low"], key["high"]) == (11_000, 0, 0.0, 9_999.0)
    assert abs(key["distinct_values"] - 10_000) < 300 and abs(key["quantiles"][1] - 4_750) < 220
    assert (value["null_count"], value["distinct_values"], value["quantiles"]) == (2_750, 75, None)
    assert at["high"] - at["low"] == 9_999
    assert loaded(0, 10, keep=False)["key"]["row_count"] == 10  # replaced rows count no more
    empty = loaded(0, 0, keep=False)["key"]
    assert (empty["row_count"], empty["low"], empty["distinct_values"]) == (0, None, 0)
    with pytest.raises(ValueError):
        Releases(spark, database[0], {"b": PAIRS}, {"b": Layout(part_by=("key",))}, database[1]).statistics("b")


def rows_read(df):
    """Rows that the scan of a lookup has handed on, after row groups were skipped."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().get("numOutputRows").get().value()


def test_lookups_skip_row_groups_by_bloom_filter(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    try:
        plays = spark.range(0, 200_000, 1, 1).selectExpr(
            "cast(id % 997 as string) as song", "(id * 7919) % 200000 as userId", "'a' as firstName", "'b' as lastName").coalesce(1)
        loads.write_parquet(plays, str(tmp_path / "plain"))
        loads.write_parquet(plays, str(tmp_path / "filtered"), lookup=["userId"])
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    lookup = lambda name: spark.read.parquet(str(tmp_path / name)).filter("userId = 4711").select("song")
    assert rows(lookup("filtered")) == rows(lookup("plain")) and len(rows(lookup("plain"))) == 1
    assert rows_read(lookup("filtered")) < rows_read(lookup("plain")) / 5


def test_query_tables_are_written_in_their_layout(spark, tmp_path):
    listeners = spark.range(3_000).selectExpr("cast(id % 7 as string) as song", "id as userId", "'a' as firstName", "'b' as lastName")
    query_tables.write(listeners, "listeners_by_song", str(tmp_path / "t"))
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(listeners)


def test_song_files_are_parsed_once_per_change(spark, source, tmp_path, monkeypatch):
    parsed, stage = [], staging.stage_json
    monkeypatch.setattr(staging, "stage_json", lambda spark, path, *a, **k: (parsed.append(path), stage(spark, path, *a, **k))[1])
    songs, kept, schema = source / "song_data", str(tmp_path / "kept"), jobs.schemas.LAKE_SONGS

    def titles(**options):
        parsed.clear()
        found, _ = stage_changed(spark, str(songs), kept, schema, **options)
        return sorted(r["title"] for r in found.collect())

    every = sorted(dict(zip(STAGING_SONGS.fieldNames(), s))["title"] for s in SONGS)
    assert titles() == every and parsed == [str(songs)]
    assert titles() == every and parsed == []
    assert titles(anew=True) == every and parsed == [str(songs)]
    extra = dict(zip(STAGING_SONGS.fieldNames(), SONGS[0])) | {"title": "Added"}
    write_json(songs / "9" / "s.json", STAGING_SONGS, [tuple(extra.values())])
    assert titles() == sorted([*every, "Added"]) and [len(p) for p in parsed] == [1] and parsed[0][0].endswith("9/s.json")
    write_json(songs / "9" / "s.json", STAGING_SONGS, [tuple((extra | {"title": "Changed it"}).values())])
    assert titles() == sorted([*every, "Changed it"]) and [len(p) for p in parsed] == [1]
    (songs / "9" / "s.json").unlink()
    assert titles() == every and parsed == []
    monkeypatch.setattr(catalogue, "LISTED", 0)
    write_json(songs / "8" / "s.json", STAGING_SONGS, [tuple(extra.values())])
    assert titles() == sorted([*every, "Added"]) and parsed == [str(songs)]
    (songs / "8" / "s.json").write_text("broken\n")
    with pytest.raises(QualityError):
        titles()
    assert sorted(Path(kept).glob("version-*"))[-1].joinpath("files").exists()  # what was kept is still there
    assert titles(max_rejects=1) == every
