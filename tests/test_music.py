"""Each cell of the variant matrix: four loaders of one star schema, four results."""

from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from fixtures import SONGS, SUNDAY, YEAR_END, event, events_frame, song, songs_frame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.plans import music
from starloom.schemas import SCALE0, STAGING_EVENTS, STAGING_SONGS


@pytest.fixture(scope="module")
def events(spark):
    return events_frame(spark)


@pytest.fixture(scope="module")
def songs(spark):
    return songs_frame(spark)


@pytest.fixture(scope="module")
def stars(events, songs):
    return {v: music.build_star(events, songs, v) for v in music.VARIANTS}


def matches(star):
    return Counter((r["session_id"], r["song_id"]) for r in star["songplays"].collect())


def test_row_store_plays_match_at_most_once(stars):
    assert matches(stars["row_store"]) == Counter({(10, "S1"): 1, (10, "S3"): 1, (11, None): 2, (12, None): 2})


def test_warehouse_plays_fan_out_to_every_song_of_the_artist(stars, events, songs):
    found = matches(stars["warehouse"])
    assert found == Counter({
        (10, "S1"): 2, (10, "S2"): 2, (10, "S3"): 2, (11, "S4"): 2,
        (12, "S1"): 2, (12, "S2"): 2, (12, "S3"): 2})
    per_song = Counter()
    for (_, song_id), n in found.items():
        per_song[song_id] += n
    counted = music.artist_match_counts(events, songs).collect()
    assert {r["song_id"]: r["plays"] for r in counted} == per_song


def test_lake_plays_are_distinct_and_inner(stars):
    assert matches(stars["lake"]) == Counter({
        (10, "S1"): 1, (10, "S2"): 1, (10, "S3"): 1, (11, "S4"): 1, (12, "S1"): 1, (12, "S2"): 1})
    assert stars["lake"]["songplays"].columns[-2:] == ["year", "month"]
    assert rows(stars["lake"]["songplays"].select("year", "month").distinct()) == [(2018, 11), (2018, 12)]


def test_scheduled_plays_keep_every_event_and_compare_whole_seconds(stars):
    # 200.5 rounds to 201, and so does 200.9
    assert matches(stars["scheduled"]) == Counter({
        (10, "S1"): 1, (10, "S2"): 1, (10, "S3"): 1, (11, None): 2, (12, "S1"): 2, (12, "S2"): 2})


def test_ids(stars):
    dense = sorted(r["songplay_id"] for r in stars["row_store"]["songplays"].collect())
    assert dense == [1, 2, 3, 4, 5, 6]
    lake = [r["songplay_id"] for r in stars["lake"]["songplays"].collect()]
    assert len(lake) == len(set(lake)) == 6
    hashed = stars["scheduled"]["songplays"]
    # two plays in one second of a session, and fan-out rows, share the hash
    assert hashed.filter("session_id = 10").select("songplay_id").distinct().count() == 1
    assert {len(r["songplay_id"]) for r in hashed.collect()} == {32}


def test_hash_of_more_columns_tells_plays_apart(events, songs):
    plays = music.build_songplays(events, songs, ids="hash", precision="s", hash_parts=("session_id", "start_time", "song_id"))
    assert plays.filter("session_id = 10").select("songplay_id").distinct().count() == 2


def test_start_time_precision(stars):
    times = {v: {r["start_time"] for r in s["songplays"].filter("session_id = 10").collect()} for v, s in stars.items()}
    exact = {datetime(2018, 11, 4, 0, 0, 0, 500000), datetime(2018, 11, 4, 0, 0, 0, 900000)}
    assert times["row_store"] == times["lake"] == exact
    assert times["warehouse"] == times["scheduled"] == {datetime(2018, 11, 4)}


def test_users(stars):
    latest = [(1, "Ann", "Lee", "F", "paid"), (2, "Bob", "Lee", "F", "free"), (3, "Cy", "Lee", "F", "free")]
    assert rows(stars["row_store"]["users"]) == latest
    every = sorted(latest + [(1, "Ann", "Lee", "F", "free"), (2, "Rob", "Lee", "F", "free")], key=repr)
    for variant in ("warehouse", "lake", "scheduled"):
        assert rows(stars[variant]["users"]) == every


def test_users_merge_into_the_stored_table(spark, events, stars):
    later = spark.createDataFrame([event(YEAR_END + 1, 2, 50, 0, "Duo", "Tune", 1.0, level="paid", first="New")], STAGING_EVENTS)
    merged = music.build_users(later, existing=stars["row_store"]["users"])
    assert rows(merged, "user_id", "first_name", "level") == [(1, "Ann", "paid"), (2, "Bob", "paid"), (3, "Cy", "free")]
    assert rows(music.build_users(events, "first_seen"), "user_id", "level") == [(1, "free"), (2, "free"), (3, "free")]


def test_songs_and_artists(stars):
    assert {v: s["songs"].count() for v, s in stars.items()} == {"row_store": 4, "warehouse": 5, "lake": 5, "scheduled": 5}
    assert {v: s["artists"].count() for v, s in stars.items()} == {"row_store": 2, "warehouse": 3, "lake": 3, "scheduled": 3}


def test_repeated_songs(spark):
    twice = spark.createDataFrame([SONGS[0], SONGS[0]], STAGING_SONGS)
    assert {d: music.build_songs(twice, d).count() for d in ("none", "distinct", "keep_first")} == {"none": 2, "distinct": 1, "keep_first": 1}
    with pytest.raises(ValueError):
        music.build_songs(twice, "some")


def test_numeric_scale(stars):
    def durations(variant):
        return {str(r["duration"]) for r in stars[variant]["songs"].filter("song_id = 'S1'").collect()}

    assert durations("row_store") == {"200.50000"}
    assert durations("warehouse") == durations("scheduled") == {"201"}
    assert durations("lake") == {"200.5"}
    longitude = {r["longitude"] for r in stars["scheduled"]["artists"].collect()}
    assert longitude == {Decimal(-75), None}


def test_weekday_and_time_rows(stars):
    def sunday(variant):
        return {r["weekday"] for r in stars[variant]["time"].filter("day = 4").collect()}

    assert {v: sunday(v) for v in stars} == {"row_store": {6}, "warehouse": {44}, "lake": {1}, "scheduled": {0}}
    # distinct over filtered events, except the scheduled load: one row per songplay
    assert {v: s["time"].count() for v, s in stars.items()} == {"row_store": 4, "warehouse": 3, "lake": 4, "scheduled": 9}
    year_end = stars["row_store"]["time"].filter("day = 31").first()
    assert (year_end["week"], year_end["year"]) == (1, 2018)


def test_other_pages_are_ignored(stars):
    for star in stars.values():
        assert star["songplays"].filter(F.second("start_time") == 3).isEmpty()


def test_single_match_is_the_smallest_id(spark):
    catalogue = spark.createDataFrame([song("S9", "A1", "B", "T", 1.5), song("S2", "A2", "B", "T", 1.5), song("S5", "A0", "B", "T", 1.50)], STAGING_SONGS)
    plays = spark.createDataFrame([event(SUNDAY, 1, 1, 1, "B", "T", 1.5)], STAGING_EVENTS)
    assert rows(music.build_songplays(plays, catalogue), "song_id", "artist_id") == [("S2", "A2")]


def test_float_lengths_meet_decimal_durations(spark, songs):
    events = events_frame(spark).withColumn("length", F.col("length").cast("double"))
    assert music.build_songplays(events, songs, ids=None).filter("song_id = 'S1'").count() == 1


def test_bad_options(events, songs):
    with pytest.raises(ValueError):
        music.build_songplays(events, songs, ids="serial")
    with pytest.raises(ValueError):
        music.build_songplays(events, songs, distinct=True)
    with pytest.raises(ValueError):
        music.build_users(events, "all")


def test_results_do_not_depend_on_the_join_strategy(conf, events, songs):
    def plays():
        return rows(music.build_songplays(events, songs, single_match=False, ids=None))

    small = plays()
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert plays() == small


def test_warehouse_schemas():
    assert [str(f.dataType) for f in schemas.WAREHOUSE["songs"] if f.name == "duration"] == [str(SCALE0)]
    assert list(schemas.WAREHOUSE)[-1] == "songplays"
    assert schemas.USERS["user_id"].dataType == schemas.LONG
