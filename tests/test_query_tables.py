import pytest
from conftest import rows
from fixtures import SUNDAY, event
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import loads
from starloom.plans import query_tables, reports
from starloom.schemas import STAGING_EVENTS
from starloom.sources.files import read_csv

EVENTS = [
    event(SUNDAY + 1, 10, 182, 1, "Band", "First, of two", 10.5),
    event(SUNDAY + 2, 10, 182, 0, "Duo", "Line\nbreak", 20.0),
    event(SUNDAY + 3, 10, 182, 1, "Solo", "Rewritten", 30.25),
    event(SUNDAY + 4, 11, 338, 4, "Faithless", "Music Matters", 495.3073, first="Bo"),
    event(SUNDAY + 5, 11, 338, 5, "", "No artist", 1.0, first="Bo"),
    event(SUNDAY + 6, 11, 339, 0, None, "No artist", 1.0, first="Bo"),
    event(SUNDAY + 7, 12, 340, 0, "Band", "Music Matters", 2.0, first="Cy"),
    event(SUNDAY + 8, 11, 341, 0, "Band", "Music Matters", 2.0, first="Changed"),
]


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    """Events written as CSV, read by position, cleaned, written quoted and read again."""
    path = tmp_path_factory.mktemp("events")
    events = spark.createDataFrame(EVENTS, STAGING_EVENTS).select(*schemas.EVENT_CSV.fieldNames())
    events.write.csv(f"{path}/raw", header=True, escape='"')
    raw = read_csv(spark, f"{path}/raw", schemas.EVENT_CSV, multiline=True)
    loads.write_csv(query_tables.clean_events(raw, keep=["ts"]), f"{path}/clean")
    kept = schemas.table(**{c: schemas.STRING for c in (*schemas.CLEAN_EVENTS, "ts")})
    return read_csv(spark, f"{path}/clean", kept, multiline=True).withColumn("ts", F.col("ts").cast("long"))


def test_clean_events(clean):
    assert clean.count() == 6
    assert clean.columns == [*schemas.CLEAN_EVENTS, "ts"]
    assert clean.filter(F.col("song") == "Line\nbreak").count() == 1


def test_song_at(clean):
    table = query_tables.plays_by_session(clean, ["ts"])
    found = reports.song_at(table, 338, 4).collect()
    assert [(r["artist"], r["song"], float(r["length"])) for r in found] == [("Faithless", "Music Matters", 495.3073)]
    assert table.schema == schemas.PLAYS_BY_SESSION


def test_last_write_wins_and_history_is_in_order(clean):
    table = query_tables.plays_by_user(clean, ["ts"])
    history = [tuple(r) for r in reports.session_history(table, 10, 182).collect()]
    assert history == [("Duo", "Line\nbreak", "Ann", "Lee"), ("Solo", "Rewritten", "Ann", "Lee")]


def test_first_write_wins_for_listeners(clean):
    table = query_tables.listeners_by_song(clean, ["ts"])
    assert [r["firstName"] for r in reports.listeners_of(table, "Music Matters").collect()] == ["Bo", "Cy"]


def test_layout_keeps_keys_together_and_splits_hot_ones(spark, conf, tmp_path):
    conf(spark__sql__adaptive__enabled="false")
    df = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("song"),
        F.col("id").alias("userId"), F.lit("a").alias("firstName"), F.lit("b").alias("lastName"))
    placed = query_tables.laid_out(df, "listeners_by_song").select("*", F.spark_partition_id().alias("p"))
    hot = placed.filter("song = 'hot'").groupBy("p").count().collect()
    assert len(hot) > 1 and sum(r["count"] for r in hot) == 2000
    query_tables.laid_out(df, "listeners_by_song").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert "PushedFilters: [IsNotNull(song), EqualTo(song,s7)]" in reports.listeners_of(stored, "s7")._jdf.queryExecution().executedPlan().toString()
