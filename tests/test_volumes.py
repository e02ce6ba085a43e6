"""What is shuffled and written grows with what is needed of the rows."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from fixtures import EVENTS, SONGS
from pyspark.sql import functions as F

from harness import files as harness_files
from harness.tables import play_log
from starloom.operators import conflicts
from starloom.operators.releases import Layout, Releases
from starloom.plans import music
from starloom.schemas import LONG, STAGING_EVENTS, STAGING_SONGS, STRING, table
from starloom.session import materialize, scratch_dir
from starloom.sources import files

LINES = 600


@pytest.fixture
def tables(spark, tmp_path):
    """A few order lines of parts, orders and customers."""
    key = F.col("id")
    day = F.expr("timestamp_ntz'1997-01-31' + make_dt_interval(cast(id % 90 as int))")
    frames = {
        "part": spark.range(40).select(
            key.alias("p_partkey"), F.concat(F.lit("part "), key).alias("p_name"), F.concat(F.lit("Brand#1"), key % 3).alias("p_brand"),
            F.lit("TYPE").alias("p_type"), (key % 7).cast("int").alias("p_size"), (key + 900.5).alias("p_retailprice")),
        "customer": spark.range(20).select(
            key.alias("c_custkey"), F.concat(F.lit("Customer#00000"), key).alias("c_name"), F.lit(1).alias("c_nationkey"),
            F.lit(1.0).alias("c_acctbal"), F.lit("MACHINERY").alias("c_mktsegment")),
        "orders": spark.range(LINES // 4).select(
            key.alias("o_orderkey"), (key % 20).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
            day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(LINES).select(
            F.expr("id div 4").alias("l_orderkey"), (key * 7 % 40).alias("l_partkey"), (key % 4).cast("int").alias("l_linenumber"),
            F.lit(0.0).alias("l_discount"), F.when(key % 3 == 0, "R").otherwise("N").alias("l_returnflag"),
            F.lit("O").alias("l_linestatus"), day.alias("l_shipdate")),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def stored(folder, pattern):
    found = [p for p in Path(folder).rglob(pattern) if not p.name.startswith((".", "_"))]
    return found, sum(p.stat().st_size for p in found)


def test_clean_events_are_stored_compressed(spark, tables):
    before = {*Path(scratch_dir(spark)).glob("events-*")}
    assert harness_files.clean_events_csv(spark, tables).count() == LINES - LINES // 3
    new = {*Path(scratch_dir(spark)).glob("events-*")} - before
    assert sum(stored(f, "*.csv*")[1] for f in new) < 60 * LINES  # 209 bytes a line as plain text


def test_lines_shuffle_before_they_have_the_texts_of_order_and_customer(spark, conf, tables):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = play_log(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    joins = [(len(line) - len(line.lstrip(" :+-")), line) for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0][1]  # the last join of the lines: customers have met the orders by then
    assert any("o_custkey" in line and "c_custkey" in line and depth > joins[0][0] for depth, line in joins)


def test_music_sources_are_compressed_and_read_whole(spark, tables):
    source = harness_files._write_music_sources(spark, tables)
    found, size = stored(f"{source}/log_data", "*.json*")
    assert size < 150 * LINES and {p.parent.name for p in found} <= {f"m={m}" for m in range(1, 13)}  # 340 as plain text
    assert files.read_json(spark, f"{source}/log_data", table(sessionId=LONG)).count() == LINES
    assert files.read_json(spark, f"{source}/song_data", table(song_id=STRING)).count() == 40


@pytest.mark.parametrize("limit", ["10m", "-1"])  # repeated hashes are replicated; too many for that
def test_distinct_rows(spark, conf, limit):
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    data = [(1, "a", 0.0), (1, "a", -0.0), (2, None, None), (2, None, None), (3, "c", float("nan")), (3, "c", float("nan")), (4, "d", 1.0), (5, None, 2.0)]
    df = materialize(spark.createDataFrame(data, "k long, t string, x double"), "rows")
    found = conflicts.distinct_rows(df)
    assert repr(rows(found)) == repr(rows(df.distinct())) and found.count() == 5 and found.columns == df.columns
    assert conflicts.distinct_rows(df.filter("k > 5")).count() == 0


def test_distinct_rows_shuffles_no_row_that_comes_once(spark):
    df = materialize(spark.range(2000).withColumn("t", F.lit("x" * 50)), "rows")
    plan = conflicts.distinct_rows(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan.split("Aggregate")[0]  # one side passes without being grouped


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_without_stored(spark, conf, limit):
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e"), (3, "f")], "k long, v string")
    old = spark.createDataFrame([(1,), (None,), (9,)], "k long")
    assert rows(conflicts.without_stored(new, old, ["k"])) == rows(conflicts.without_known(new, old, ["k"])) == [(2, "c"), (3, "e"), (3, "f")]
    assert rows(conflicts.without_stored(new, old.filter("k > 99"), ["k"])) == rows(new)


@pytest.mark.parametrize("ids, key", [("hash", ("songplay_id",)), (None, ("start_time", "user_id", "session_id")), (None, ("start_time", "song_id"))])
def test_known_plays_are_left_out_as_after_the_join(spark, ids, key):
    events = spark.createDataFrame(EVENTS, STAGING_EVENTS)
    events = events.unionByName(events.limit(2).withColumn("sessionId", F.lit(None).cast(STAGING_EVENTS["sessionId"].dataType)))
    songs = spark.createDataFrame(SONGS, STAGING_SONGS)
    options = dict(ids=ids, precision="s", single_match=False)
    every = music.build_songplays(events, songs, **options)
    for known in (every.filter("session_id IS NULL OR session_id = 10"), every, every.limit(0)):
        known = materialize(known, "known")
        assert rows(music.build_songplays(events, songs, **options, known=known, known_by=key)) == rows(conflicts.append_new(every, known, key))
    if ids:  # an id that does not follow from the stored columns is known all the same
        other = materialize(every.withColumn("start_time", F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")), "known")
        assert music.build_songplays(events, songs, **options, known=other, known_by=key).count() == 0


def test_computed_columns_are_written_but_not_dealt_out(spark, tmp_path):
    schema = table(id=STRING, k=LONG, v=STRING)
    releases = Releases(spark, "computed_test", {"t": schema}, {"t": Layout(bucket_by=("k",), buckets=2, sort_by=("k",))}, str(tmp_path / "db"))
    df = spark.range(50).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").alias("k"), F.lit("v").alias("v"))
    with releases.load() as load:
        load.write("t", df, computed={"id": F.md5(F.col("k").cast("string"))}, rules={"not_null": ["id"], "lengths": {"id": 31}})
        assert load.violations("t") == {"not null id": 0, "length id": 50}  # rules see them
        load.publish()
    assert rows(releases.table("t")) == rows(df)
    spark.sql("DROP DATABASE computed_test CASCADE")


def test_uses_of_ids_are_counted_without_shuffling_plays(spark, tables):
    found = harness_files.music_lake_songplays(spark, tables)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() and {r[0] for r in found.select("rows_with_this_id").distinct().collect()} == {1}
