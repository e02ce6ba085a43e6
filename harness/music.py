"""Star schema, query tables and reports on the play and activity logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harness.registry import query
from harness.tables import ACTIVITY_LOG, CATALOGUE, PLAY_LOG, activity_log, catalogue, play_log, read
from starloom.functions import calendar
from starloom.functions.keys import hash_key
from starloom.operators.conflicts import keep_first
from starloom.operators.quality import check_declared
from starloom.plans import music, query_tables, reports
from starloom.schemas import CONSTRAINTS, LISTENERS_BY_SONG, PLAYS_BY_SESSION, PLAYS_BY_USER, SCALE0
from starloom.session import scratch_path

# --- time dimension -------------------------------------------------------------------------
_CALENDAR_SQL = """WITH {log}, times AS (
  SELECT {distinct} make_timestamp({micros}) AS start_time FROM activity_log WHERE page = 'NextSong')
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, CAST({weekday} AS INTEGER) AS weekday
FROM times"""
_MS, _S = "ts * 1000", "(ts // 1000) * 1000000"


def _calendar_query(name: str, weekday: str, weekday_sql: str, precision: str, distinct: bool) -> None:
    sql = _CALENDAR_SQL.format(
        log=ACTIVITY_LOG, distinct="DISTINCT" if distinct else "",
        micros=_MS if precision == "ms" else _S, weekday=weekday_sql)

    @query(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        times = music.play_times(activity_log(spark, sf_dir), precision)
        return music.build_time(times, weekday, distinct)


_calendar_query("calendar_dim_mon0", "mon0", "isodow(start_time) - 1", "ms", True)
_calendar_query("calendar_dim_sun1", "sun1", "dayofweek(start_time) + 1", "ms", True)
_calendar_query("calendar_dim_sun0", "sun0", "dayofweek(start_time)", "s", False)
_calendar_query("calendar_dim_week", "week", "week(start_time)", "s", True)


@query("epoch_millis", f"WITH {ACTIVITY_LOG} SELECT itemInSession AS event_id, make_timestamp(ts * 1000) AS start_time FROM activity_log")
def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log(spark, sf_dir).select(
        F.col("itemInSession").alias("event_id"), calendar.from_epoch_millis(F.col("ts")).alias("start_time"))


@query("epoch_seconds", f"WITH {ACTIVITY_LOG} SELECT itemInSession AS event_id, make_timestamp((ts // 1000) * 1000000) AS start_time FROM activity_log")
def epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log(spark, sf_dir).select(
        F.col("itemInSession").alias("event_id"),
        calendar.from_epoch_seconds(F.col("ts").cast("string")).alias("start_time"))


@query("hash_key", f"""WITH {ACTIVITY_LOG}
SELECT itemInSession AS event_id,
       md5(CAST(sessionId AS VARCHAR) || CAST(make_timestamp((ts // 1000) * 1000000) AS VARCHAR)) AS songplay_id
FROM activity_log""")
def hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_log(spark, sf_dir).select(
        F.col("itemInSession").alias("event_id"),
        hash_key(F.col("sessionId"), calendar.from_epoch_seconds(F.col("ts"))).alias("songplay_id"))


@query("alias_in_select", """SELECT event_id, ts AS start_time, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute_of_day FROM events""")
def alias_in_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "events").createOrReplaceTempView("activity_rows")
    return spark.sql("""
        SELECT event_id, ts AS start_time, hour(start_time) AS hour,
               hour * 60 + minute(start_time) AS minute_of_day
        FROM activity_rows""")


# --- users, songs, artists ------------------------------------------------------------------
_USER_ORDER = ("ts", "itemInSession")


@query("users_distinct", f"""WITH {ACTIVITY_LOG}
SELECT DISTINCT userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
FROM activity_log WHERE page = 'NextSong'""")
def users_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_users(activity_log(spark, sf_dir), "distinct")


_FIRST_USER = f"""{ACTIVITY_LOG}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts, itemInSession) AS first_rank,
         row_number() OVER (PARTITION BY userId ORDER BY ts DESC, itemInSession DESC) AS last_rank
  FROM activity_log WHERE page = 'NextSong')"""


@query("users_first_seen", f"""WITH {_FIRST_USER}
SELECT userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
FROM ranked WHERE first_rank = 1""")
def users_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_users(activity_log(spark, sf_dir), "first_seen", _USER_ORDER)


@query("users_latest_level", f"""WITH {_FIRST_USER}
SELECT f.userId AS user_id, f.firstName AS first_name, f.lastName AS last_name, f.gender, l.level
FROM ranked f JOIN ranked l ON f.userId = l.userId WHERE f.first_rank = 1 AND l.last_rank = 1""")
def users_latest_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_users(activity_log(spark, sf_dir), "latest_level", _USER_ORDER)


def _song_columns(songs: DataFrame) -> DataFrame:
    return songs.withColumn("duration", F.col("duration").cast("double"))


def _artist_columns(artists: DataFrame) -> DataFrame:
    return artists.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@query("songs_all", f"""WITH {CATALOGUE}
SELECT shared_id AS song_id, title, artist_id, year, CAST(duration AS DOUBLE) AS duration FROM catalogue""")
def songs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _song_columns(music.build_songs(catalogue(spark, sf_dir, shared_ids=True), "none"))


@query("songs_distinct", f"""WITH {CATALOGUE}
SELECT DISTINCT shared_id AS song_id, title, artist_id, year, CAST(duration AS DOUBLE) AS duration FROM catalogue""")
def songs_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _song_columns(music.build_songs(catalogue(spark, sf_dir, shared_ids=True), "distinct"))


@query("songs_keep_first", f"""WITH {CATALOGUE}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY shared_id ORDER BY year, title, artist_id, duration) AS n FROM catalogue)
SELECT shared_id AS song_id, title, artist_id, year, CAST(duration AS DOUBLE) AS duration FROM ranked WHERE n = 1""")
def songs_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = music.build_songs(catalogue(spark, sf_dir, shared_ids=True), "none")
    return _song_columns(keep_first(songs, ["song_id"], ["year"]))


@query("artists_distinct", f"""WITH {CATALOGUE}
SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
       CAST(artist_latitude AS DOUBLE) AS latitude, CAST(artist_longitude AS DOUBLE) AS longitude FROM catalogue""")
def artists_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _artist_columns(music.build_artists(catalogue(spark, sf_dir), "distinct"))


@query("artists_keep_first", f"""WITH {CATALOGUE}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id, artist_name, artist_location, artist_latitude, artist_longitude) AS n
  FROM catalogue)
SELECT artist_id, artist_name AS name, artist_location AS location,
       CAST(artist_latitude AS DOUBLE) AS latitude, CAST(artist_longitude AS DOUBLE) AS longitude
FROM ranked WHERE n = 1""")
def artists_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _artist_columns(music.build_artists(catalogue(spark, sf_dir), "keep_first", ["song_id"]))


# --- songplays ------------------------------------------------------------------------------
def _play_columns(micros: str, prefix: str = "p.") -> str:
    return f"""make_timestamp({micros}) AS start_time, {prefix}userId AS user_id, {prefix}level,
       c.song_id, c.artist_id, {prefix}sessionId AS session_id, {prefix}location, {prefix}userAgent AS user_agent"""


@query("plays_match_artist", f"""WITH {PLAY_LOG}, {CATALOGUE}, plays AS (
  SELECT artist, count(*) AS n FROM play_log WHERE page = 'NextSong' GROUP BY artist)
SELECT song_id, artist_id, CAST(n AS BIGINT) AS plays FROM catalogue JOIN plays ON artist = artist_name""")
def plays_match_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.artist_match_counts(play_log(spark, sf_dir), catalogue(spark, sf_dir))


@query("plays_title_artist", f"""WITH {PLAY_LOG}, {CATALOGUE}, plays AS (
  SELECT DISTINCT * FROM play_log WHERE page = 'NextSong'), songs AS (
  SELECT DISTINCT song_id, title, artist_id, artist_name FROM catalogue)
SELECT {_play_columns("p.ts * 1000")}, CAST(year(make_timestamp(p.ts * 1000)) AS INTEGER) AS year,
       CAST(month(make_timestamp(p.ts * 1000)) AS INTEGER) AS month
FROM plays p JOIN songs c ON p.song = c.title AND p.artist = c.artist_name""")
def plays_title_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_songplays(
        play_log(spark, sf_dir), catalogue(spark, sf_dir), match="title_artist", how="inner",
        single_match=False, ids=None, distinct=True, calendar=True)


_FULL_MATCH = "p.song = c.title AND p.artist = c.artist_name AND p.length = c.duration"


@query("plays_full_left", f"""WITH {PLAY_LOG}, {CATALOGUE}
SELECT {_play_columns("p.ts * 1000")}
FROM play_log p LEFT JOIN catalogue c ON {_FULL_MATCH} WHERE p.page = 'NextSong'""")
def plays_full_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_songplays(play_log(spark, sf_dir), catalogue(spark, sf_dir), single_match=False, ids=None)


_SINGLE = f"""{PLAY_LOG}, {CATALOGUE}, one AS (
  SELECT *, row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id, artist_id) AS n
  FROM catalogue), songplays AS (
  SELECT {_play_columns("p.ts * 1000")}
  FROM play_log p LEFT JOIN (SELECT * FROM one WHERE n = 1) c ON {_FULL_MATCH} WHERE p.page = 'NextSong')"""


def _single_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_songplays(play_log(spark, sf_dir), catalogue(spark, sf_dir), ids=None)


@query("plays_single", f"WITH {_SINGLE} SELECT * FROM songplays")
def plays_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _single_plays(spark, sf_dir)


@query("plays_numbered", f"""WITH {_SINGLE}
SELECT row_number() OVER (ORDER BY start_time, user_id, level, song_id NULLS FIRST, artist_id NULLS FIRST,
                          session_id, location, user_agent) AS songplay_id, * FROM songplays""")
def plays_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_songplays(play_log(spark, sf_dir), catalogue(spark, sf_dir), ids="dense")


@query("plays_hashed_scale0", f"""WITH {PLAY_LOG}, {CATALOGUE}, plays AS (
  SELECT *, CAST(length AS DECIMAL(18,0)) AS whole,
         make_timestamp((ts // 1000) * 1000000) AS start_time FROM play_log WHERE page = 'NextSong')
SELECT md5(CAST(p.sessionId AS VARCHAR) || CAST(p.start_time AS VARCHAR)) AS songplay_id,
       {_play_columns("(p.ts // 1000) * 1000000")}
FROM plays p LEFT JOIN catalogue c ON p.song = c.title AND p.artist = c.artist_name
     AND p.whole = CAST(c.duration AS DECIMAL(18,0))""")
def plays_hashed_scale0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_songplays(
        play_log(spark, sf_dir), catalogue(spark, sf_dir), single_match=False, ids="hash",
        precision="s", duration=SCALE0)


@query("dq_star", f"""WITH {PLAY_LOG}, {CATALOGUE}, plays AS (SELECT * FROM play_log WHERE page = 'NextSong'),
  users AS (SELECT DISTINCT userId, firstName, lastName, gender, level FROM plays),
  artists AS (SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude FROM catalogue),
  songs AS (SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalogue),
  times AS (SELECT DISTINCT make_timestamp(ts * 1000) AS start_time FROM plays)
SELECT 'users' AS table_name, 'primary key user_id' AS "constraint", count(*) - count(DISTINCT userId) AS violations FROM users
UNION ALL SELECT 'users', 'not null user_id', count(*) FILTER (userId IS NULL) FROM users
UNION ALL SELECT 'users', 'length gender', count(*) FILTER (length(gender) > 1) FROM users
UNION ALL SELECT 'songs', 'primary key song_id', count(*) - count(DISTINCT song_id) FROM songs
UNION ALL SELECT 'songs', 'not null song_id', count(*) FILTER (song_id IS NULL) FROM songs
UNION ALL SELECT 'songs', 'length title', count(*) FILTER (length(title) > 256) FROM songs
UNION ALL SELECT 'artists', 'primary key artist_id', count(*) - count(DISTINCT artist_id) FROM artists
UNION ALL SELECT 'artists', 'not null artist_id', count(*) FILTER (artist_id IS NULL) FROM artists
UNION ALL SELECT 'artists', 'length name', count(*) FILTER (length(artist_name) > 500) FROM artists
UNION ALL SELECT 'artists', 'length location', count(*) FILTER (length(artist_location) > 500) FROM artists
UNION ALL SELECT 'time', 'primary key start_time', count(*) - count(DISTINCT start_time) FROM times
UNION ALL SELECT 'time', 'not null start_time', count(*) FILTER (start_time IS NULL) FROM times""")
def dq_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct dimensions are not unique by key once attributes change."""
    star = music.build_star(play_log(spark, sf_dir), catalogue(spark, sf_dir), "lake")
    return check_declared(star, {t: rules for t, rules in CONSTRAINTS.items() if t != "songplays"})


# --- reports --------------------------------------------------------------------------------
_ARTIST_NAMES = "(SELECT DISTINCT artist_id, artist_name AS name FROM catalogue)"


def _artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_artists(catalogue(spark, sf_dir), "keep_first")


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.build_users(play_log(spark, sf_dir), "latest_level")


@query("popular_artists_all", f"""WITH {_SINGLE}
SELECT name, count(*) AS popularity FROM songplays JOIN {_ARTIST_NAMES} USING (artist_id)
GROUP BY name ORDER BY popularity, name""")
def popular_artists_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.popular_artists(_single_plays(spark, sf_dir), _artists(spark, sf_dir))


@query("popular_artists_top5", f"""WITH {_SINGLE}
SELECT name, count(*) AS popularity FROM songplays JOIN {_ARTIST_NAMES} USING (artist_id)
GROUP BY name ORDER BY popularity DESC, name LIMIT 5""")
def popular_artists_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.popular_artists(_single_plays(spark, sf_dir), _artists(spark, sf_dir), 5, descending=True)


@query("active_users_top5", f"""WITH {_SINGLE}
SELECT user_id, count(*) AS song_played FROM songplays GROUP BY user_id ORDER BY song_played DESC, user_id LIMIT 5""")
def active_users_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.active_users(_single_plays(spark, sf_dir), 5)


@query("active_names_top5", f"""WITH {_SINGLE}, users AS (
  SELECT DISTINCT userId AS user_id, firstName AS first_name FROM play_log WHERE page = 'NextSong')
SELECT first_name, count(*) AS song_played FROM songplays JOIN users USING (user_id)
GROUP BY first_name ORDER BY song_played DESC, first_name LIMIT 5""")
def active_names_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.active_first_names(_single_plays(spark, sf_dir), _users(spark, sf_dir), 5)


# --- query tables ---------------------------------------------------------------------------
_SCHEMAS = {
    "plays_by_session": PLAYS_BY_SESSION,
    "plays_by_user": PLAYS_BY_USER,
    "listeners_by_song": LISTENERS_BY_SONG,
}


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A query table, written in its layout and read back."""
    path = scratch_path(spark, name)
    table = _built(spark, sf_dir, name)
    query_tables.write(table, name, path)
    return spark.read.schema(table.schema).parquet(path)


_BY_SESSION = f"""{PLAY_LOG}, by_session AS (
  SELECT sessionId, itemInSession, artist, song, CAST(length AS DOUBLE) AS length
  FROM (SELECT *, row_number() OVER (PARTITION BY sessionId, itemInSession
                                     ORDER BY ts DESC, artist DESC, song DESC, length DESC) AS n FROM play_log)
  WHERE n = 1)"""
_BY_USER = f"""{PLAY_LOG}, by_user AS (
  SELECT userId, sessionId, itemInSession, artist, song, firstName, lastName
  FROM (SELECT *, row_number() OVER (PARTITION BY userId, sessionId, itemInSession
                                     ORDER BY ts DESC, artist DESC, song DESC, firstName DESC, lastName DESC) AS n FROM play_log)
  WHERE n = 1)"""
_BY_SONG = f"""{PLAY_LOG}, by_song AS (
  SELECT song, userId, firstName, lastName
  FROM (SELECT *, row_number() OVER (PARTITION BY song, userId ORDER BY ts, firstName, lastName) AS n FROM play_log)
  WHERE n = 1)"""


def _length_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("length", F.col("length").cast("double"))


def _built(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    events = query_tables.clean_events(play_log(spark, sf_dir), keep=["ts"])
    return getattr(query_tables, name)(events, ["ts"], _SCHEMAS[name])


@query("plays_by_session", f"WITH {_BY_SESSION} SELECT * FROM by_session")
def plays_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _length_as_double(_built(spark, sf_dir, "plays_by_session"))


@query("plays_by_user", f"WITH {_BY_USER} SELECT * FROM by_user")
def plays_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "plays_by_user")


@query("listeners_by_song", f"WITH {_BY_SONG} SELECT * FROM by_song")
def listeners_by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "listeners_by_song")


@query("song_at", f"WITH {_BY_SESSION} SELECT artist, song, length FROM by_session WHERE sessionId = 359 AND itemInSession = 2")
def song_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _length_as_double(reports.song_at(_stored(spark, sf_dir, "plays_by_session"), 359, 2))


@query("session_history", f"""WITH {_BY_USER}
SELECT artist, song, firstName, lastName FROM by_user
WHERE sessionId = 359 AND userId = (SELECT o_custkey FROM orders WHERE o_orderkey = 359)""")
def session_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = read(spark, sf_dir, "orders").filter("o_orderkey = 359").first()["o_custkey"]
    return reports.session_history(_stored(spark, sf_dir, "plays_by_user"), user, 359)


@query("listeners_of", f"WITH {_BY_SONG} SELECT firstName, lastName FROM by_song WHERE song = 'No. 7'")
def listeners_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.listeners_of(_stored(spark, sf_dir, "listeners_by_song"), "No. 7")
