"""File sources and sinks, and the end-to-end loads, on files written from the driver's tables."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harness.registry import query
from harness.tables import ARRIVALS, CATALOGUE, PLAY_LOG, arrivals, catalogue, play_log, read, scratch_database
from starloom import schemas
from starloom.operators import loads
from starloom.operators.ids import surrogate_id
from starloom.operators.joins import lookup_join
from starloom.plans import jobs, query_tables
from starloom.schemas import DOUBLE, INT, LONG, STRING, as_text, table
from starloom.session import materialize, scratch_path
from starloom.sources import files, labels, staging

# --- JSON -----------------------------------------------------------------------------------
_ORDERS = table(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=STRING, o_totalprice=DOUBLE, o_orderpriority=STRING)
_ORDER_COLUMNS = ", ".join(_ORDERS.fieldNames())


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(*_ORDERS.fieldNames(), "o_orderdate")


@query("json_roundtrip", f"SELECT {_ORDER_COLUMNS} FROM orders")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory tree of JSON files, keys quoted as text."""
    path = scratch_path(spark, "json")
    rows = _orders(spark, sf_dir).withColumn("o_custkey", F.col("o_custkey").cast("string"))
    loads.write_json(rows.withColumn("year", F.year("o_orderdate")), path, ["year"])
    return staging.load_json(spark, path, _ORDERS)


@query("multi_path_read", f"SELECT {_ORDER_COLUMNS} FROM orders")
def multi_path_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of several directories read as one table."""
    path = scratch_path(spark, "paths")
    finished = F.col("o_orderstatus") == "F"
    for name, rows in (("finished", _orders(spark, sf_dir).filter(finished)), ("open", _orders(spark, sf_dir).filter(~finished))):
        loads.write_json(rows, f"{path}/{name}/deep")
    return staging.load_json(spark, [f"{path}/finished", f"{path}/open"], _ORDERS)


@query("jsonpaths_load", "SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS price, o_orderstatus AS status FROM orders")
def jsonpaths_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonpaths")
    nested = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", F.struct("o_orderpriority", "o_orderstatus").alias("detail"))
    nested.write.json(f"{path}/data")
    document = json.dumps({"jsonpaths": ["$['o_orderkey']", "$.detail.o_orderpriority", "$.o_totalprice", "$['detail']['o_orderstatus']"]})
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(f"{path}/paths")
    target = table(order_id=LONG, priority=STRING, price=DOUBLE, status=STRING)
    return staging.load_json_paths(spark, f"{path}/data", staging.read_json_paths(spark, f"{path}/paths"), target)


@query("invalid_chars", r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '^', 'g') AS text FROM documents")
def invalid_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents stored as Latin-1: every accented letter is an invalid byte."""
    path = scratch_path(spark, "latin1")
    lines = read(spark, sf_dir, "documents").select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    lines.select(F.encode("value", "ISO-8859-1").cast("string").alias("value")).write.text(path)
    return staging.load_json_repaired(spark, path, table(doc_id=LONG, text=STRING))


_BROKEN, _NO_OBJECT = "o_orderkey % 11 = 0", "o_orderkey % 17 = 0"
_FITS = f"NOT ({_BROKEN}) AND NOT ({_NO_OBJECT}) AND o_orderkey % 7 <> 0"


def _faulty_orders(spark: SparkSession, sf_dir: str) -> staging.Staged:
    """Orders as JSON lines, some cut off, some inside an array, some with a word for a number; empty prices are nulls."""
    path = scratch_path(spark, "faulty")
    rows = _orders(spark, sf_dir).drop("o_orderdate").withColumns({
        "o_custkey": F.expr("if(o_orderkey % 7 = 0, concat('no. ', o_custkey), cast(o_custkey as string))"),
        "o_totalprice": F.expr("if(o_orderkey % 13 = 0, '', cast(o_totalprice as string))")})
    whole = F.to_json(F.struct(*rows.columns))
    line = F.when(F.expr(_BROKEN), F.substring(whole, F.lit(1), F.length(whole) - 5)).when(
        F.expr(_NO_OBJECT), F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole)
    rows.select(line.alias("value")).write.text(path)
    return staging.stage_json(spark, path, _ORDERS, max_rejects=None)


@query("json_rejects", f"""SELECT {_ORDER_COLUMNS.replace("o_totalprice", "CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS o_totalprice")}
FROM orders WHERE {_FITS}""")
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a faulty file whose every value fits; nothing has become null unseen."""
    return _faulty_orders(spark, sf_dir).rows


@query("json_reject_report", f"""SELECT 'line' AS column_name, count(*) AS rejects FROM orders WHERE {_BROKEN} OR {_NO_OBJECT}
UNION ALL SELECT 'o_custkey', count(*) FROM orders WHERE o_orderkey % 7 = 0 AND NOT ({_BROKEN} OR {_NO_OBJECT})
UNION ALL SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_totalprice', 'o_orderpriority']), 0
UNION ALL SELECT 'kept', count(*) FROM orders WHERE {_FITS} UNION ALL SELECT 'lines at fault', count(*) FROM orders WHERE NOT ({_FITS})""")
def json_reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects by column, counted while the rows were staged, and the number of lines kept and set aside."""
    staged = _faulty_orders(spark, sf_dir)
    totals = staged.rows.agg(F.lit("kept").alias("column_name"), F.count("*").alias("rejects")).unionByName(
        staged.rejects.agg(F.lit("lines at fault").alias("column_name"), F.count("*").alias("rejects")))
    return staged.report().unionByName(totals)


@query("scoped_path", f"SELECT {_ORDER_COLUMNS} FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3")
def scoped_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the run's month is read; the month in the path has no leading zero."""
    path = scratch_path(spark, "scoped")
    dated = _orders(spark, sf_dir).withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    loads.write_json(dated, path, ["year", "month"])
    month = staging.scoped_path(path + "/year={run.year}/month={run.month}", datetime(1997, 3, 5))
    return staging.load_json(spark, month, _ORDERS)


@query("first_per_file", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, min(o_orderdate) AS o_orderdate,
       arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""")
def first_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sorted file per year, so the first record of a file is the first of its year."""
    path = scratch_path(spark, "sorted")
    orders = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderdate", "o_orderkey")
    ordered = (
        orders.withColumn("folder", F.col("year"))
        .repartition("folder")
        .sortWithinPartitions("folder", "o_orderdate", "o_orderkey")
    )
    ordered.write.partitionBy("folder").json(path)
    return files.first_per_file(files.read_json(spark, path, orders.schema))


@query("load_report", "SELECT o_orderpriority AS folder, count(*) AS row_count FROM orders GROUP BY 1")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    loads.write_json(orders, path, ["o_orderpriority"])
    report = files.load_report(files.read_json(spark, path, table(o_orderkey=LONG)))
    folder = F.regexp_replace(F.regexp_extract("file", "o_orderpriority=([^/]*)/", 1), "%20", " ")
    return report.groupBy(folder.alias("folder")).agg(F.sum("row_count").alias("row_count"))


# --- CSV ------------------------------------------------------------------------------------
_CLEAN = ", ".join(c if c not in ("itemInSession", "sessionId", "userId") else f"CAST({c} AS VARCHAR) AS {c}" for c in schemas.CLEAN_EVENTS)


@query("clean_events_csv", f"WITH {PLAY_LOG} SELECT {_CLEAN.replace('length', 'CAST(length AS VARCHAR) AS length')} FROM play_log WHERE page = 'NextSong'")
def clean_events_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event CSVs with blank artists, cleaned into one quoted CSV data set."""
    path = scratch_path(spark, "events")
    log = play_log(spark, sf_dir).select(*schemas.EVENT_CSV.fieldNames(), "page")
    log = log.withColumn("artist", F.when(F.col("page") == "NextSong", F.col("artist")))
    log.select(*schemas.EVENT_CSV.fieldNames()).write.csv(f"{path}/raw", header=True, compression="gzip")
    raw = files.read_csv(spark, f"{path}/raw", schemas.EVENT_CSV)
    loads.write_csv(query_tables.clean_events(raw), f"{path}/clean", compression="gzip")
    clean = schemas.table(**{c: STRING for c in schemas.CLEAN_EVENTS})
    return files.read_csv(spark, f"{path}/clean", clean)


@query("csv_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with commas, quotes and line breaks survives a quoted CSV."""
    path = scratch_path(spark, "csv")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    loads.write_csv(rows, path, separator=";")
    return files.read_csv(spark, path, rows.schema, separator=";", multiline=True)


# --- code-list text -------------------------------------------------------------------------
def _label_text(spark: SparkSession, sf_dir: str, line: Column) -> DataFrame:
    path = scratch_path(spark, "labels")
    read(spark, sf_dir, "customer").orderBy("c_custkey").select(line.alias("value")).write.text(path)
    return labels.numbered_lines(spark, path, per_file=False)


@query("label_trim", """SELECT CAST(c_nationkey AS VARCHAR) AS code, arg_max(c_name || '  ', c_custkey) AS label,
       arg_max(c_name, c_custkey) AS tidy_label FROM customer GROUP BY c_nationkey""")
def label_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation codes repeat, so the last line of a code gives its label."""
    line = F.concat(F.lit("  "), "c_nationkey", F.lit(" =\t'"), "c_name", F.lit("  ' = x"))
    lines = _label_text(spark, sf_dir, line)
    total = read(spark, sf_dir, "customer").count()
    block = labels.LabelBlock("code", "label", 0, total, labels.COUNTRIES.code_trim, labels.COUNTRIES.label_trim)
    tidy = labels.parse_labels(lines, block, tidy=True).withColumnRenamed("label", "tidy_label")
    return labels.parse_labels(lines, block).join(tidy, "code")


@query("label_blocks", """WITH numbered AS (
  SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS line, count(*) OVER () AS total FROM customer)
SELECT CASE WHEN line < total // 3 THEN 'country' WHEN line < total // 3 * 2 THEN 'city' ELSE 'state' END AS block,
       CASE WHEN line < total // 3 THEN '''' || c_custkey || '''' WHEN line < total // 3 * 2 THEN CAST(c_custkey AS VARCHAR)
            ELSE c_custkey || ''' ' END AS code, c_name AS label FROM numbered""")
def label_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line shape read by the three trimming rules, each over its own third of the lines."""
    line = F.concat(F.lit("\t'"), "c_custkey", F.lit("' =\t'"), "c_name", F.lit("'"))
    lines = _label_text(spark, sf_dir, line)
    total = read(spark, sf_dir, "customer").count()
    third = total // 3
    parts = []
    for rules, start, end in ((labels.COUNTRIES, 0, third), (labels.CITIES, third, 2 * third), (labels.STATES, 2 * third, total)):
        block = labels.LabelBlock("code", "label", start, end, rules.code_trim, rules.label_trim)
        parts.append(labels.parse_labels(lines, block).withColumn("block", F.lit(rules.label)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- Parquet --------------------------------------------------------------------------------
@query("partitioned_roundtrip", f"SELECT {_ORDER_COLUMNS}, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    rows = _orders(spark, sf_dir).select(
        *_ORDERS.fieldNames(), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    loads.write_parquet(rows, path, ["year", "month"], sort_by=["o_orderkey"])
    return files.read_table(spark, path, "parquet", rows.schema)


@query("views_over_lake", "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def views_over_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    loads.write_parquet(read(spark, sf_dir, "customer"), f"{root}/lake_customer", ["c_mktsegment"])
    loads.write_parquet(read(spark, sf_dir, "nation"), f"{root}/lake_nation", files=1)
    files.register_views(spark, root, ["lake_customer", "lake_nation"])
    return spark.sql("""
        SELECT n_name, sum(n) AS customers
        FROM (SELECT c_nationkey, count(*) AS n FROM lake_customer GROUP BY c_nationkey)
        JOIN lake_nation ON c_nationkey = n_nationkey GROUP BY n_name""")


# --- end-to-end loads -----------------------------------------------------------------------
def _write_music_sources(spark: SparkSession, sf_dir: str) -> str:
    """Song and log files; the logs in one directory per year and month.

    JSON lines repeat their field names, so they are compressed, in files small enough to be read by one task each. Log
    lines are written by the tasks that join them, in time order, with a file in each of their months' directories.
    """
    source = scratch_path(spark, "music")

    def write(rows: DataFrame, name: str, *folders: str) -> None:
        rows.write.option("maxRecordsPerFile", 250_000).partitionBy(*folders).json(f"{source}/{name}", compression="gzip")

    write(catalogue(spark, sf_dir), "song_data")
    log = play_log(spark, sf_dir)
    day = F.timestamp_millis("ts")
    dated = log.withColumns({"y": F.year(day), "m": F.month(day)}).sortWithinPartitions("y", "m", "ts")
    write(dated, "log_data", "y", "m")
    return source


def _content(df: DataFrame, columns: list[str], whole: tuple[str, ...] = ()) -> Column:
    """A number that depends on the given columns of all rows, in any order; ``_content_sql`` is the same in SQL.

    Times count in milliseconds, fractions in steps of 1 / 100,000, the columns ``whole`` as whole numbers.
    """
    def text(c: str) -> Column:
        value, kind = F.col(c), df.schema[c].dataType.simpleString()
        if kind == "timestamp_ntz":
            value = F.unix_millis(value.cast("timestamp"))
        elif c in whole:
            value = value.cast("long")
        elif kind == "double" or kind.startswith("decimal"):
            value = F.round(value * 100_000).cast("long")
        return F.coalesce(value.cast("string"), F.lit("null"))

    digits = F.substring(F.md5(F.concat_ws("|", *[text(c) for c in columns])), 1, 8)
    return F.sum(F.conv(digits, 16, 10).cast("long"))


def _content_sql(*values: str) -> str:
    texts = ", ".join(f"coalesce(CAST({v} AS VARCHAR), 'null')" for v in values)
    return f"CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 8) AS BIGINT)) AS BIGINT) AS content"


def _steps(value: str) -> str:
    """A fraction as ``_content`` counts it."""
    return f"CAST(round(({value}) * 100000) AS BIGINT)"


def _contents(tables: dict[str, DataFrame], columns: dict[str, list[str]], whole: tuple[str, ...] = ()) -> DataFrame:
    """Rows and contents of every table."""
    reports = [
        tables[t].agg(F.count("*").alias("row_count"), _content(tables[t], c, whole).alias("content"))
        .select(F.lit(t).alias("table_name"), "row_count", "content") for t, c in columns.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def _contents_sql(**tables: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, {content}" for t, content in tables.items())


_PLAYS = f"{PLAY_LOG}, {CATALOGUE}, plays AS (SELECT DISTINCT * FROM play_log WHERE page = 'NextSong')"


_STAMP = "make_timestamp(ts * 1000)"
_CALENDAR = [f"{part}({_STAMP})" for part in ("hour", "day", "week", "month", "year")]
_TIME_COLUMNS = ["start_time", "hour", "day", "week", "month", "year", "weekday"]
_USER_COLUMNS = ["user_id", "first_name", "last_name", "gender", "level"]
_SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]
_ARTIST_COLUMNS = ["artist_id", "name", "location", "latitude", "longitude"]
_PLAY_COLUMNS = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]
_USER_SQL = _content_sql("userId", "firstName", "lastName", "gender", "level")
_PLAY_VALUES = ("userId", "level", "song_id", "artist_id", "sessionId", "location", "userAgent")


@query("music_lake_load", f"""WITH {_PLAYS} {_contents_sql(
    songs=_content_sql("song_id", "title", "artist_id", "year", _steps("duration")) + " FROM (SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalogue)",
    artists=_content_sql("artist_id", "artist_name", "artist_location", _steps("artist_latitude"), _steps("artist_longitude"))
    + " FROM (SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude FROM catalogue)",
    users=_USER_SQL + " FROM (SELECT DISTINCT userId, firstName, lastName, gender, level FROM plays)",
    time=_content_sql("ts", *_CALENDAR, f"dayofweek({_STAMP}) + 1") + " FROM (SELECT DISTINCT ts FROM plays)",
    songplays=_content_sql("ts", *_PLAY_VALUES, _CALENDAR[4], _CALENDAR[3]) + " FROM plays p JOIN catalogue c ON p.song = c.title AND p.artist = c.artist_name")}""")
def music_lake_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _write_music_sources(spark, sf_dir), scratch_path(spark, "lake")
    paths = jobs.run_music_lake(spark, source, target)
    columns = {
        "songs": _SONG_COLUMNS, "artists": _ARTIST_COLUMNS, "users": _USER_COLUMNS, "time": _TIME_COLUMNS,
        "songplays": [*_PLAY_COLUMNS, "year", "month"],
    }
    return _contents({t: spark.read.parquet(paths[t]) for t in columns}, columns)


@query("music_lake_songplays", f"""WITH {_PLAYS}
SELECT make_timestamp(p.ts * 1000) AS start_time, p.userId AS user_id, p.level, c.song_id, c.artist_id,
       p.sessionId AS session_id, p.location, p.userAgent AS user_agent,
       CAST(year(make_timestamp(p.ts * 1000)) AS INTEGER) AS year, CAST(month(make_timestamp(p.ts * 1000)) AS INTEGER) AS month,
       CAST(1 AS BIGINT) AS rows_with_this_id
FROM plays p JOIN catalogue c ON p.song = c.title AND p.artist = c.artist_name""")
def music_lake_songplays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading one month again replaces its directories and leaves the others alone; ids stay unique."""
    source, target = _write_music_sources(spark, sf_dir), scratch_path(spark, "lake")
    paths = jobs.run_music_lake(spark, source, target)
    jobs.refresh_music_lake(spark, source, target, datetime(1997, 3, 1), logs="log_data/y={run.year}/m={run.month}")
    plays = spark.read.parquet(paths["songplays"])
    uses = plays.groupBy("songplay_id").agg(F.count(F.lit(1)).alias("uses"))
    shared = materialize(uses.filter("uses > 1"), "shared")  # only ids are counted, and only those of several rows joined
    plays = lookup_join(plays, shared, ["songplay_id"], "left", unique=True)
    plays = plays.withColumn("rows_with_this_id", F.coalesce("uses", F.lit(1).cast("long"))).drop("songplay_id", "uses")
    return plays.withColumns({"user_id": F.col("user_id").cast("long"), "session_id": F.col("session_id").cast("long")})


_WHOLE = "CAST(trunc({}) AS BIGINT)".format
_SECONDS = "ts // 1000 * 1000"  # in milliseconds


@query("music_warehouse_load", f"""WITH {PLAY_LOG}, {CATALOGUE}, plays AS (
  SELECT *, CAST(trunc(length) AS BIGINT) AS whole FROM play_log WHERE page = 'NextSong'), fact AS (
  SELECT p.*, c.song_id, c.artist_id FROM plays p LEFT JOIN catalogue c ON p.song = c.title AND p.artist = c.artist_name AND p.whole = CAST(trunc(c.duration) AS BIGINT)),
songs AS (SELECT DISTINCT song_id, title, artist_id, year, {_WHOLE("duration")} AS duration FROM catalogue),
artists AS (SELECT DISTINCT artist_id, artist_name, artist_location, {_WHOLE("artist_latitude")} AS latitude, {_WHOLE("artist_longitude")} AS longitude FROM catalogue),
users AS (SELECT DISTINCT userId, firstName, lastName, gender, level FROM plays)
SELECT 'songs' AS table_name, count(*) AS row_count, {_content_sql("song_id", "title", "artist_id", "year", "duration")} FROM songs
UNION ALL SELECT 'artists', count(*), {_content_sql("artist_id", "artist_name", "artist_location", "latitude", "longitude")} FROM artists
UNION ALL SELECT 'users', count(*), {_content_sql("userId", "firstName", "lastName", "gender", "level")} FROM users
UNION ALL SELECT 'time', count(*), {_content_sql(_SECONDS, "hour(make_timestamp(ts * 1000))", "week(make_timestamp(ts * 1000))", "year(make_timestamp(ts * 1000))")} FROM fact
UNION ALL SELECT 'songplays', count(*), {_content_sql(_SECONDS, "userId", "level", "song_id", "artist_id", "sessionId", "location", "userAgent")} FROM fact""")
def music_warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the second one restages and reloads, and adds no plays."""
    source, database = _write_music_sources(spark, sf_dir), scratch_database(spark)
    config = jobs.WarehouseConfig(database, f"{source}/log_data", f"{source}/song_data")
    for _ in range(2):
        jobs.run_music_warehouse(spark, config, datetime(1997, 3, 1))
    columns = {
        "songs": ["song_id", "title", "artist_id", "year", "duration"],
        "artists": ["artist_id", "name", "location", "latitude", "longitude"],
        "users": ["user_id", "first_name", "last_name", "gender", "level"],
        "time": ["start_time", "hour", "week", "year"],
        "songplays": _PLAY_COLUMNS,
    }
    return _contents({t: spark.table(f"{database}.`{t}`") for t in columns}, columns, ("duration", "latitude", "longitude"))


@query("music_store_load", f"""WITH {PLAY_LOG}, {CATALOGUE}, plays AS (SELECT * FROM play_log WHERE page = 'NextSong'),
artists AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY artist_id ORDER BY artist_name, artist_location, artist_latitude, artist_longitude) AS n FROM catalogue) WHERE n = 1),
users AS (SELECT userId, arg_min(firstName, (ts, firstName, lastName, gender, level)) AS firstName,
  arg_min(lastName, (ts, firstName, lastName, gender, level)) AS lastName, arg_min(gender, (ts, firstName, lastName, gender, level)) AS gender,
  arg_max(level, (ts, level, firstName, lastName, gender)) AS level FROM plays GROUP BY userId),
entries AS (SELECT title, artist_name, duration, min(song_id) AS song_id, arg_min(artist_id, (song_id, artist_id)) AS artist_id
  FROM catalogue GROUP BY title, artist_name, duration),
fact AS (SELECT p.*, e.song_id, e.artist_id, row_number() OVER (ORDER BY ts, userId, p.level, e.song_id NULLS FIRST,
    e.artist_id NULLS FIRST, sessionId, location, userAgent) AS songplay_id
  FROM plays p LEFT JOIN entries e ON p.song = e.title AND p.artist = e.artist_name AND p.length = e.duration)
{_contents_sql(
    songs=_content_sql("song_id", "title", "artist_id", "year", _steps("duration")) + " FROM catalogue",
    artists=_content_sql("artist_id", "artist_name", "artist_location", _steps("artist_latitude"), _steps("artist_longitude")) + " FROM artists",
    users=_USER_SQL + " FROM users",
    time=_content_sql("ts", *_CALENDAR, f"isodow({_STAMP}) - 1") + " FROM (SELECT DISTINCT ts FROM plays)",
    songplays=_content_sql("songplay_id", "ts", *_PLAY_VALUES) + " FROM fact")}""")
def music_store_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files; plays that are stored already are skipped."""
    source, database = _write_music_sources(spark, sf_dir), scratch_database(spark)
    config = jobs.StoreConfig(
        database, f"{source}/song_data", f"{source}/log_data", plays_key=("start_time", "user_id", "session_id"))
    for _ in range(2):
        jobs.run_music_store(spark, config)
    columns = {
        "songs": _SONG_COLUMNS, "artists": _ARTIST_COLUMNS, "users": _USER_COLUMNS, "time": _TIME_COLUMNS,
        "songplays": ["songplay_id", *_PLAY_COLUMNS],
    }
    return _contents({t: spark.table(f"{database}.`{t}`") for t in columns}, columns)


def _thirds(kind: str, code: str) -> str:
    """The code list that a third of the customers makes, one line each."""
    low, high = {"countries": ("0", "total // 3"), "cities": ("total // 3", "total // 3 * 2"), "states": ("total // 3 * 2", "total")}[kind]
    return f"{_content_sql(code, 'c_name')} FROM numbered WHERE line >= {low} AND line < {high}"


_AIRPORT_COLUMNS = ["airport_id", "type", "name", "elevation_ft", "continent", "iso_country", "state_code", "latitude", "longitude"]
_CITY_COLUMNS = ["city", "state", "median_age", "male_population", "female_population", "total_population", "number_of_veterans",
                 "foreign_born", "avg_household_size", "state_code", "race", "count"]
_ARRIVAL_COLUMNS = ["cic_id", "year", "month", "citizen_country", "residence_country", "city_code", "arrival_date", "mode",
                    "departure_date", "gender", "admin_num"]


@query("travel_lake_load", f"""WITH {ARRIVALS}, numbered AS (
  SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS line, count(*) OVER () AS total FROM customer)
{_contents_sql(
    countries=_thirds("countries", "c_custkey"), cities=_thirds("cities", "c_custkey"), states=_thirds("states", "c_custkey || ''' '"),
    airports=_content_sql("c_name", "c_mktsegment", "c_name", "c_nationkey", "'NA'", "'US'", "c_nationkey", _steps("c_acctbal"), _steps("c_nationkey"))
    + " FROM customer WHERE c_nationkey < 13",
    demographic=_content_sql("p_name", "p_type", _steps("p_retailprice"), *["p_size"] * 5, "250000", "p_brand", "'x'", "p_size")
    + " FROM (SELECT DISTINCT p_name, p_type, p_retailprice, p_size, p_brand FROM part)",
    immigration=_content_sql("cic_id", "year", "month", "citizen_country", "residence_country", "city_code", _steps("days"), _steps("priority"),
                             _steps("days + priority"), "gender", _steps("admin_num")) + " FROM arrivals")}""")
def travel_lake_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three code lists from one label file, airports, demographics and arrivals."""
    source, target = scratch_path(spark, "travel"), scratch_path(spark, "lake")
    customer, part = read(spark, sf_dir, "customer"), read(spark, sf_dir, "part")
    total = customer.count()
    third = total // 3
    number = F.col("line") < third  # a code that is a number stands without quotes
    label = F.concat(
        F.lit("\t"), F.when(number, F.lit("")).otherwise("'"), "c_custkey", F.when(number, F.lit("")).otherwise("'"),
        F.when(F.col("line") < 2 * third, F.lit("\t")).otherwise(" "), F.lit("=  '"), "c_name", F.lit("'"))
    numbered = surrogate_id(customer.select("c_custkey", "c_name"), "line", dense=True, order=["c_custkey"])
    numbered.orderBy("line").select(label.alias("value")).write.text(f"{source}/labels")
    blank = F.lit(None).cast("string")
    customer.unionAll(customer).select(
        F.col("c_name").alias("airport_id"), F.col("c_mktsegment").alias("type"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("elevation_ft"), F.lit("NA").alias("continent"),
        F.when(F.col("c_nationkey") < 13, "US").otherwise("XX").alias("iso_country"),
        F.concat(F.lit("US-"), "c_nationkey").alias("iso_region"), blank.alias("municipality"), blank.alias("gps_code"),
        blank.alias("iata_code"), blank.alias("local_code"),
        F.concat(F.col("c_acctbal").cast("decimal(18,2)"), F.lit(", "), "c_nationkey").alias("coordinates"),
    ).write.csv(f"{source}/airports", header=True)
    numbers = [F.col("p_size").alias(c) for c in ("male_population", "female_population", "total_population", "number_of_veterans", "foreign_born")]
    part.unionAll(part).select(
        F.col("p_name").alias("city"), F.col("p_type").alias("state"), F.col("p_retailprice").alias("median_age"), *numbers,
        F.lit(2.5).alias("avg_household_size"), F.col("p_brand").alias("state_code"), F.lit("x").alias("race"), F.col("p_size").alias("count"),
    ).write.csv(f"{source}/demographics", header=True, sep=";")
    arrivals(spark, sf_dir).write.parquet(f"{source}/immigration")
    ranges = ((labels.COUNTRIES, 0, third), (labels.CITIES, third, 2 * third), (labels.STATES, 2 * third, total))
    sources = jobs.TravelSources(
        f"{source}/labels", f"{source}/airports", f"{source}/demographics", f"{source}/immigration",
        blocks=tuple(replace(rules, start=start, end=end) for rules, start, end in ranges), label_lines_per_file=False)
    paths = jobs.run_travel_lake(spark, sources, target)
    columns = {
        "countries": ["country_code", "country"], "cities": ["city_code", "city"], "states": ["state_code", "state"],
        "airports": _AIRPORT_COLUMNS, "demographic": _CITY_COLUMNS, "immigration": _ARRIVAL_COLUMNS,
    }
    return _contents({t: spark.read.parquet(paths[t]) for t in columns}, columns)
