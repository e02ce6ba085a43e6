"""The driver's tables in the shape of the library's sources, in Spark and in check SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from starloom.operators import loads
from starloom.operators.joins import replicated
from starloom.session import configure, scratch_path


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up in the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = configure(spark).read.parquet(path).schema
    return configure(spark).read.schema(_schemas[path]).parquet(path)


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def scratch_database(spark: SparkSession) -> str:
    """A database of its own below the scratch folder."""
    name = f"run_{uuid.uuid4().hex[:12]}"
    loads.create_tables(spark, name, {}, scratch_path(spark, "db"))
    return name


# --- catalogue: one entry per part ----------------------------------------------------------
# Twenty neighbouring parts share a title and five a duration, at any table size, so a play
# matches more than one entry but never a share of the catalogue.
def _title(key: str = "p_partkey") -> Column:
    return F.concat(F.lit("No. "), F.expr(f"{key} div 20"))


def _duration() -> Column:
    return F.floor(F.col("p_retailprice") * 2) / 2


def catalogue(spark: SparkSession, sf_dir: str, shared_ids: bool = False) -> DataFrame:
    """Parts as songs. With ``shared_ids`` parts of one brand and name share a song id."""
    song_id = F.concat_ws("/", "p_brand", "p_name") if shared_ids else F.concat(F.lit("SO"), F.col("p_partkey"))
    return read(spark, sf_dir, "part").select(
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("AR"), F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_size").cast("decimal(18,5)").alias("artist_latitude"),
        (-F.col("p_retailprice")).cast("decimal(18,5)").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        song_id.alias("song_id"),
        _title().alias("title"),
        _duration().cast("decimal(18,5)").alias("duration"),
        F.col("p_size").alias("year"),
    )


CATALOGUE = """catalogue AS (
  SELECT 'SO' || p_partkey AS song_id, p_brand || '/' || p_name AS shared_id,
         'AR' || split_part(p_brand, '#', 2) AS artist_id, p_brand AS artist_name,
         CAST(p_size AS DECIMAL(18,5)) AS artist_latitude,
         CAST(-p_retailprice AS DECIMAL(18,5)) AS artist_longitude,
         p_type AS artist_location, 'No. ' || (p_partkey // 20) AS title,
         CAST(floor(p_retailprice * 2) / 2 AS DECIMAL(18,5)) AS duration, p_size AS year
  FROM part)"""


# --- play log: one event per order line -----------------------------------------------------
def play_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an event log; lines sold at a discount have a length the catalogue lacks.

    Beyond the broadcast limit every join shuffles, so customers meet the orders, which are fewer than the lines, and
    the lines shuffle twice, before they have the texts of order and customer.
    """
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", _duration().alias("duration"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    bought = orders.join(replicated(customer), F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        read(spark, sf_dir, "lineitem")
        .join(replicated(part), F.col("l_partkey") == F.col("p_partkey"))
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    return lines.select(
        F.col("p_brand").alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("c_name").alias("firstName"),
        F.col("o_orderstatus").alias("gender"),
        F.col("l_linenumber").alias("itemInSession"),
        F.col("c_mktsegment").alias("lastName"),
        (F.col("duration") + F.col("l_discount")).cast("decimal(18,5)").alias("length"),
        F.when(F.col("l_linestatus") == "O", "paid").otherwise("free").alias("level"),
        F.col("o_orderpriority").alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("l_returnflag") == "R", "Home").otherwise("NextSong").alias("page"),
        millis(F.col("o_orderdate")).alias("registration"),
        F.col("l_orderkey").alias("sessionId"),
        _title("l_partkey").alias("song"),
        F.lit(200).alias("status"),
        (millis(F.col("l_shipdate")) + F.col("l_partkey")).alias("ts"),
        F.col("l_returnflag").alias("userAgent"),
        F.col("o_custkey").alias("userId"),
    )


PLAY_LOG = """play_log AS (
  SELECT p_brand AS artist, 'Logged In' AS auth, c_name AS firstName, o_orderstatus AS gender,
         l_linenumber AS itemInSession, c_mktsegment AS lastName,
         CAST(floor(p_retailprice * 2) / 2 + l_discount AS DECIMAL(18,5)) AS length,
         CASE WHEN l_linestatus = 'O' THEN 'paid' ELSE 'free' END AS level,
         o_orderpriority AS location, 'PUT' AS method,
         CASE WHEN l_returnflag = 'R' THEN 'Home' ELSE 'NextSong' END AS page,
         epoch_us(o_orderdate) // 1000 AS registration,
         l_orderkey AS sessionId, 'No. ' || (p_partkey // 20) AS song, 200 AS status,
         epoch_us(l_shipdate) // 1000 + l_partkey AS ts, l_returnflag AS userAgent,
         o_custkey AS userId
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey)"""


# --- activity log: one event per row of events ----------------------------------------------
def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as an event log; purchases count as plays."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"),
        F.concat(F.lit("U"), F.col("user_id")).alias("firstName"),
        F.col("props").alias("lastName"),
        F.when(F.col("value") < 10, "F").otherwise("M").alias("gender"),
        F.when(k < 50, "free").otherwise("paid").alias("level"),
        F.when(F.col("event_type") == "purchase", "NextSong").otherwise(F.col("event_type")).alias("page"),
        millis(F.col("ts")).alias("ts"),
        F.col("event_id").alias("itemInSession"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("sessionId"),
    )


ACTIVITY_LOG = """activity_log AS (
  SELECT user_id AS userId, 'U' || user_id AS firstName, props AS lastName,
         CASE WHEN value < 10 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'free' ELSE 'paid' END AS level,
         CASE WHEN event_type = 'purchase' THEN 'NextSong' ELSE event_type END AS page,
         epoch_us(ts) // 1000 AS ts, event_id AS itemInSession,
         user_id * 100 + day(ts) AS sessionId
  FROM events)"""


# --- travel: one arrival per order ----------------------------------------------------------
def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the immigration source table; country 30 is in no code list."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = read(spark, sf_dir, "orders")
    priority = F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int")
    joined = orders.join(replicated(customer), F.col("o_custkey") == F.col("c_custkey"))
    days = F.datediff(F.col("o_orderdate"), F.to_date(F.lit("1960-01-01"))).cast("double")
    text = F.lit(None).cast("string")
    return joined.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        (priority * 6).cast("double").alias("i94res"),
        F.col("c_mktsegment").alias("i94port"),
        days.alias("arrdate"),
        priority.cast("double").alias("i94mode"),
        F.col("c_mktsegment").alias("i94addr"),
        (days + priority).alias("depdate"),
        F.lit(40.0).alias("i94bir"),
        F.when(priority <= 3, priority.cast("double")).alias("i94visa"),
        text.alias("visapost"), text.alias("occup"), text.alias("matflag"),
        F.lit(1976.0).alias("biryear"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("gender"),
        text.alias("airline"),
        F.col("o_totalprice").alias("admnum"),
        F.col("o_orderpriority").alias("fltno"),
        F.lit("B2").alias("visatype"),
    )


ARRIVALS = """arrivals AS (
  SELECT CAST(o_orderkey AS INTEGER) AS cic_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month, c_nationkey AS citizen_country,
         CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority,
         CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) * 6 AS residence_country,
         c_mktsegment AS city_code, o_orderdate,
         date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS days,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS gender, o_totalprice AS admin_num
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("country"))
