"""Explicit schemas of every source and table; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP = T.TimestampNTZType()
NUMERIC = T.DecimalType(18, 5)
SCALE0 = T.DecimalType(18, 0)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all strings: what a file holds before it is conformed."""
    return T.StructType([T.StructField(f.name, STRING) for f in schema])


def with_scale0(schema: T.StructType) -> T.StructType:
    """The warehouse flavour of a table: every numeric column keeps whole numbers only."""
    return T.StructType([
        T.StructField(f.name, SCALE0 if isinstance(f.dataType, T.DecimalType) else f.dataType)
        for f in schema
    ])


# --- music: staging -------------------------------------------------------------------------
STAGING_EVENTS = table(
    artist=STRING, auth=STRING, firstName=STRING, gender=STRING, itemInSession=INT,
    lastName=STRING, length=NUMERIC, level=STRING, location=STRING, method=STRING, page=STRING,
    registration=SCALE0, sessionId=LONG, song=STRING, status=INT, ts=LONG, userAgent=STRING,
    userId=LONG,
)
STAGING_SONGS = table(
    num_songs=INT, artist_id=STRING, artist_name=STRING, artist_latitude=NUMERIC,
    artist_longitude=NUMERIC, artist_location=STRING, song_id=STRING, title=STRING,
    duration=NUMERIC, year=INT,
)


def with_doubles(schema: T.StructType) -> T.StructType:
    """The lake's flavour of a staging table: every fraction is a double, as it stands in the files."""
    return T.StructType([
        T.StructField(f.name, DOUBLE if isinstance(f.dataType, T.DecimalType) else f.dataType)
        for f in schema
    ])


LAKE_EVENTS, LAKE_SONGS = with_doubles(STAGING_EVENTS), with_doubles(STAGING_SONGS)

# --- music: star schema ---------------------------------------------------------------------
SONGPLAYS = table(
    songplay_id=LONG, start_time=TIMESTAMP, user_id=LONG, level=STRING, song_id=STRING,
    artist_id=STRING, session_id=LONG, location=STRING, user_agent=STRING,
)
SONGPLAYS_HASHED = table(
    songplay_id=STRING, start_time=TIMESTAMP, user_id=LONG, level=STRING, song_id=STRING,
    artist_id=STRING, session_id=LONG, location=STRING, user_agent=STRING,
)
USERS = table(user_id=LONG, first_name=STRING, last_name=STRING, gender=STRING, level=STRING)
SONGS = table(song_id=STRING, title=STRING, artist_id=STRING, year=INT, duration=NUMERIC)
ARTISTS = table(
    artist_id=STRING, name=STRING, location=STRING, latitude=NUMERIC, longitude=NUMERIC,
)
TIME = table(
    start_time=TIMESTAMP, hour=INT, day=INT, week=INT, month=INT, year=INT, weekday=INT,
)
TIME_TEXT = table(
    start_time=TIMESTAMP, hour=INT, day=INT, week=INT, month=STRING, year=INT, weekday=STRING,
)

# Tables of the relational store, in the order their keys depend on each other.
STORE = {"users": USERS, "songs": SONGS, "artists": ARTISTS, "time": TIME, "songplays": SONGPLAYS}

# Tables of the warehouse whose ids count up; staging keeps fractions, inserts round them.
COUNTED_WAREHOUSE = {
    "staging_events": STAGING_EVENTS,
    "staging_songs": STAGING_SONGS,
    "users": USERS,
    "songs": with_scale0(SONGS),
    "artists": with_scale0(ARTISTS),
    "time": TIME,
    "songplays": SONGPLAYS,
}

# Tables of the scheduled warehouse.
WAREHOUSE = {
    "staging_events": with_scale0(STAGING_EVENTS),
    "staging_songs": with_scale0(STAGING_SONGS),
    "users": USERS,
    "songs": with_scale0(SONGS),
    "artists": with_scale0(ARTISTS),
    "time": TIME_TEXT,
    "songplays": SONGPLAYS_HASHED,
}

# Declared keys, required columns, references and text lengths of the star schema.
CONSTRAINTS = {
    "users": {"primary_key": ["user_id"], "not_null": ["user_id"], "lengths": {"gender": 1}},
    "songs": {"primary_key": ["song_id"], "not_null": ["song_id"], "lengths": {"title": 256}},
    "artists": {
        "primary_key": ["artist_id"], "not_null": ["artist_id"],
        "lengths": {"name": 500, "location": 500},
    },
    "time": {"primary_key": ["start_time"], "not_null": ["start_time"]},
    "songplays": {
        "primary_key": ["songplay_id"], "not_null": ["songplay_id", "start_time", "user_id"],
        "references": {"start_time": ("time", "start_time"), "user_id": ("users", "user_id")},
    },
}

# The columns the warehouses declare NOT NULL. Their keys are not enforced there, so only null values
# and over-long text stop a load.
COUNTED_CONSTRAINTS = {
    "staging_events": {"not_null": ["sessionId", "ts"]},
    "users": {"not_null": ["user_id"]},
    "songs": {"not_null": ["song_id", "title", "artist_id", "year", "duration"]},
    "artists": {"not_null": ["artist_id"], "lengths": {"name": 500, "location": 500}},
    "time": {"not_null": ["start_time"]},
    "songplays": {"not_null": ["start_time", "user_id", "level", "song_id", "artist_id", "session_id"]},
}
WAREHOUSE_CONSTRAINTS = {
    "users": {"not_null": ["user_id"]},
    "songs": {"not_null": ["song_id"]},
    "artists": {"not_null": ["artist_id"]},
    "time": {"not_null": ["start_time"]},
    "songplays": {"not_null": ["songplay_id", "start_time", "user_id"]},
}
# Every text column of the scheduled warehouse holds this many characters.
WAREHOUSE_TEXT = 256
for _name, _rules in WAREHOUSE_CONSTRAINTS.items():
    _rules["lengths"] = {f.name: WAREHOUSE_TEXT for f in WAREHOUSE[_name] if f.dataType == STRING}

# --- music: event CSV and query tables ------------------------------------------------------
EVENT_CSV = table(
    artist=STRING, auth=STRING, firstName=STRING, gender=STRING, itemInSession=STRING,
    lastName=STRING, length=STRING, level=STRING, location=STRING, method=STRING, page=STRING,
    registration=STRING, sessionId=STRING, song=STRING, status=STRING, ts=STRING, userId=STRING,
)
CLEAN_EVENTS = (
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "sessionId", "song", "userId",
)
PLAYS_BY_SESSION = table(
    sessionId=LONG, itemInSession=INT, artist=STRING, song=STRING, length=NUMERIC,
)
PLAYS_BY_USER = table(
    userId=LONG, sessionId=LONG, itemInSession=INT, artist=STRING, song=STRING,
    firstName=STRING, lastName=STRING,
)
LISTENERS_BY_SONG = table(song=STRING, userId=LONG, firstName=STRING, lastName=STRING)

# --- travel ---------------------------------------------------------------------------------
AIRPORTS_CSV = table(
    airport_id=STRING, type=STRING, name=STRING, elevation_ft=INT, continent=STRING,
    iso_country=STRING, iso_region=STRING, municipality=STRING, gps_code=STRING,
    iata_code=STRING, local_code=STRING, coordinates=STRING,
)
AIRPORTS = (
    "airport_id", "type", "name", "elevation_ft", "continent", "iso_country", "state_code",
    "municipality", "gps_code", "latitude", "longitude",
)
DEMOGRAPHICS_CSV = table(
    city=STRING, state=STRING, median_age=DOUBLE, male_population=INT, female_population=INT,
    total_population=INT, number_of_veterans=INT, foreign_born=INT, avg_household_size=DOUBLE,
    state_code=STRING, race=STRING, count=INT,
)
IMMIGRATION_SOURCE = table(
    cicid=DOUBLE, i94yr=DOUBLE, i94mon=DOUBLE, i94cit=DOUBLE, i94res=DOUBLE, i94port=STRING,
    arrdate=DOUBLE, i94mode=DOUBLE, i94addr=STRING, depdate=DOUBLE, i94bir=DOUBLE,
    i94visa=DOUBLE, visapost=STRING, occup=STRING, matflag=STRING, biryear=DOUBLE,
    gender=STRING, airline=STRING, admnum=DOUBLE, fltno=STRING, visatype=STRING,
)
# Source column -> table column of the immigration fact.
IMMIGRATION_NAMES = {
    "cicid": "cic_id", "i94yr": "year", "i94mon": "month", "i94cit": "citizen_country",
    "i94res": "residence_country", "i94port": "city_code", "arrdate": "arrival_date",
    "i94mode": "mode", "i94addr": "state_code", "depdate": "departure_date", "i94bir": "age",
    "i94visa": "visa", "visapost": "visa_post", "occup": "occupation",
    "matflag": "match_flag", "biryear": "birth_year", "gender": "gender",
    "airline": "airline", "admnum": "admin_num", "fltno": "flight_num",
    "visatype": "visa_type",
}
