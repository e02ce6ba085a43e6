"""The music star schema: songs, artists, users, time and songplays.

Four loaders of the same schema give different rows; their differences are options here, and
``VARIANTS`` holds the four combinations. ``events`` and ``songs`` are staging frames
(``schemas.STAGING_EVENTS``, ``schemas.STAGING_SONGS``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.calendar import PRECISIONS, calendar_parts
from starloom.functions.keys import hash_key
from starloom.operators.conflicts import append_new, distinct_rows, keep_first, upsert_columns, without_known, without_stored
from starloom.operators.ids import surrogate_id
from starloom.operators.joins import lookup_join
from starloom.schemas import DOUBLE, NUMERIC, SCALE0

PLAY = "NextSong"

# Join columns of the events per match rule; the catalogue side is renamed to the same names.
MATCHES = {
    "artist": ("artist",),
    "title_artist": ("song", "artist"),
    "title_artist_duration": ("song", "artist", "length"),
}

# What the default hashed id of a play is made of.
HASH_PARTS = ("session_id", "start_time")


def hashed_id(parts: Sequence[str] = HASH_PARTS) -> Column:
    """The hashed id of a play, from its other columns."""
    return hash_key(*[F.col(c) for c in parts])


@dataclass(frozen=True)
class Variant:
    """One loader's rules for the star schema."""

    match: str = "title_artist_duration"
    how: str = "left"
    single_match: bool = True
    ids: str = "dense"
    distinct: bool = False
    precision: str = "ms"
    numeric: T.DataType = NUMERIC
    users: str = "latest_level"
    songs: str = "keep_first"
    artists: str = "keep_first"
    weekday: str = "mon0"
    time_distinct: bool = True
    calendar: bool = False


VARIANTS = {
    # row-wise upserts into a relational database
    "row_store": Variant(),
    # INSERT ... SELECT in a column store; weekday repeats the week number there
    "warehouse": Variant(
        match="artist", how="inner", single_match=False, precision="s", users="distinct",
        songs="none", artists="distinct", weekday="week", numeric=SCALE0,
    ),
    # partitioned Parquet
    "lake": Variant(
        match="title_artist", how="inner", single_match=False, ids="monotonic", distinct=True,
        users="distinct", songs="distinct", artists="distinct", weekday="sun1", numeric=DOUBLE, calendar=True,
    ),
    # scheduled warehouse load
    "scheduled": Variant(
        single_match=False, ids="hash", precision="s", numeric=SCALE0, users="distinct",
        songs="distinct", artists="distinct", weekday="sun0", time_distinct=False,
    ),
}


def only_plays(events: DataFrame) -> DataFrame:
    return events.filter(F.col("page") == PLAY)


def _dedupe(df: DataFrame, keys: Sequence[str], dedupe: str, order: Sequence[str]) -> DataFrame:
    if dedupe == "none":
        return df.select([c for c in df.columns if c not in order])
    if dedupe == "distinct":
        return df.select([c for c in df.columns if c not in order]).distinct()
    if dedupe == "keep_first":
        return keep_first(df, keys, order).select([c for c in df.columns if c not in order])
    raise ValueError(f"unknown dedupe rule {dedupe!r}")


def build_songs(songs: DataFrame, dedupe: str = "keep_first", order: Sequence[str] = ()) -> DataFrame:
    """Songs: all rows, distinct rows, or the first row of each id."""
    columns = songs.select("song_id", "title", "artist_id", "year", "duration", *order)
    return _dedupe(columns, ["song_id"], dedupe, order)


def build_artists(songs: DataFrame, dedupe: str = "keep_first", order: Sequence[str] = ()) -> DataFrame:
    """Artists: all rows, distinct rows, or the first row of each id."""
    columns = songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
        *order,
    )
    return _dedupe(columns, ["artist_id"], dedupe, order)


def user_rows(events: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """User attributes of every play, with the columns that order them."""
    return only_plays(events).select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender", "level", *order,
    )


def build_users(
    events: DataFrame,
    mode: str = "latest_level",
    order: Sequence[str] = ("ts",),
    existing: DataFrame | None = None,
) -> DataFrame:
    """Users: distinct rows, the first row of each id, or the first row with the last level.

    ``existing`` (for ``latest_level``) is the stored table the new events are merged into.
    """
    rows = user_rows(events, order)
    if mode == "latest_level":
        return upsert_columns(rows, existing, ["user_id"], order, ["level"])
    if mode == "first_seen":
        return keep_first(rows, ["user_id"], order).drop(*order)
    if mode == "distinct":
        return rows.drop(*order).distinct()
    raise ValueError(f"unknown users mode {mode!r}")


def play_times(events: DataFrame, precision: str = "ms") -> DataFrame:
    """Start time of every play."""
    return only_plays(events).select(PRECISIONS[precision](F.col("ts")).alias("start_time"))


def build_time(start_times: DataFrame, weekday: str = "mon0", distinct: bool = True) -> DataFrame:
    """Calendar parts of a ``start_time`` column.

    Duplicates are removed from the single timestamp column, before the parts are computed.
    """
    times = start_times.select("start_time")
    times = times.distinct() if distinct else times
    return times.select("start_time", *calendar_parts(F.col("start_time"), weekday))


def catalogue_of(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with their artist's name, from the two dimensions."""
    names = artists.select("artist_id", F.col("name").alias("artist_name"))
    return lookup_join(songs, names, ["artist_id"], unique=True).select("song_id", "artist_id", "title", "artist_name", "duration")


def _lookup(songs: DataFrame, keys: Sequence[str], duration: T.DataType, single: bool, distinct: bool) -> DataFrame:
    sources: dict[str, Column] = {
        "song": F.col("title"),
        "artist": F.col("artist_name"),
        "length": F.col("duration").cast(duration),
    }
    if distinct:
        songs = songs.select("song_id", "title", "artist_id", "artist_name").distinct()
    lookup = songs.select("song_id", "artist_id", *[sources[k].alias(k) for k in keys])
    return keep_first(lookup, keys, ["song_id", "artist_id"]) if single else lookup


def build_songplays(
    events: DataFrame,
    songs: DataFrame,
    match: str = "title_artist_duration",
    how: str = "left",
    single_match: bool = True,
    ids: str | None = "dense",
    distinct: bool = False,
    precision: str = "ms",
    duration: T.DataType = NUMERIC,
    calendar: bool = False,
    first_id: int = 1,
    hash_parts: Sequence[str] = HASH_PARTS,
    known: DataFrame | None = None,
    known_by: Sequence[str] = ("songplay_id",),
) -> DataFrame:
    """One row per play and matching catalogue entry.

    ``songs`` needs song_id, artist_id, title, artist_name and duration. ``match`` names the
    columns that must agree; durations are compared as decimals of one scale. ``how="left"``
    keeps unmatched plays with null ids. ``single_match`` reduces the catalogue to its first
    entry per key before the join, so that no play fans out. ``distinct`` removes repeated
    events and catalogue entries before the join, which gives the distinct joined rows without
    shuffling them.
    ``ids`` is ``dense`` (counting up from ``first_id``), ``monotonic``, ``hash`` (md5 of
    ``hash_parts``) or None. Two plays of a session in one second share the default hash; name
    further columns to tell them apart.
    Rows whose columns ``known_by`` are in ``known``, the stored plays, are left out; where those are columns of the event
    or its hash, known events go before the catalogue is joined.
    The ``artist`` rule pairs a play with every song of its artist; to count its rows use
    ``artist_match_counts``.
    """
    if distinct and match == "title_artist_duration":
        raise ValueError("distinct catalogue entries carry no duration")
    keys = MATCHES[match]
    plays = only_plays(events)
    plays = distinct_rows(plays) if distinct else plays
    plays = plays.select(
        PRECISIONS[precision](F.col("ts")).alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *[F.col(k).cast(duration).alias(k) if k == "length" else F.col(k) for k in keys],
    )
    told_by = {*known_by} - {"songplay_id"} | ({*hash_parts} if "songplay_id" in known_by else set())
    early = known is not None and told_by <= {*plays.columns} and ("songplay_id" not in known_by or ids == "hash")
    if early:
        plays = _unknown(plays, known, known_by, hash_parts)
    lookup = _lookup(songs, keys, duration, single_match, distinct)
    joined = lookup_join(plays, lookup, keys, how, unique=single_match)
    columns = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]
    fact = joined.select(*columns)
    if ids == "hash":
        fact = fact.select(hashed_id(hash_parts).alias("songplay_id"), *columns)
    elif ids is not None:
        if ids not in ("dense", "monotonic"):
            raise ValueError(f"unknown id strategy {ids!r}")
        if ids == "dense":
            fact = surrogate_id(fact, "songplay_id", dense=True, order=["start_time"], start=first_id)
        else:
            fact = surrogate_id(fact, "songplay_id", shuffled=True)
        fact = fact.select("songplay_id", *columns)
    if calendar:
        fact = fact.select("*", F.year("start_time").alias("year"), F.month("start_time").alias("month"))
    return fact if known is None or early else append_new(fact, known, known_by)


def _unknown(plays: DataFrame, known: DataFrame, keys: Sequence[str], hash_parts: Sequence[str]) -> DataFrame:
    """The plays whose key is not stored, before they are matched.

    Equal parts have equal hashes, so hashes, which are long, are compared only for plays whose parts are not stored.
    """
    if "songplay_id" not in keys:
        return without_stored(plays, known, keys)
    play_id = hashed_id(hash_parts)
    kinds = {f.name: f.dataType for f in plays.schema}
    stored = known.withColumns({c: F.col(c).cast(kinds[c]) for c in hash_parts})
    plays = without_stored(plays, stored.filter(F.col("songplay_id").eqNullSafe(play_id)), hash_parts)
    return without_known(plays.withColumn("songplay_id", play_id), known, keys, prune=True).drop("songplay_id")


def artist_match_counts(events: DataFrame, songs: DataFrame) -> DataFrame:
    """Rows of the ``artist`` match per song: (song_id, artist_id, plays).

    Plays are counted per artist first, so no play is ever paired with each song of its artist.
    """
    plays = only_plays(events).groupBy("artist").agg(F.count("*").alias("plays"))
    entries = songs.groupBy("song_id", "artist_id", F.col("artist_name").alias("artist")).agg(F.count("*").alias("entries"))
    return (
        lookup_join(entries, plays, ["artist"], unique=True)
        .groupBy("song_id", "artist_id")
        .agg(F.sum(F.col("plays") * F.col("entries")).alias("plays"))
    )


def build_star(
    events: DataFrame, songs: DataFrame, variant: str | Variant = "row_store", first_id: int = 1,
    known: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All five tables by one loader's rules; plays whose id is in ``known`` are left out."""
    v = VARIANTS[variant] if isinstance(variant, str) else variant
    song_dim, artist_dim = build_songs(songs, v.songs), build_artists(songs, v.artists)
    catalogue = catalogue_of(song_dim, artist_dim) if v.single_match else songs
    songplays = build_songplays(
        events, catalogue, v.match, v.how, v.single_match, v.ids, v.distinct, v.precision,
        v.numeric, v.calendar, first_id, known=known,
    )
    times = play_times(events, v.precision) if v.time_distinct else songplays
    return {
        "songs": song_dim.withColumn("duration", F.col("duration").cast(v.numeric)),
        "artists": artist_dim.withColumns({c: F.col(c).cast(v.numeric) for c in ("latitude", "longitude")}),
        "users": build_users(events, v.users),
        "time": build_time(times, v.weekday, v.time_distinct),
        "songplays": songplays,
    }
