"""The analytic queries on the star schemas.

Facts are counted per key before they meet a dimension: a key with a large share of the rows is
one row by then, and the join works on counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.joins import lookup_join


def _top(df: DataFrame, count: str, tie: str, limit: int | None, descending: bool) -> DataFrame:
    """Sort by a count, ties by name, and keep the first ``limit`` rows if a limit is given."""
    rank: Column = F.col(count).desc() if descending else F.col(count).asc()
    ordered = df.orderBy(rank, F.col(tie).asc())
    return ordered if limit is None else ordered.limit(limit)


def _joined_counts(fact: DataFrame, dim: DataFrame, key: str, name: str, count: str) -> DataFrame:
    """Rows of ``fact JOIN dim USING (key)`` per name, from the counts of either side."""
    used = fact.groupBy(key).agg(F.count("*").alias("_used"))
    named = dim.groupBy(key, name).agg(F.count("*").alias("_named"))
    return used.join(named, key).groupBy(name).agg(F.sum(F.col("_used") * F.col("_named")).alias(count))


def popular_artists(songplays: DataFrame, artists: DataFrame, limit: int | None = None, descending: bool = False) -> DataFrame:
    """Plays per artist name: (name, popularity)."""
    counts = _joined_counts(songplays, artists, "artist_id", "name", "popularity")
    return _top(counts, "popularity", "name", limit, descending)


def active_users(songplays: DataFrame, limit: int | None = 5) -> DataFrame:
    """Plays per user id, most active first: (user_id, song_played)."""
    counts = songplays.groupBy("user_id").agg(F.count("*").alias("song_played"))
    return _top(counts, "song_played", "user_id", limit, descending=True)


def active_first_names(songplays: DataFrame, users: DataFrame, limit: int | None = 5) -> DataFrame:
    """Plays per first name, most active first: (first_name, song_played)."""
    counts = _joined_counts(songplays, users, "user_id", "first_name", "song_played")
    return _top(counts, "song_played", "first_name", limit, descending=True)


def song_at(plays_by_session: DataFrame, session: int, item: int) -> DataFrame:
    """What was heard at one place of a session."""
    return plays_by_session.filter((F.col("sessionId") == session) & (F.col("itemInSession") == item)).select("artist", "song", "length")


def session_history(plays_by_user: DataFrame, user: int, session: int) -> DataFrame:
    """What a user heard in a session, in order."""
    return (
        plays_by_user.filter((F.col("userId") == user) & (F.col("sessionId") == session))
        .orderBy("itemInSession")
        .select("artist", "song", "firstName", "lastName")
    )


def listeners_of(listeners_by_song: DataFrame, song: str) -> DataFrame:
    """Who heard a song, in user order."""
    return listeners_by_song.filter(F.col("song") == song).orderBy("userId").select("firstName", "lastName")


def immigrants_with_countries(immigration: DataFrame, countries: DataFrame) -> DataFrame:
    """Immigrants with the names of their citizenship and residence countries, by ``cic_id``."""
    def named(role: str) -> DataFrame:
        return countries.select(F.col("country_code").alias(role), F.col("country").alias(f"{role}_name"))

    joined = immigration.select("cic_id", "gender", "citizen_country", "residence_country")
    for role in ("citizen_country", "residence_country"):
        joined = lookup_join(joined, named(role), [role], "left")
    return joined.select(
        "cic_id", "gender",
        F.col("citizen_country_name").alias("citizen_country"),
        F.col("residence_country_name").alias("residence_country"),
    ).orderBy("cic_id", "gender", "citizen_country", "residence_country")


def gender_distribution(immigration: DataFrame, countries: DataFrame, country: str) -> DataFrame:
    """Immigrants with one citizenship per gender: (immigrants, gender)."""
    counts = immigration.groupBy("citizen_country", "gender").agg(F.count("cic_id").alias("n"))
    codes = countries.filter(F.col("country") == country).select(F.col("country_code").alias("citizen_country"))
    return counts.join(codes, "citizen_country").groupBy("gender").agg(F.sum("n").alias("immigrants")).select("immigrants", "gender")
