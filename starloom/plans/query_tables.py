"""Cleaned event extract and the denormalised tables that answer one lookup each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from starloom.functions.coerce import conform
from starloom.operators.conflicts import first_write_wins, last_write_wins
from starloom.operators.loads import cluster_by, write_parquet
from starloom.schemas import CLEAN_EVENTS, LISTENERS_BY_SONG, PLAYS_BY_SESSION, PLAYS_BY_USER


def clean_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows that name an artist, reduced to the eleven columns the lookups need.

    ``keep`` carries further columns along, to order conflicting writes by.
    """
    named = events.filter(F.col("artist").isNotNull() & (F.col("artist") != ""))
    return named.select(*CLEAN_EVENTS, *keep)


def _stored(events: DataFrame, schema: T.StructType, keys: Sequence[str], order: Sequence[str], conflict) -> DataFrame:
    extra = [c for c in order if c not in schema.fieldNames()]
    rows = conform(events, schema, keep=extra)
    return conflict(rows, keys, order).select(*schema.fieldNames())


def plays_by_session(
    events: DataFrame, order: Sequence[str] = (), schema: T.StructType = PLAYS_BY_SESSION,
) -> DataFrame:
    """Artist, song and length by (sessionId, itemInSession); the last write wins."""
    return _stored(events, schema, ["sessionId", "itemInSession"], order, last_write_wins)


def plays_by_user(
    events: DataFrame, order: Sequence[str] = (), schema: T.StructType = PLAYS_BY_USER,
) -> DataFrame:
    """Plays by ((userId, sessionId), itemInSession); the last write wins."""
    return _stored(events, schema, ["userId", "sessionId", "itemInSession"], order, last_write_wins)


def listeners_by_song(
    events: DataFrame, order: Sequence[str] = (), schema: T.StructType = LISTENERS_BY_SONG,
) -> DataFrame:
    """Listeners by (song, userId); the first write wins."""
    return _stored(events, schema, ["song", "userId"], order, first_write_wins)


# Partition key and clustering columns each table is laid out by.
LAYOUTS = {
    "plays_by_session": (("sessionId", "itemInSession"), ()),
    "plays_by_user": (("userId", "sessionId"), ("itemInSession",)),
    "listeners_by_song": (("song",), ("userId",)),
}


# Columns that lookups name without the leading key.
LOOKUP = {"plays_by_session": (), "plays_by_user": ("sessionId",), "listeners_by_song": ("userId",)}


def laid_out(df: DataFrame, table: str) -> DataFrame:
    return cluster_by(df, *LAYOUTS[table])


def write(df: DataFrame, table: str, path: str) -> None:
    """Store a query table in its layout, with filters for lookups that the order does not serve."""
    write_parquet(laid_out(df, table), path, lookup=LOOKUP[table])
