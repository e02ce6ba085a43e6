"""Hand-made staging rows in the shape of the source files."""

from __future__ import annotations

from decimal import Decimal

from starloom.schemas import STAGING_EVENTS, STAGING_SONGS

# 2018-11-04 was a Sunday; 2018-12-31 belongs to ISO week 1 of 2019.
SUNDAY = 1541289600000
YEAR_END = 1546214400000


def song(song_id, artist_id, name, title, duration, year=2000, location="X", latitude=None, longitude=None):
    number = lambda x: None if x is None else Decimal(str(x))
    return (1, artist_id, name, number(latitude), number(longitude), location, song_id, title, number(duration), year)


def event(ts, user, session, item, artist, title, length, level="free", page="NextSong", first="Ann", location="L", agent="A"):
    values = dict(
        artist=artist, auth="Logged In", firstName=first, gender="F", itemInSession=item, lastName="Lee",
        length=None if length is None else Decimal(str(length)), level=level, location=location, method="PUT", page=page,
        registration=Decimal(1), sessionId=session, song=title, status=200, ts=ts, userAgent=agent, userId=user)
    return tuple(values[f.name] for f in STAGING_EVENTS)


SONGS = [
    song("S1", "A1", "Band", "Tune", 200.5, location="North", latitude=40.07, longitude=-74.9),
    song("S2", "A1", "Band", "Tune", 200.5, location="South"),
    song("S3", "A1", "Band", "Other", 100.2, location="North", latitude=40.07, longitude=-74.9),
    song("S4", "A2", "Duo", "Tune", 200.5),
    song("S4", "A2", "Duo", "Tune (again)", 201.0),
]

EVENTS = [
    event(SUNDAY + 500, 1, 10, 0, "Band", "Tune", 200.5),
    event(SUNDAY + 900, 1, 10, 1, "Band", "Other", 100.2, level="paid"),
    event(SUNDAY + 900, 2, 11, 0, "Duo", "Tune", 999.0, first="Bob"),
    event(SUNDAY + 2000, 2, 11, 1, "Nobody", "Silence", 1.0, first="Rob"),
    event(SUNDAY + 3000, 2, 11, 2, "Band", "Tune", 200.5, page="Home", first="Bob"),
    event(YEAR_END, 3, 12, 0, "Band", "Tune", 200.9, first="Cy"),
    event(YEAR_END, 3, 12, 0, "Band", "Tune", 200.9, first="Cy"),
]


def songs_frame(spark):
    return spark.createDataFrame(SONGS, STAGING_SONGS)


def events_frame(spark):
    return spark.createDataFrame(EVENTS, STAGING_EVENTS)
