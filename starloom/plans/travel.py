"""The travel lake: airports, demographics, code lists and the immigration fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.calendar import from_sas_date
from starloom.functions.text import split_part
from starloom.operators.ids import surrogate_id
from starloom.schemas import AIRPORTS, IMMIGRATION_NAMES
from starloom.sources.labels import LabelBlock, parse_labels


def build_airports(airports: DataFrame, coordinate_order: str = "latitude_first", country: str = "US") -> DataFrame:
    """Distinct airports of one country, coordinates and region split into columns.

    The first coordinate is taken as the latitude; ``longitude_first`` swaps the two.
    """
    first, second = ("latitude", "longitude") if coordinate_order == "latitude_first" else ("longitude", "latitude")
    return (
        airports.distinct()
        .filter(F.col("iso_country") == country)
        .withColumns({
            first: split_part(F.col("coordinates"), ",", 0, "double"),
            second: split_part(F.col("coordinates"), ",", 1, "double"),
            "state_code": split_part(F.col("iso_region"), "-", 1),
        })
        .select(*AIRPORTS)
        .dropna(subset=["airport_id"])
    )


def build_demographics(demographics: DataFrame, dense: bool = False) -> DataFrame:
    """Distinct rows with a generated ``demographic_id``."""
    return surrogate_id(demographics.distinct(), "demographic_id", dense=dense, order=["state", "city"], shuffled=True)


def build_labels(lines: DataFrame, block: LabelBlock, tidy: bool = False) -> DataFrame:
    """One code list; rows without a code are dropped.

    Country codes become integers, as the fact stores them; codes that are no number are null.
    """
    labels = parse_labels(lines, block, tidy)
    if block.code == "country_code":
        labels = labels.withColumn("country_code", F.col("country_code").try_cast("int"))
    return labels.dropna(subset=[block.code])


def build_immigration(source: DataFrame, dense: bool = False, dates: bool = False) -> DataFrame:
    """The immigration fact: renamed columns, integer keys and a generated ``immigrant_id``.

    Year and month become integers, so partition directories read ``year=2016``. ``dates``
    turns the numeric arrival and departure days into dates.
    """
    fact = source.select([F.col(a).alias(b) for a, b in IMMIGRATION_NAMES.items()])
    integers = ["cic_id", "citizen_country", "residence_country", "year", "month"]
    fact = fact.withColumns({c: F.col(c).cast("int") for c in integers})
    if dates:
        fact = fact.withColumns({c: from_sas_date(F.col(c)) for c in ("arrival_date", "departure_date")})
    return surrogate_id(fact, "immigrant_id", dense=dense, order=["cic_id"])
