from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import schemas
from starloom.plans import reports, travel
from starloom.sources.files import read_csv


def write(path, text):
    path.write_text(text)
    return str(path)


def test_airports(spark, tmp_path):
    path = write(tmp_path / "a.csv", "\n".join([
        "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates",
        '00A,heliport,Total Rf,11,NA,US,US-PA,Bensalem,00A,,00A,"-74.9, 40.07"',
        '00A,heliport,Total Rf,11,NA,US,US-PA,Bensalem,00A,,00A,"-74.9, 40.07"',
        '00B,heliport,No region,,NA,US,PA,,,,,"-1.5"',
        ",heliport,No id,5,NA,US,US-PA,,,,,",
        'CA1,heliport,Abroad,5,NA,CA,CA-ON,,,,,"1, 2"']) + "\n")
    source = read_csv(spark, path, schemas.AIRPORTS_CSV)
    airports = travel.build_airports(source)
    assert airports.columns == list(schemas.AIRPORTS)
    assert rows(airports, "airport_id", "elevation_ft", "state_code", "latitude", "longitude") == [
        ("00A", 11, "PA", -74.9, 40.07), ("00B", None, None, -1.5, None)]
    swapped = travel.build_airports(source, "longitude_first").filter("airport_id = '00A'").first()
    assert (swapped["latitude"], swapped["longitude"]) == (40.07, -74.9)
    assert dict(airports.dtypes)["state_code"] == "string"


def test_demographics(spark, tmp_path):
    header = "City;State;Median Age;Male;Female;Total;Veterans;Foreign;Household;Code;Race;Count"
    path = write(tmp_path / "d.csv", "\n".join([
        header, "Quincy;MA;41.0;1;2;3;4;5;2.39;MA;White;58723", "Quincy;MA;41.0;1;2;3;4;5;2.39;MA;White;58723",
        "Quincy;MA;41.0;1;2;3;4;5;2.39;MA;Asian;100", "Hoover;AL;38.5;;;84839;4819;8229;2.58;AL;Asian;4759"]) + "\n")
    built = travel.build_demographics(read_csv(spark, path, schemas.DEMOGRAPHICS_CSV, ";"), dense=True)
    assert rows(built, "demographic_id", "city", "race", "male_population") == [
        (0, "Hoover", "Asian", None), (1, "Quincy", "Asian", 1), (2, "Quincy", "White", 1)]
    assert built.columns == [*schemas.DEMOGRAPHICS_CSV.fieldNames(), "demographic_id"]


@pytest.fixture(scope="module")
def immigration(spark):
    def row(cic, cit, res, gender, dep=20550.0):
        values = dict.fromkeys(schemas.IMMIGRATION_SOURCE.fieldNames())
        values |= dict(cicid=cic, i94yr=2016.0, i94mon=4.0, i94cit=cit, i94res=res, gender=gender, arrdate=20545.0, depdate=dep)
        return tuple(values.values())

    return spark.createDataFrame(
        [row(6.0, 689.0, 689.0, "M"), row(7.0, 689.0, 101.0, None, None), row(4.0, 101.0, 999.0, "F"), row(5.0, 689.0, None, "M")],
        schemas.IMMIGRATION_SOURCE)


@pytest.fixture(scope="module")
def countries(spark):
    return spark.createDataFrame([(689, "BRAZIL"), (101, "ALBANIA")], "country_code int, country string")


def test_immigration(immigration):
    fact = travel.build_immigration(immigration, dense=True, dates=True)
    assert len(fact.columns) == 22 and fact.columns[-1] == "immigrant_id"
    first = fact.orderBy("immigrant_id").first()
    assert (first["cic_id"], first["year"], first["month"], first["citizen_country"]) == (4, 2016, 4, 101)
    assert first["arrival_date"] == date(2016, 4, 1)
    assert fact.filter("departure_date IS NULL").count() == 1
    assert travel.build_immigration(immigration).first()["arrival_date"] == 20545.0


def test_partition_directories_are_whole_years(spark, immigration, tmp_path):
    travel.build_immigration(immigration).write.partitionBy("year", "month").parquet(str(tmp_path / "i"))
    assert (tmp_path / "i" / "year=2016" / "month=4").is_dir()


def test_immigrants_with_countries(immigration, countries):
    result = reports.immigrants_with_countries(travel.build_immigration(immigration), countries)
    assert [tuple(r) for r in result.collect()] == [
        (4, "F", "ALBANIA", None), (5, "M", "BRAZIL", None), (6, "M", "BRAZIL", "BRAZIL"), (7, None, "BRAZIL", "ALBANIA")]


def test_gender_distribution(immigration, countries):
    result = reports.gender_distribution(travel.build_immigration(immigration), countries, "BRAZIL")
    assert rows(result) == [(1, None), (2, "M")]
    doubled = reports.gender_distribution(travel.build_immigration(immigration), countries.union(countries), "BRAZIL")
    assert rows(doubled) == [(2, None), (4, "M")]  # as a plain join would count


def test_popularity_reports(spark):
    plays = spark.createDataFrame([("A1", 1), ("A1", 2), ("A2", 1), (None, 3), ("A3", 1)], "artist_id string, user_id int")
    artists = spark.createDataFrame([("A1", "One"), ("A1", "Uno"), ("A2", "Two"), ("A3", "Two")], "artist_id string, name string")
    users = spark.createDataFrame([(1, "Ann"), (2, "Ann"), (3, "Bo"), (3, "Bo")], "user_id int, first_name string")
    assert [tuple(r) for r in reports.popular_artists(plays, artists).collect()] == [("One", 2), ("Two", 2), ("Uno", 2)]
    assert [tuple(r) for r in reports.popular_artists(plays, artists, 1, True).collect()] == [("One", 2)]
    assert [tuple(r) for r in reports.active_users(plays, 2).collect()] == [(1, 3), (2, 1)]
    assert [tuple(r) for r in reports.active_first_names(plays, users).collect()] == [("Ann", 4), ("Bo", 2)]
    joined = plays.join(artists, "artist_id").groupBy("name").agg(F.count("*").alias("popularity"))
    assert rows(joined) == rows(reports.popular_artists(plays, artists))
