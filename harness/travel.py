"""Airports, demographics, immigration and the reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harness.registry import query
from harness.tables import ARRIVALS, arrivals, countries, read
from starloom.functions import codes
from starloom.functions.calendar import from_sas_date
from starloom.plans import reports, travel


@query("airports_like", """SELECT DISTINCT c_name AS airport_id, c_mktsegment AS type, 'Field ' || c_custkey AS name,
       CAST(c_acctbal AS INTEGER) AS elevation_ft, 'NA' AS continent, 'US' AS iso_country,
       CAST(c_nationkey AS VARCHAR) AS state_code, c_mktsegment AS municipality, c_name AS gps_code,
       c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude
FROM customer WHERE c_nationkey < 13""")
def airports_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    rows = customer.unionAll(customer).select(
        F.col("c_name").alias("airport_id"),
        F.col("c_mktsegment").alias("type"),
        F.concat(F.lit("Field "), "c_custkey").alias("name"),
        F.bround("c_acctbal").cast("int").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(F.col("c_nationkey") < 13, "US").otherwise("XX").alias("iso_country"),
        F.concat(F.lit("US-"), "c_nationkey").alias("iso_region"),
        F.col("c_mktsegment").alias("municipality"),
        F.col("c_name").alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        F.lit(None).cast("string").alias("local_code"),
        F.concat(F.col("c_acctbal").cast("decimal(18,2)"), F.lit(", "), "c_nationkey").alias("coordinates"),
    )
    return travel.build_airports(rows)


@query("demographics_like", """WITH rows AS (
  SELECT DISTINCT p_name AS city, p_type AS state, p_retailprice AS median_age, p_size AS male_population,
         p_brand AS state_code FROM part)
SELECT *, row_number() OVER (ORDER BY state, city, median_age, male_population, state_code) - 1 AS demographic_id FROM rows""")
def demographics_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(
        F.col("p_name").alias("city"), F.col("p_type").alias("state"), F.col("p_retailprice").alias("median_age"),
        F.col("p_size").alias("male_population"), F.col("p_brand").alias("state_code"))
    return travel.build_demographics(rows, dense=True)


@query("immigration_like", f"""WITH {ARRIVALS}
SELECT row_number() OVER (ORDER BY cic_id) - 1 AS immigrant_id, cic_id, year, month, citizen_country,
       residence_country, city_code, CAST(days AS DOUBLE) AS arrival_date, CAST(priority AS DOUBLE) AS mode,
       CAST(days + priority AS DOUBLE) AS departure_date, gender, admin_num
FROM arrivals""")
def immigration_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travel.build_immigration(arrivals(spark, sf_dir), dense=True).select(
        "immigrant_id", "cic_id", "year", "month", "citizen_country", "residence_country", "city_code",
        "arrival_date", "mode", "departure_date", "gender", "admin_num")


@query("sas_date", f"""WITH {ARRIVALS}
SELECT cic_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS arrival_date,
       CAST(CAST(o_orderdate AS DATE) + priority AS VARCHAR) AS departure_date FROM arrivals""")
def sas_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals(spark, sf_dir).select(
        F.col("cicid").cast("int").alias("cic_id"),
        from_sas_date(F.col("arrdate")).cast("string").alias("arrival_date"),
        from_sas_date(F.col("depdate")).cast("string").alias("departure_date"))


@query("mode_labels", f"""WITH {ARRIVALS}
SELECT cic_id, CASE priority WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' WHEN 9 THEN 'Not reported' END AS mode,
       CASE priority WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa FROM arrivals""")
def mode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals(spark, sf_dir).select(
        F.col("cicid").cast("int").alias("cic_id"),
        codes.label(F.col("i94mode"), codes.TRAVEL_MODES).alias("mode"),
        codes.label(F.col("i94visa"), codes.VISA_CLASSES).alias("visa"))


def _immigration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travel.build_immigration(arrivals(spark, sf_dir))


@query("two_countries", f"""WITH {ARRIVALS}
SELECT cic_id, gender, c1.n_name AS citizen_country, c2.n_name AS residence_country
FROM arrivals a LEFT JOIN nation c1 ON a.citizen_country = c1.n_nationkey
LEFT JOIN nation c2 ON a.residence_country = c2.n_nationkey ORDER BY cic_id""")
def two_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.immigrants_with_countries(_immigration(spark, sf_dir), countries(spark, sf_dir))


@query("gender_distribution", f"""WITH {ARRIVALS}
SELECT count(a.cic_id) AS immigrants, a.gender FROM arrivals a LEFT JOIN nation c ON a.citizen_country = c.n_nationkey
WHERE c.n_name = 'NATION_7' GROUP BY a.gender""")
def gender_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.gender_distribution(_immigration(spark, sf_dir), countries(spark, sf_dir), "NATION_7")
