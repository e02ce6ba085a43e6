"""Loads that take effect together, rewrites by part, statistics of loads, sources that are parsed once per change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harness.registry import query
from harness.tables import read, scratch_database
from starloom.operators import conflicts
from starloom.operators.releases import Layout, Releases
from starloom.schemas import DOUBLE, LONG, STRING, TIMESTAMP, table
from starloom.session import scratch_path
from starloom.sources import files, labels
from starloom.sources.catalogue import stage_changed

_PARTS = table(l_partkey=LONG, l_suppkey=LONG, l_quantity=DOUBLE)
_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]
_CUT = "l_shipdate < timestamp_ntz '1998-01-01 00:00:00'"
_CUT_SQL = "l_shipdate < timestamp '1998-01-01'"


@query("upsert_parts", """SELECT l_partkey,
  arg_min(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity)) AS l_suppkey,
  arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_quantity, l_suppkey)) AS l_quantity
FROM lineitem GROUP BY l_partkey""")
def upsert_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches are merged into a table that is kept in parts by its key; each rewrites the parts it touches."""
    lines = read(spark, sf_dir, "lineitem").select(*_PARTS.fieldNames(), *_ORDER[1:], "l_shipdate")
    releases = Releases(spark, scratch_database(spark), {"parts": _PARTS}, {"parts": Layout(part_by=("l_partkey",), parts=8)})
    late = lines.filter(f"NOT ({_CUT})")
    for batch in (lines.filter(_CUT), late.filter("l_partkey < 4"), late.filter("l_partkey >= 4")):
        with releases.load() as load:
            parts = releases.touched("parts", batch)
            stored = releases.rows_of_parts("parts", parts)
            load.write("parts", conflicts.upsert_columns(batch, stored, ["l_partkey"], _ORDER, ["l_quantity"]).select(*_PARTS.fieldNames()), parts=parts)
            load.publish()
    return releases.table("parts")


@query("load_broken_off", f"""SELECT 'lines' AS table_name, count(*) AS row_count, sum(l_orderkey) AS keys FROM lineitem WHERE {_CUT_SQL}
UNION ALL SELECT 'orders', count(*), sum(o_orderkey) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {_CUT_SQL})""")
def load_broken_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load writes all lines and then breaks off: both tables are as the first load has left them."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    kinds = {"lines": table(l_orderkey=LONG, l_shipdate=TIMESTAMP), "orders": table(o_orderkey=LONG)}
    releases = Releases(spark, scratch_database(spark), kinds)

    def run(batch: DataFrame, breaks: bool) -> None:
        with releases.load() as load:
            load.write("lines", batch.select("l_orderkey", "l_shipdate"))
            if breaks:
                raise InterruptedError
            load.write("orders", orders.join(batch.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi").select("o_orderkey"))
            load.publish()

    run(lines.filter(_CUT), breaks=False)
    try:
        run(lines, breaks=True)
    except InterruptedError:
        pass
    counted = lambda t, key: releases.table(t).agg(F.count("*").alias("row_count"), F.sum(key).alias("keys")).select(F.lit(t).alias("table_name"), "*")
    return counted("lines", "l_orderkey").unionByName(counted("orders", "o_orderkey"))


_MEASURED = {"l_partkey": LONG, "l_quantity": DOUBLE, "l_shipdate": TIMESTAMP, "l_returnflag": STRING}


@query("load_statistics", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, "
    + ("CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high" if kind == STRING else
       "epoch_us(min({0})) / 1000000::DOUBLE AS low, epoch_us(max({0})) / 1000000::DOUBLE AS high".format(c) if kind == TIMESTAMP else
       f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high")
    + f", true AS distinct_close, {'CAST(NULL AS BOOLEAN)' if kind == STRING else 'true'} AS median_close FROM lineitem"
    for c, kind in _MEASURED.items()))
def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics merged from the sketches of two loads; estimates are held against exact values.

    Distinct counts are within 4 % (five standard errors), the median's rank within 2 % of the rows.
    """
    lines = read(spark, sf_dir, "lineitem").select(*_MEASURED)
    releases = Releases(spark, scratch_database(spark), {"lines": table(**_MEASURED)}, {"lines": Layout(statistics=tuple(_MEASURED))})
    for batch in (lines.filter(_CUT), lines.filter(f"NOT ({_CUT})")):
        with releases.load() as load:
            load.write("lines", batch)
            load.publish()
    found = releases.statistics("lines")
    medians = {r["column_name"]: r["quantiles"][1] for r in found.collect() if r["quantiles"]}  # a row per column

    def number(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp")) / F.lit(1e6) if c == "l_shipdate" else F.col(c).cast("double")

    exact = lines.agg(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.count_distinct(c).alias("distinct"),
        (F.avg((number(c) < medians[c]).cast("double")) if c in medians else F.lit(None).cast("double")).alias("below"),
        (F.avg((number(c) <= medians[c]).cast("double")) if c in medians else F.lit(None).cast("double")).alias("upto"),
    ) for c in _MEASURED]).alias("all")).select(F.inline("all"))
    return found.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "low", "high",
        (F.abs(F.col("distinct_values") - F.col("distinct")) <= 0.04 * F.col("distinct")).alias("distinct_close"),
        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_close"))


@query("append_pruned", """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem WHERE l_shipdate >= timestamp '1998-01-01'
AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')""")
def append_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a batch whose order is not stored; stored orders are tested by a filter of the batch's keys before they shuffle."""
    stored = read(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    batch = read(spark, sf_dir, "lineitem").filter(f"NOT ({_CUT})").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("l_shipdate"))
    return conflicts.append_new(batch, stored, ["l_orderkey"], prune=True)


_ORDERS = table(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=STRING)


@query("changed_files", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'again' ELSE o_orderstatus END AS o_orderstatus,
       CAST(1 AS BIGINT) AS folders_parsed FROM orders WHERE o_orderstatus <> 'F'""")
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of JSON files is parsed; then one of its folders goes and another is written anew: only that is parsed."""
    source, kept = scratch_path(spark, "changing"), scratch_path(spark, "kept")
    orders = read(spark, sf_dir, "orders").select(*_ORDERS.fieldNames())
    for status in "FOP":
        orders.filter(F.col("o_orderstatus") == status).write.json(f"{source}/{status}")
    stage_changed(spark, source, kept, _ORDERS)
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/F")
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
    again = orders.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("again"))
    again.write.mode("overwrite").json(f"{source}/P")
    rows, staged = stage_changed(spark, source, kept, _ORDERS)
    parsed = staged.rows.agg(F.count_distinct("o_orderstatus")).first()[0]
    return rows.withColumn("folders_parsed", F.lit(parsed).cast("long"))


# --- small tables and label text ------------------------------------------------------------
_STATUS = {"F": "filled", "O": "open"}


@query("local_rows", """SELECT s.meaning, count(*) AS orders FROM orders LEFT JOIN (VALUES ('F', 'filled'), ('O', 'open')) AS s(status, meaning)
ON o_orderstatus = s.status GROUP BY s.meaning""")
def local_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the meaning of their status, which stands in a mapping of the program."""
    meanings = files.rows_from_mapping(spark, _STATUS, ("o_orderstatus", "meaning"))
    return read(spark, sf_dir, "orders").join(meanings, "o_orderstatus", "left").groupBy("meaning").agg(F.count("*").alias("orders"))


@query("labels_without_pair", """WITH numbered AS (
  SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS line, count(*) OVER () AS total FROM customer)
SELECT CASE WHEN line < total // 2 THEN 'country' ELSE 'state' END AS label, count(*) AS lines FROM numbered WHERE c_custkey % 7 = 0 GROUP BY 1""")
def labels_without_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a label file that hold no pair, by code list."""
    path = scratch_path(spark, "labels")
    customer = read(spark, sf_dir, "customer")
    line = F.when(F.col("c_custkey") % 7 == 0, F.lit("* a remark")).otherwise(F.concat("c_custkey", F.lit(" = '"), "c_name", F.lit("'")))
    customer.orderBy("c_custkey").select(line.alias("value")).write.text(path)
    total = customer.count()
    rules = (labels.COUNTRIES, labels.STATES)
    ends = (0, total // 2, total)
    blocks = [labels.LabelBlock(r.code, r.label, ends[i], ends[i + 1], r.code_trim, r.label_trim) for i, r in enumerate(rules)]
    return labels.lines_without_pair(labels.numbered_lines(spark, path, per_file=False), blocks)
