"""Key conflicts, load modes, ids, type coercion and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harness.registry import query
from harness.tables import read, scratch_database
from starloom.functions.coerce import conform, to_scale0
from starloom.functions.text import split_part
from starloom.operators import conflicts, loads, quality
from starloom.operators.ids import surrogate_id
from starloom.schemas import DOUBLE, INT, LONG, STRING, table
from starloom.session import scratch_path

_KEYS = ["l_orderkey", "l_linenumber"]
_CUT = "timestamp '1998-01-01'"


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Order lines, and their two batches: shipped before 1998 and from 1998 on."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    cut = F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))
    return lines, lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut)


_LINE_COLUMNS = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity"


# --- key conflicts --------------------------------------------------------------------------
@query("keep_last_line", f"""SELECT {_LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n FROM lineitem) WHERE n = 1""")
def keep_last_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflicts.last_write_wins(_lines(spark, sf_dir)[0], _KEYS, ["l_shipdate"])


@query("insert_if_absent", f"""SELECT {_LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) WHERE n = 1""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, old, new = _lines(spark, sf_dir)
    path = scratch_path(spark, "insert_if_absent")
    loads.write_parquet(conflicts.insert_if_absent(old, None, _KEYS, ["l_shipdate"]), path)
    stored = spark.read.schema(old.schema).parquet(path)
    loads.write_parquet(conflicts.insert_if_absent(new, stored, _KEYS, ["l_shipdate"]), path, mode="append")
    return spark.read.schema(old.schema).parquet(path)


@query("upsert_columns", """SELECT l_partkey,
  arg_min(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity)) AS l_suppkey,
  arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_quantity, l_suppkey)) AS l_quantity
FROM lineitem GROUP BY l_partkey""")
def upsert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, old, new = _lines(spark, sf_dir)
    order, update = ["l_shipdate", "l_orderkey", "l_linenumber"], ["l_quantity"]
    database = scratch_database(spark)
    loads.create_tables(spark, database, {"parts": table(l_partkey=LONG, l_suppkey=LONG, l_quantity=DOUBLE)})
    name = f"{database}.parts"
    loads.append(conflicts.upsert_columns(old, None, ["l_partkey"], order, update), name)
    loads.replace_contents(conflicts.upsert_columns(new, spark.table(name), ["l_partkey"], order, update), name)
    return spark.table(name)


@query("append_new", f"""SELECT {_LINE_COLUMNS} FROM lineitem WHERE l_shipdate < {_CUT}
UNION ALL SELECT {_LINE_COLUMNS} FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM lineitem o WHERE o.l_shipdate < {_CUT} AND o.l_orderkey = l.l_orderkey AND o.l_linenumber = l.l_linenumber)""")
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, old, _ = _lines(spark, sf_dir)
    database = scratch_database(spark)
    loads.create_tables(spark, database, {"lines": lines.schema})
    name = f"{database}.lines"
    loads.append(old, name)
    loads.append_new(lines, name, _KEYS)
    return spark.table(name)


# --- load modes -----------------------------------------------------------------------------
_CUSTOMER = table(custkey=LONG, name=STRING, nation=STRING)


@query("append_only", """SELECT c_custkey AS custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation
FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer)""")
def append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_twice(spark, sf_dir, "append-only")


@query("delete_load", "SELECT c_custkey AS custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def delete_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_twice(spark, sf_dir, "delete-load")


def _load_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Loaded by position; the integer nation key lands in a text column."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    database = scratch_database(spark)
    loads.create_tables(spark, database, {"customers": _CUSTOMER})
    for _ in range(2):
        loads.load_dimension(rows, f"{database}.customers", mode)
    loads.refresh_statistics(spark, f"{database}.customers")
    return spark.table(f"{database}.customers")


@query("insert_column_list", "SELECT c_custkey AS custkey, CAST(NULL AS VARCHAR) AS name, c_mktsegment AS nation FROM customer")
def insert_column_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    loads.create_tables(spark, database, {"customers": _CUSTOMER})
    rows = read(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey")
    loads.insert_columns(rows, f"{database}.customers", ["nation", "custkey"])
    return spark.table(f"{database}.customers")


@query("dynamic_overwrite", """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CASE WHEN year(o_orderdate) = 1997 THEN 'reloaded' ELSE o_orderstatus END AS status FROM orders""")
def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    path = scratch_path(spark, "orders")
    loads.write_parquet(orders, path, ["year", "month"])
    reloaded = orders.filter("year = 1997").withColumn("status", F.lit("reloaded"))
    loads.write_parquet(reloaded, path, ["year", "month"], refresh_partitions=True)
    return spark.read.schema(orders.schema).parquet(path)


@query("bucketed_join", """SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    loads.save_bucketed(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), f"{database}.orders", 8, ["o_custkey"], ["o_custkey"])
    loads.save_bucketed(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), f"{database}.customer", 8, ["c_custkey"], ["c_custkey"])
    orders = spark.table(f"{database}.orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    customer = spark.table(f"{database}.customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("n").alias("orders"))


# --- ids and types --------------------------------------------------------------------------
@query("surrogate_dense", "SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS order_id FROM orders")
def surrogate_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return surrogate_id(orders, "order_id", dense=True, order=["o_custkey", "o_orderdate"], start=1).select("o_orderkey", "order_id")


@query("surrogate_unique", "SELECT count(*) AS row_count, count(*) AS id_count FROM lineitem")
def surrogate_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = surrogate_id(read(spark, sf_dir, "lineitem").select("l_orderkey"), "line_id")
    return quality.key_counts(ids, ["line_id"]).withColumnRenamed("key_count", "id_count")


@query("scale0_round", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(18,0)) AS BIGINT) AS price FROM lineitem")
def scale0_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(*_KEYS, "l_partkey", to_scale0(F.col("l_extendedprice")).cast("long").alias("price"))


@query("scale0_trunc", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(l_extendedprice) AS BIGINT) AS price FROM lineitem")
def scale0_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(*_KEYS, "l_partkey", to_scale0(F.col("l_extendedprice"), "truncate").cast("long").alias("price"))


@query("split_part_cast", """SELECT c_custkey, split_part(c_name, '#', 1) AS kind, CAST(split_part(c_name, '#', 2) AS INTEGER) AS number,
       CAST(NULL AS VARCHAR) AS missing FROM customer""")
def split_part_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return read(spark, sf_dir, "customer").select(
        "c_custkey", split_part(name, "#", 0).alias("kind"), split_part(name, "#", 1, "int").alias("number"),
        split_part(name, "#", 2).alias("missing"))


@query("conform_by_position", "SELECT CAST(l_orderkey AS VARCHAR) AS a, l_linenumber AS b, CAST(l_quantity AS INTEGER) AS c FROM lineitem")
def conform_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select(*_KEYS, F.col("l_quantity").cast("int").cast("string").alias("quantity"))
    return conform(rows, table(a=STRING, b=INT, c=INT), by="position")


# --- quality --------------------------------------------------------------------------------
_CHECKED_KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
    "part": ["p_name", "p_brand"], "events": ["ts"], "conversations": ["conv_id", "turn"],
}


@query("dq_report", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {t})) AS key_count FROM {t}"
    for t, k in _CHECKED_KEYS.items()))
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [
        quality.key_counts(read(spark, sf_dir, t), k).select(F.lit(t).alias("table_name"), "row_count", "key_count")
        for t, k in _CHECKED_KEYS.items()
    ]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


@query("dq_constraints", """SELECT 'not null reported' AS "constraint", count(*) FILTER (l_returnflag = 'R') AS violations FROM lineitem
UNION ALL SELECT 'length l_linestatus', count(*) FILTER (length(l_linestatus) > 1) FROM lineitem
UNION ALL SELECT 'length instruction', count(*) FILTER (length(l_returnflag || l_linestatus || l_linenumber) > 2) FROM lineitem
UNION ALL SELECT 'primary key l_orderkey, l_linenumber', count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem
UNION ALL SELECT 'foreign key l_partkey', count(*) FROM lineitem WHERE NOT EXISTS (
  SELECT 1 FROM part WHERE p_partkey = CASE WHEN l_quantity > 40 THEN -l_partkey ELSE l_partkey END)
UNION ALL SELECT 'foreign key l_suppkey', count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)""")
def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").withColumns({
        "reported": F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")),
        "instruction": F.concat("l_returnflag", "l_linestatus", "l_linenumber"),
        "l_partkey": F.when(F.col("l_quantity") > 40, -F.col("l_partkey")).otherwise(F.col("l_partkey")),
    })
    return quality.check_constraints(
        lines, not_null=["reported"], primary_key=_KEYS,
        references={"l_partkey": (read(spark, sf_dir, "part"), "p_partkey"), "l_suppkey": (read(spark, sf_dir, "supplier"), "s_suppkey")},
        lengths={"l_linestatus": 1, "instruction": 2})


_SQL_CHECKS = (
    ("SELECT count(*) FROM checked_lines", ">", 0),
    ("SELECT count(*) FROM checked_lines", "=", 0),
    ("SELECT count(*) FROM checked_lines WHERE l_quantity < 0", "<=", 0),
    ("SELECT max(l_linenumber) FROM checked_lines", "<", 5),
    ("SELECT min(l_linenumber) FROM checked_lines", "!=", 1),
    ("SELECT min(l_linenumber) FROM checked_lines", ">=", 1),
)


@query("dq_sql_checks", " UNION ALL ".join(
    f"SELECT '{sql}' AS check_sql, '{op}' AS comparison, '{expected}' AS expected_result, "
    f"CAST(({sql.replace('checked_lines', 'lineitem')}) AS VARCHAR) AS actual_result, "
    f"CAST(({sql.replace('checked_lines', 'lineitem')}) {op} {expected} AS VARCHAR) AS passed"
    for sql, op, expected in _SQL_CHECKS))
def dq_sql_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("checked_lines")
    checks = [{"check_sql": s, "comparison": c, "expected_result": e} for s, c, e in _SQL_CHECKS]
    report = quality.run_sql_checks(spark, checks, stop=False)
    return report.withColumn("passed", F.col("passed").cast("string"))
