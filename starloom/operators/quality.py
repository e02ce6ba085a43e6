"""Data-quality checks."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Comparison names a check may use; they work on values and on Columns alike.
COMPARISONS = {
    "=": operator.eq, "!=": operator.ne, ">": operator.gt, "<": operator.lt,
    "<=": operator.le, ">=": operator.ge,
}


class QualityError(ValueError):
    """A data-quality check did not pass."""


def compare(left: Column, comparison: str, right: Column) -> Column:
    return COMPARISONS[comparison](left, right)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of rows and of distinct keys; null counts as a key value.

    A single pass over the key columns: rows are counted per key before the shuffle.
    """
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("key_count"))
    )


def check_not_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise QualityError("the table is empty")


def check_unique(df: DataFrame, keys: str | Sequence[str]) -> None:
    keys = [keys] if isinstance(keys, str) else list(keys)
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1)
    if not repeated.isEmpty():
        raise QualityError(f"the key {keys} is not unique")


def data_quality_check(df: DataFrame, primary_key: str | Sequence[str]) -> bool:
    """The table has rows and its key is unique, both from one job."""
    keys = [primary_key] if isinstance(primary_key, str) else list(primary_key)
    found = key_counts(df, keys).first()
    if found["row_count"] == 0:
        raise QualityError("the table is empty")
    if found["row_count"] > found["key_count"]:
        raise QualityError(f"the key {keys} is not unique")
    return True


CHECK_RESULT = T.StructType([
    T.StructField("check_sql", T.StringType()),
    T.StructField("comparison", T.StringType()),
    T.StructField("expected_result", T.StringType()),
    T.StructField("actual_result", T.StringType()),
    T.StructField("passed", T.BooleanType()),
])


def run_sql_checks(spark: SparkSession, checks: Sequence[Mapping], stop: bool = True) -> DataFrame:
    """Compare the first cell of each check's result with the expected value.

    Stops with an error at the first failure unless ``stop`` is false; returns one row per check.
    """
    results = []
    for check in checks:
        first = spark.sql(check["check_sql"]).first()
        actual = first[0] if first is not None else None
        passed = actual is not None and COMPARISONS[check["comparison"]](actual, check["expected_result"])
        results.append((check["check_sql"], check["comparison"], str(check["expected_result"]), str(actual), passed))
        if stop and not passed:
            raise QualityError(
                f"{check['check_sql']}: {actual} is not {check['comparison']} {check['expected_result']}")
    return spark.createDataFrame(results, CHECK_RESULT)


def not_empty_checks(tables: Sequence[str]) -> list[dict]:
    return [
        {"check_sql": f"SELECT count(*) FROM {t}", "comparison": ">", "expected_result": 0}
        for t in tables
    ]


def orphans(fact: DataFrame, foreign_key: str, dim: DataFrame, key: str) -> DataFrame:
    """Values of ``foreign_key`` that ``dim`` does not hold, with their row counts; null is allowed.

    Both sides are reduced to one row per value before they meet.
    """
    used = fact.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("value")).agg(F.count("*").alias("n"))
    return used.join(dim.select(F.col(key).alias("value")).distinct(), "value", "left_anti")


VIOLATIONS = "table_name string, constraint string, violations long"


def row_counters(rules: Mapping) -> dict[str, Column]:
    """An aggregate per NOT NULL and length limit of ``rules``, by the constraint's name: how many rows break it."""
    counters = {f"not null {c}": F.count_if(F.col(c).isNull()) for c in rules.get("not_null", ())}
    return counters | {f"length {c}": F.count_if(F.length(c) > limit) for c, limit in (rules.get("lengths") or {}).items()}


def check_constraints(
    df: DataFrame,
    not_null: Sequence[str] = (),
    primary_key: Sequence[str] = (),
    references: Mapping[str, tuple[DataFrame, str]] | None = None,
    lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Violations per declared constraint: (constraint, violations).

    NOT NULL and length limits come from one pass; the key and each foreign key take one more
    grouped pass over their own columns.
    """
    counters = row_counters({"not_null": not_null, "lengths": lengths})
    reports = []
    if counters:
        entries = [
            F.struct(F.lit(name).alias("constraint"), counter.alias("violations"))
            for name, counter in counters.items()
        ]
        reports.append(df.agg(F.array(*entries).alias("all")).select(F.inline("all")))
    if primary_key:
        reports.append(key_counts(df, primary_key).select(
            F.lit("primary key " + ", ".join(primary_key)).alias("constraint"),
            (F.col("row_count") - F.col("key_count")).alias("violations")))
    for column, (dim, key) in (references or {}).items():
        reports.append(orphans(df, column, dim, key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
                       .select(F.lit(f"foreign key {column}").alias("constraint"), "violations"))
    if not reports:
        raise ValueError("no constraint given")
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def check_declared(tables: Mapping[str, DataFrame], declared: Mapping[str, Mapping]) -> DataFrame:
    """Violations of every declared constraint of a set of tables: (table_name, constraint, violations).

    ``declared`` gives ``not_null``, ``primary_key``, ``lengths`` and ``references`` (column ->
    (table, key)) per table name, as ``schemas.CONSTRAINTS`` does.
    """
    report = None
    for name, rules in declared.items():
        references = {c: (tables[t], key) for c, (t, key) in rules.get("references", {}).items()}
        found = check_constraints(
            tables[name], rules.get("not_null", ()), rules.get("primary_key", ()), references, rules.get("lengths"),
        ).select(F.lit(name).alias("table_name"), "constraint", "violations")
        report = found if report is None else report.unionByName(found)
    if report is None:
        raise ValueError("no constraint given")
    return report


def enforce(report: DataFrame) -> None:
    """Raise if a constraint report shows a violation; the report has one row per constraint."""
    broken = report.filter("violations > 0").collect()
    if broken:
        raise QualityError("; ".join(f"{r['constraint']}: {r['violations']} rows" for r in broken))
