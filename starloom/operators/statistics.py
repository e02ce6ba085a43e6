"""Statistics that later loads add to: counts and sketches of columns, taken while the rows are written.

A sketch has a fixed size and sketches of several loads merge, so the statistics of a table of any size are read from a
few rows, and no load scans what is stored. Distinct values come from HyperLogLog sketches, quantiles from KLL sketches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

LG_REGISTERS = 14  # of a HyperLogLog sketch: 2 ** 14 registers, a standard error of 0.8 %
KLL_SIZE = 400  # a quantile's rank is off by less than 1 % with near certainty
SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType()), T.StructField("of_load", T.IntegerType()),
    T.StructField("row_count", T.LongType()), T.StructField("null_count", T.LongType()),
    T.StructField("distinct_sketch", T.BinaryType()), T.StructField("quantile_sketch", T.BinaryType()),
])
_NUMBERS = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _number(column: Column, kind: T.DataType) -> Column:
    """Numbers as doubles, dates in days and times in seconds since 1970."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")) / F.lit(1e6)
    return column.cast("double")


def counters(schema: T.StructType, columns: Iterable[str]) -> dict[str, Column]:
    """Aggregates of the columns, for ``DataFrame.observe`` or ``agg``; ``rows_of`` turns their values into rows."""
    found = {}
    for c in columns:
        kind = schema[c].dataType
        found[f"nulls {c}"] = F.count_if(F.col(c).isNull())
        found[f"distinct {c}"] = F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_REGISTERS))
        if isinstance(kind, _NUMBERS):
            found[f"quantiles {c}"] = F.kll_sketch_agg_double(_number(F.col(c), kind), F.lit(KLL_SIZE))
    return found


def rows_of(table: str, load: int, row_count: int, columns: Iterable[str], values: Mapping) -> list[tuple]:
    """Rows of ``SCHEMA`` from the values of ``counters``."""
    blob = lambda v: None if v is None else bytes(v)
    return [
        (table, c, load, row_count, values[f"nulls {c}"], blob(values[f"distinct {c}"]), blob(values.get(f"quantiles {c}")))
        for c in columns
    ]


def summary(statistics: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(table_name, column_name, row_count, null_count, distinct_values, low, high, quantiles) over all given rows.

    Counts, ``low`` and ``high`` are exact, the others estimates. Columns that are no numbers or times have no quantiles.
    """
    merged = statistics.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.kll_merge_agg_double("quantile_sketch").alias("sketch"))
    numbers = F.col("sketch").isNotNull() & (F.kll_sketch_get_n_double("sketch") > 0)
    at = lambda q: F.when(numbers, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
    return merged.select(
        "table_name", "column_name", "row_count", "null_count", "distinct_values", at(0).alias("low"), at(1).alias("high"),
        F.when(numbers, F.array(*[at(q) for q in quantiles])).alias("quantiles"))
