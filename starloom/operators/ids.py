"""Surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starloom.session import materialize


def surrogate_id(
    df: DataFrame, name: str, dense: bool = False, order: Sequence[str] = (), start: int = 0,
    shuffled: bool = False,
) -> DataFrame:
    """Add a unique long id.

    The default ids are unique but have gaps and follow the plan's partitions; write the frame
    before using them twice. Say ``shuffled`` when the rows come out of a shuffle: a task that
    runs again may see them in another order, so they are sorted within their partition first
    and get the same ids again. ``dense=True`` numbers the rows without gaps in the order of
    ``order`` (remaining columns break ties), so the ids depend on the data alone.
    """
    if not dense:
        df = df.sortWithinPartitions(*df.columns) if shuffled else df
        return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))
    return _dense_id(df, name, order, start)


def _dense_id(df: DataFrame, name: str, order: Sequence[str], start: int) -> DataFrame:
    """Range-sort, number within each range, then add the sizes of the ranges before it.

    The sorted rows are written once, so both readers see the same ranges. The offsets have one
    row per shuffle partition, hence the broadcast. Ranges are cut on all columns, so equal
    values of a leading column do not end up in one range.
    """
    ordering = [*order, *[c for c in df.columns if c not in order]]
    place = F.monotonically_increasing_id()
    ranges = materialize(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .select("*", F.shiftright(place, 33).alias("_range"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")),
        "ranges",
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range").agg(F.count("*").alias("n"))
        .select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_skip"))
    )
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_place") + F.col("_skip") + F.lit(start))
        .select(*df.columns, name)
    )
