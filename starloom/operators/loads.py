"""Writing frames: Parquet and CSV files, table layouts and load modes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from starloom.operators.conflicts import append_new as rows_not_stored
from starloom.session import materialize


def _writer(
    df: DataFrame, partition_by: Sequence[str], mode: str, files: int | None, sort_by: Sequence[str],
) -> DataFrameWriter:
    """Rows are rebalanced on the partition columns: a directory gets few files, and a directory
    that holds much of the data is still written by many tasks."""
    if files is not None:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    files: int | None = None,
    sort_by: Sequence[str] = (),
    refresh_partitions: bool = False,
    lookup: Sequence[str] = (),
) -> None:
    """Write Parquet, in directories by ``partition_by``.

    ``files`` asks for that many files and is meant for small dimensions. ``sort_by`` orders the
    rows of each file, so that lookups on those columns skip row groups. ``refresh_partitions``
    replaces only the directories that occur in ``df``. ``lookup`` columns get Bloom filters: a
    lookup of a value skips the row groups that do not hold it, also where the rows are not in its order.
    """
    writer = _writer(df, partition_by, mode, files, sort_by)
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if refresh_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_json(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
) -> None:
    """JSON lines, in directories by ``partition_by``."""
    _writer(df, partition_by, mode, None, ()).json(path)


def write_csv(
    df: DataFrame, path: str, separator: str = ",", mode: str = "overwrite", compression: str | None = None,
) -> None:
    """CSV with a header and every field in quotes.

    ``compression`` is a codec of Spark's, such as ``gzip``; a gzip file is read by one task, so it suits frames of many partitions.
    """
    df.write.mode(mode).csv(path, header=True, quoteAll=True, sep=separator, escape='"', compression=compression)


def cluster_by(df: DataFrame, partition_key: Sequence[str], clustering: Sequence[str] = ()) -> DataFrame:
    """Lay rows out by partition key, in clustering order within it.

    Range partitioning on both keeps neighbours together and splits a large partition key over
    several tasks; the narrow value ranges let a lookup by key skip files and row groups.
    """
    return df.repartitionByRange(*partition_key, *clustering).sortWithinPartitions(*partition_key, *clustering)


def save_bucketed(
    df: DataFrame, table: str, buckets: int, key: Sequence[str], sort: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """A table bucketed on its join key, so that joins on it need no shuffle.

    The rows are dealt out by bucket first, so a load writes one file a bucket.
    """
    writer = df.repartition(buckets, *key).write.mode(mode).bucketBy(buckets, *key)
    (writer.sortBy(*sort) if sort else writer).saveAsTable(table)


# --- declared tables ------------------------------------------------------------------------
def create_tables(
    spark: SparkSession, database: str, schemas: Mapping[str, T.StructType], location: str | None = None,
) -> None:
    """Create the database and every table that does not exist yet, in the given order."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, schema in schemas.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.`{name}` ({columns}) USING parquet")


def drop_tables(spark: SparkSession, database: str, names: Sequence[str]) -> None:
    """Drop tables if they exist, dependants (later names) first."""
    for name in reversed(list(names)):
        spark.sql(f"DROP TABLE IF EXISTS {database}.`{name}`")


def refresh_statistics(spark: SparkSession, table: str, columns: bool = True) -> None:
    """Statistics for the optimizer, after a load.

    Column statistics read the whole table; ``columns=False`` only updates its size, which is
    enough for a fact that grows with every run.
    """
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {'FOR ALL COLUMNS' if columns else 'NOSCAN'}")


def _fit(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``df``, by position, as the table's columns."""
    target = df.sparkSession.table(table).schema
    if len(target) != len(df.columns):
        raise ValueError(f"{table} has {len(target)} columns, the rows have {len(df.columns)}")
    return df.select([F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(df.columns, target)])


def append(df: DataFrame, table: str) -> None:
    """Append by position; a rerun appends the rows again."""
    _fit(df, table).write.insertInto(table)


def stored_within(df: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """The stored rows within the range of ``column`` in ``df``; the range is pushed to the scan.

    The bounds travel as text, so that no clock or zone of this machine takes part.
    """
    low, high = df.agg(F.min(column).cast("string"), F.max(column).cast("string")).first()
    kind = stored.schema[column].dataType
    return stored.filter(F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def new_rows(df: DataFrame, table: str, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """The rows, fitted to the table, whose key the table does not hold yet.

    ``within`` names a column that the key determines, such as an event time. Stored rows
    outside the batch's range of that column cannot share a key with it and are not read, so
    the cost follows the batch, not the table.
    """
    fitted, stored = _fit(df, table), df.sparkSession.table(table)
    return rows_not_stored(fitted, stored if within is None else stored_within(fitted, stored, within), keys)


def append_new(df: DataFrame, table: str, keys: Sequence[str], within: str | None = None) -> None:
    """Append the rows whose key the table does not hold yet; a rerun adds nothing."""
    new_rows(df, table, keys, within).write.insertInto(table)


def insert_columns(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Insert into the named columns; columns that are not named become null."""
    target = df.sparkSession.table(table).schema
    given = dict(zip(columns, df.columns))
    unknown = set(columns) - set(target.fieldNames())
    if unknown or len(given) != len(columns) or len(columns) != len(df.columns):
        raise ValueError(f"column list {list(columns)} does not fit {table}")
    df.select([
        (F.col(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target
    ]).write.insertInto(table)


def restage(df: DataFrame, table: str) -> None:
    """Replace the contents of a staging table."""
    _fit(df, table).write.insertInto(table, overwrite=True)


def load_dimension(df: DataFrame, table: str, mode: str = "append-only") -> None:
    """Load a dimension: ``append-only`` adds the rows, ``delete-load`` replaces the table."""
    if mode == "append-only":
        append(df, table)
    elif mode == "delete-load":
        restage(df, table)
    else:
        raise ValueError(f"unknown load mode {mode!r}")


def replace_contents(df: DataFrame, table: str) -> None:
    """Replace a table by rows computed from it.

    The rows are written to the scratch folder first: a table cannot be overwritten while it is
    being read, and a failure before the swap leaves it untouched.
    """
    restage(materialize(_fit(df, table), "replace"), table)


def gated_write(df: DataFrame, checks: Sequence[Callable[[DataFrame], object]], write: Callable[[DataFrame], None]) -> None:
    """Compute the rows once, run the checks, each of which raises on failure, then write."""
    df = materialize(df, "gated")
    for check in checks:
        check(df)
    write(df)
