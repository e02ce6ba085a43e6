"""Scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


#: JSON files, also compressed ones.
JSON_FILES = "*.json{,.gz,.bz2,.deflate,.lz4,.snappy}"


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, name_glob: str = JSON_FILES,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """JSON lines of one path, a glob, or a whole directory tree.

    With ``mode="FAILFAST"`` a line that is no JSON object fails the read; else it becomes nulls.
    """
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .option("mode", mode)
        .json(path)
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    separator: str = ",",
    multiline: bool = False,
    escape: str = '"',
) -> DataFrame:
    """CSV with a header row; the schema is bound by position.

    A quote inside quotes is doubled, as ``loads.write_csv`` writes it, unless ``escape`` says otherwise.
    ``multiline`` allows quoted line breaks, but then a file cannot be split: use it only for
    directories of many moderate files.
    """
    return spark.read.csv(
        path, schema=schema, header=True, sep=separator, multiLine=multiline,
        escape=escape, recursiveFileLookup=True, enforceSchema=True,
    )


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Any installed data source, by name."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def register_views(spark: SparkSession, root: str, names: Iterable[str]) -> None:
    """One temp view per Parquet table below ``root``.

    Reads the table roots, not globs of their files, so partition columns stay and prune.
    """
    for name in names:
        spark.read.parquet(f"{root.rstrip('/')}/{name}").createOrReplaceTempView(name)


def rows_from_mapping(
    spark: SparkSession, pairs: Mapping[str, str], names: tuple[str, str],
) -> DataFrame:
    """A two-column table from a small in-memory mapping."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame(list(pairs.items()), schema)


def first_per_file(df: DataFrame) -> DataFrame:
    """The first record of each file a scan reads.

    ``df`` must be a file scan. Within a file the split offset, then the row's place in its
    split, give the file order; every task keeps one row per file before the shuffle.
    """
    place = F.struct(
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    return (
        df.select(
            F.col("_metadata.file_path").alias("_file"),
            F.struct(place.alias("place"), *df.columns).alias("_row"),
        )
        .groupBy("_file")
        .agg(F.min("_row").alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def load_report(df: DataFrame) -> DataFrame:
    """Rows read per source file; ``df`` must be a file scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("row_count"))
