"""A text source that is parsed once: a ledger of its files tells which of them are new or have changed."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.session import materialize
from starloom.sources import staging

# More changed files than this are found by reading the whole tree, so that their list stays small on the driver.
LISTED = 10_000
_STATE = ["file", "modified", "size"]


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, modified, size) of every file below ``path``; contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"))


def _versions(spark: SparkSession, kept: str) -> Iterator[tuple[int, object, object]]:
    """(number, folder, file system) of the versions in ``kept``, complete or not."""
    root = spark._jvm.org.apache.hadoop.fs.Path(kept)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in (fs.listStatus(root) if fs.exists(root) else ()):
        found = re.fullmatch(r"version-(\d+)", status.getPath().getName())
        if found:
            yield int(found[1]), status.getPath(), fs


def stage_changed(
    spark: SparkSession, path: str, kept: str, schema: T.StructType, max_rejects: int | None = 0,
    rounding: str = "truncate", anew: bool = False,
) -> tuple[DataFrame, staging.Staged | None]:
    """The rows of all JSON files below ``path``, and what was staged for it: only files that are new or have changed.

    Parsed rows are kept in ``kept``, with the files they come from, as one version per change of the source: its rows
    first, the ledger of its files last, so a version without ledger does not count. A file counts as changed if its
    time or size differs; rows of changed and of deleted files go. Nothing has changed: nothing is parsed or written,
    and the second result is None. ``anew`` parses everything. Rejects are those of the files that were parsed; if there
    are more than ``max_rejects``, it is an error and the kept rows stay as they were.
    """
    versions = {n: (folder, fs) for n, folder, fs in _versions(spark, kept)}
    place = spark._jvm.org.apache.hadoop.fs.Path
    complete = [n for n, (folder, fs) in versions.items() if fs.exists(place(folder, "files/_SUCCESS"))]
    last, number = max(complete, default=0), max(versions, default=0) + 1
    stored_schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("row", schema)])
    files = materialize(_files(spark, path), "files")
    stored, changed, unchanged = None, None, None
    if last and not anew:
        known = spark.read.parquet(f"{kept}/version-{last}/files")
        stored = spark.read.schema(stored_schema).parquet(f"{kept}/version-{last}/rows")
        changed = [r["file"] for r in files.join(known, _STATE, "left_anti").select("file").limit(LISTED + 1).collect()]
        gone = known.join(files, _STATE, "left_anti").select("file")
        some_gone = not gone.isEmpty()
        if not changed and not some_gone:
            return stored.select("row.*"), None
        unchanged = stored.join(gone, "file", "left_anti") if some_gone else stored
    staged, parsed = None, None
    if changed is None or changed:
        few = changed is not None and len(changed) <= LISTED
        staged = staging.stage_json(spark, changed if few else path, schema, max_rejects, rounding, keep_file=True)
        parsed = staged.rows.select("_file", F.struct(*schema.fieldNames()).alias("row")).toDF("file", "row")
        if unchanged is not None and not few:
            parsed = parsed.join(unchanged.select("file").distinct(), "file", "left_anti")
    rows = parsed if unchanged is None else unchanged if parsed is None else unchanged.unionByName(parsed)
    rows.write.parquet(f"{kept}/version-{number}/rows")
    files.write.parquet(f"{kept}/version-{number}/files")
    for n, (folder, fs) in versions.items():
        if n != last:  # a reader of the last version can finish
            fs.delete(folder, True)
    return spark.read.schema(stored_schema).parquet(f"{kept}/version-{number}/rows").select("row.*"), staged
