"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Every naive timestamp in the model is UTC; AQE re-plans joins and splits skewed partitions. Tables are written once and
# read often, and hashed ids shrink under zstd only.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_own_scratch: dict[str, str] = {}
_open_blocks: ContextVar[list[str] | None] = ContextVar("open_blocks", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to the caller's session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode, where driver and executors share a disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_scratch:
        _own_scratch[context.applicationId] = tempfile.mkdtemp(prefix="starloom-")
    return _own_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    Cuts the lineage like a reliable checkpoint, but later readers get column pruning and
    pushed-down filters, and a lost executor costs a re-read instead of a recomputation.
    Inside ``scratch_tables`` the files go away with the block; elsewhere the frame may still be
    needed, and they stay as long as the folder does.
    """
    path = scratch_path(df.sparkSession, label)
    kept = _open_blocks.get()
    if kept is not None:
        kept.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables materialized inside the block when it ends well.

    After an error they stay: one may be the only copy of a table that was being replaced.
    """
    paths: list[str] = []
    token = _open_blocks.set(paths)
    try:
        yield
    finally:
        _open_blocks.reset(token)
    jvm = spark._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
