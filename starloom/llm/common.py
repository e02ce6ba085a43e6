"""Helpers that several operators share: table access, stored intermediate results, components of a graph."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.session import configure, materialize, scratch_dir

_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus folder."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application, through the shared folder.

    Operators that run Python in tasks call this, so a cluster needs no installation of the package. Rows go to
    Python in small batches, as a single text can be large.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    name = f"{scratch_dir(spark)}/{package.name}-{uuid.uuid4().hex}.zip"
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    out = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(place)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once to the folder all executors share and read back: later uses cost a scan, also after a lost executor."""
    return materialize(df, f"llm-{label}")


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: every node hands its least neighbour to its other neighbours.

    ``larger`` keeps the neighbours above the node (large star), else those below (small star).
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    paired = both.join(least, "u")
    if larger:
        moved = paired.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = paired.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; the component is its least node.

    Alternating large and small stars: logarithmically many rounds, each a grouped minimum and one join,
    written to the shared folder, so neither edges nor components pass through the driver. Loops and repeated
    edges are harmless; no edges give no rows.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    current = store(oriented(edges), "edges")
    seen = mark(current)
    for _ in range(rounds):
        if not seen[0]:
            break
        current = store(_star(_star(current, larger=True), larger=False), "stars")
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows with equal whole-number keys, from batches sorted by them; a group may span batches.

    Cheaper than a grouped map where most groups have a few rows, as those share their batches.
    """
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        k = batch[keys].to_numpy(np.int64)
        bounds = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist()]
        for a, b in zip(bounds, bounds[1:]):
            yield batch.iloc[a:b]
        rest = batch.iloc[bounds[-1]:]
    if rest is not None:
        yield rest


def grouped(rows: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """Apply ``work``, which returns columns of equal length, to the groups of ``rows`` by ``keys``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, size = [], 0
        for group in groups(batches, keys):
            out = work(group)
            found = len(next(iter(out.values())))
            if found:
                made.append(out)
                size += found
            if size >= 4_096:
                yield pd.DataFrame({c: np.concatenate([m[c] for m in made]) for c in out})
                made, size = [], 0
        if made:
            yield pd.DataFrame({c: np.concatenate([m[c] for m in made]) for c in made[0]})

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
