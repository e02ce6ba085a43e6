"""Exact centroid clustering with a progressive search in the Walsh-Hadamard domain (operator 12).

Vectors and centroids are whole numbers, and so are their transforms: sums and differences of components, ordered from
coarse to fine (by the number of sign changes). The squared differences of the coefficients add up to the squared
distance times the width, so the sum over the first coefficients bounds it from below. Each vector finishes the
centroid that looks nearest after the first coefficients; the others are dropped as soon as their sum is above the best
finished distance, and those that are never worse finish all coefficients. So every distance that decides is exact.

A round is one pass over the stored vectors: tasks hold the centroids and return, per cluster, sums of whole numbers,
which Spark adds up. Numbers above 64 bits are Python's own and travel in parts of 15 digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import read, ship, store
from .registry import query

STEPS = (1, 2, 4, 8, 16, 32)  # coefficients known at each elimination; after the last all others follow
SMALL = 2**20  # below this, and against centroids below FAR, no sum exceeds 64 bits
FAR = 17 * SMALL
PART = 10**15
LONG = 2**63


def coarse_to_fine(width: int) -> np.ndarray:
    """The rows of the Hadamard matrix in the order of their sign changes."""
    at = np.arange(width)
    signs = np.array([[bin(i & j).count("1") & 1 for j in at] for i in at])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def transform(values: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, exact, coarse coefficients first. The width is a power of two."""
    n, width = values.shape
    out, half = values, 1
    while half < width:
        pairs = out.reshape(n, width // (2 * half), 2, half)
        out = np.concatenate([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return out[:, coarse_to_fine(width)]


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of every row, the smallest if several are, and the squared distance to it."""
    n, width = values.shape
    k = len(centroids)
    rows, marks = transform(values), transform(centroids)
    total = np.zeros((n, k), values.dtype)
    open_ = np.ones((n, k), bool)
    done = np.zeros((n, k), bool)

    def add(row: np.ndarray, centroid: np.ndarray, begin: int, end: int) -> None:
        gap = rows[row, begin:end] - marks[centroid, begin:end]
        total[row, centroid] += (gap * gap).sum(axis=1)

    bounds = [0, *(s for s in STEPS if s < width), width]
    every, numbers = np.arange(n), np.arange(k)
    add(np.repeat(every, k), np.tile(numbers, n), 0, bounds[1])
    first = np.array([min(numbers, key=lambda c: t[c]) for t in total]) if total.dtype == object else total.argmin(axis=1)
    add(every, first, bounds[1], width)
    done[every, first] = True
    best = total[every, first]
    for begin, end in zip(bounds[1:], bounds[2:]):
        open_ &= total <= best[:, None]  # a sum only grows; equal ones stay, as the smaller number wins
        row, centroid = np.nonzero(open_ & ~done)
        if len(row):
            add(row, centroid, begin, end)
    open_ &= total <= best[:, None]
    # What is still open has finished all coefficients.
    if total.dtype == object:
        chosen = np.array([min(numbers[o], key=lambda c: t[c]) for t, o in zip(total, open_)], np.int64)
    else:
        chosen = np.where(open_, total, np.iinfo(np.int64).max).argmin(axis=1)
    return chosen, total[every, chosen] // width


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, ``scale`` a power of two; Python's own whole numbers where 64 bits might not do."""
    if np.abs(values).max(initial=0.0) < SMALL:
        return np.floor(values * scale).astype(np.int64)
    # From 2 ** 53 upwards doubles are whole numbers themselves.
    return np.array([[int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in row] for row in values], object)


def assign(values: np.ndarray, centroids: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, numbers, cluster, distance) for the rows of ``values`` that can use 64 bits, then for the others."""
    top = np.array([max(abs(int(x)) for x in c) for c in centroids], object)
    low = np.abs(values).max(axis=1) * scale < SMALL
    at = np.flatnonzero(low)
    if len(at):
        numbers = whole(values[at], scale)
        # With one centroid below SMALL, one beyond FAR is strictly worse for these rows, whatever its other components.
        near = np.flatnonzero(top <= FAR) if (top < SMALL).any() else np.arange(len(centroids))
        kind = np.int64 if (top[near] <= FAR).all() else object
        found, distance = nearest(numbers.astype(kind), centroids[near].astype(kind))
        yield at, numbers, near[found], distance
    at = np.flatnonzero(~low)
    if len(at):
        numbers = whole(values[at], scale).astype(object)
        yield at, numbers, *nearest(numbers, centroids.astype(object))


def _parts(cluster: int, item: int, number: int) -> Iterator[tuple[int, int, int, int]]:
    sign, number, at = (-1 if number < 0 else 1), abs(int(number)), 0
    while number:
        number, part = divmod(number, PART)
        yield cluster, item, at, sign * part
        at += 1


def _sums(vectors: DataFrame, centroids: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows per cluster and the sums of their components, exact; clusters * (width + 1) numbers reach the driver."""
    k, width = centroids.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, width + 1), object)
        for batch in batches:
            values = np.array(batch["embedding"].tolist(), float).reshape(len(batch), width)
            for _, numbers, cluster, _ in assign(values, centroids, scale) if len(batch) else ():
                for c in np.unique(cluster):
                    mine = numbers[cluster == c]
                    total[c, :width] += mine.sum(axis=0).astype(object)
                    total[c, width] += len(mine)
        rows = [r for c in range(k) for i in range(width + 1) for r in _parts(c, i, total[c, i])]
        yield pd.DataFrame(rows, columns=["cluster", "item", "part", "value"])

    found = vectors.select("embedding").mapInPandas(run, "cluster int, item int, part int, value long")
    out = np.zeros((k, width + 1), object)
    for r in found.groupBy("cluster", "item", "part").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        out[r["cluster"], r["item"]] += int(r["value"]) * PART ** r["part"]
    return out[:, width], out[:, :width]


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector that takes part.

    Vectors of exactly ``width`` components (a power of two), none null or non-finite, take part with the components
    floor(scale * x). Centroids start as the vectors with the smallest SHA-256 of ``seed:vec_id``, ties by components,
    rows without vec_id last; fewer vectors give fewer centroids. After each of the rounds a centroid with vectors
    becomes the floor of their mean, one without stays; ties in distance go to the smaller number. Repeated rows count
    as often as they occur. Distances and inertias that exceed a long are null, though they decide exactly. Other
    columns are not read. An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = store(vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") == width) & finite).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    starts = kept.orderBy(order, "embedding").select("embedding").limit(clusters).collect()
    if not starts:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = whole(np.array([r["embedding"] for r in starts], float), scale).astype(object)
    for _ in range(rounds):
        sizes, sums = _sums(kept, centroids, scale)
        moved = np.array([[x // n for x in s] if n else list(c) for c, n, s in zip(centroids, sizes, sums)], object)
        if (moved == centroids).all():
            break  # every further round would repeat this one
        centroids = moved

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array(batch["embedding"].tolist(), float).reshape(len(batch), width)
            ids = batch["vec_id"].to_numpy(object)
            for at, _, number, distance in assign(values, centroids, scale) if len(batch) else ():
                short = [int(d) if d < LONG else None for d in distance]
                yield pd.DataFrame({
                    "vec_id": pd.array([None if pd.isna(i) else int(i) for i in ids[at]], "Int64"),
                    "cluster": number.astype(np.int32), "distance": pd.array(short, "Int64")})

    placed = store(kept.mapInPandas(run, "vec_id long, cluster int, distance long"), "clusters")
    known = F.max(F.col("distance").isNull()) == F.lit(False)
    sums = placed.groupBy("cluster").agg(
        F.when(known, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("own"))  # one row per cluster
    everything = Window.partitionBy(F.lit(1))
    fits = lambda c: F.when(F.col(c) < F.lit(str(LONG)).cast("decimal(38,0)"), F.col(c).cast("long"))
    sums = sums.withColumn("every", F.sum("own").over(everything)).withColumn("gaps", F.max(F.col("own").isNull()).over(everything))
    hashes = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    sums = sums.select(
        "cluster", fits("own").alias("cluster_inertia"), F.when(~F.col("gaps"), fits("every")).alias("inertia"),
        F.element_at(hashes, F.col("cluster") + 1).alias("centroid_sha256"))
    return placed.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql(rounds: int) -> str:
    """Common table expressions a0 (assignment) and c1 (centroids), a1 and c2 and so on."""
    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM (SELECT k.row, c.cluster, CAST(list_sum([(t[1] - t[2]) * (t[1] - t[2]) for t in list_zip(k.v, c.v)]) AS BIGINT) AS distance
        FROM k, c{n} c) GROUP BY row)"""

    def moved(n: int) -> str:
        return f"""c{n} AS MATERIALIZED (
  SELECT o.cluster, coalesce(m.v, o.v) AS v FROM c{n - 1} o LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % size) + size) % size) // size AS BIGINT) ORDER BY place) AS v
    FROM (SELECT cluster, place, CAST(sum(x) AS HUGEINT) AS total, CAST(count(*) AS HUGEINT) AS size
          FROM (SELECT a.cluster, unnest(k.v) AS x, unnest(range(64)) AS place FROM a{n - 1} a JOIN k USING (row)) GROUP BY ALL)
    GROUP BY cluster) m USING (cluster))"""

    return ",\n".join([assigned(0), *(part for n in range(1, rounds + 1) for part in (moved(n), assigned(n)))])


OP12_SQL = f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cluster, v
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM k ORDER BY h NULLS LAST, v LIMIT 8)),
{_rounds_sql(10)}
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a10 a JOIN k USING (row) JOIN c10 c USING (cluster)
"""


@query("op12_hadamard_clusters", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))
