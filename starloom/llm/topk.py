"""Exact top-k search by inner product over a bit-sliced index (operator 2).

Rows are cut into blocks. In a block every component is quantised to a few bits, and bit j of component d over all
rows of the block is one bitmap. The score of a query for all rows at once is a sum of such bitmaps: a ripple-carry
adder of ANDs and XORs on slices of the score. Reading the score's slices from the most significant down gives the
k-th best quantised score; rows whose quantised score lies within twice the proven error of it are the boundary, and
their scores are computed exactly. So the result is that of a full scan, ties included.

Queries are the stated set of rows. They go to every block, where the index is built once and the queries stream past
it, and each block returns at most k rows a query. Rows with components beyond the index's range, and queries with such,
are scored in Python's own numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import read, ship, store
from .registry import query

BITS = 6  # slices of a component
WEIGHT_BITS = 5  # bits of a query's weight, sign apart


class Slices:
    """A block of integer vectors as bitmaps, 64 rows to a word."""

    def __init__(self, values: np.ndarray):
        self.rows, self.width = values.shape
        self.values = values
        top = max(1, int(np.abs(values).max(initial=0)))
        self.step = max(1.0, top / (2 ** (BITS - 1) - 1))
        coarse = np.rint(values / self.step).astype(np.int64)
        self.rest = float(np.sqrt(((values - coarse * self.step) ** 2).sum(1).max(initial=0.0)))
        self.norm = float(np.sqrt((values.astype(float) ** 2).sum(1).max(initial=0.0)))
        shifted = (coarse + 2 ** (BITS - 1)).astype(np.uint64)
        words = -(-self.rows // 64)
        padded = np.zeros((self.width, words * 64), np.uint64)
        padded[:, :self.rows] = shifted.T
        self.bitmaps = np.stack([
            np.packbits((padded >> np.uint64(j) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
            for j in range(BITS)], axis=1)  # [component, slice, word]
        self.live = np.packbits(np.arange(words * 64) < self.rows, bitorder="little").view(np.uint64)

    def add(self, total: list[np.ndarray], slices: np.ndarray, at: int) -> None:
        """Add the number with these slices, shifted left by ``at``, to the number with the slices ``total``."""
        carry = None
        for j, s in enumerate(slices):
            k = at + j
            while len(total) <= k:
                total.append(np.zeros_like(self.live))
            t = total[k]
            half = t ^ s
            if carry is None:
                total[k], carry = half, t & s
            else:
                total[k], carry = half ^ carry, (t & s) | (half & carry)
        k = at + len(slices)
        while carry.any():
            if len(total) <= k:
                total.append(carry)
                break
            total[k], carry = total[k] ^ carry, total[k] & carry
            k += 1

    def score(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of sum(weight * component) over all rows, up to a constant that is the same for every row."""
        total: list[np.ndarray] = []
        for d in np.flatnonzero(weights):
            slices = self.bitmaps[d] if weights[d] > 0 else ~self.bitmaps[d]
            size = abs(int(weights[d]))
            for at in range(size.bit_length()):
                if size >> at & 1:
                    self.add(total, slices, at)
        return total

    def boundary(self, total: list[np.ndarray], k: int, margin: int) -> np.ndarray:
        """Rows whose score is at least that of the k-th best row less ``margin``."""
        sure, tied, value = np.zeros_like(self.live), self.live.copy(), 0
        for j in range(len(total) - 1, -1, -1):  # most significant slice first
            both = sure | (tied & total[j])
            if int(np.bitwise_count(both).sum()) >= k:
                tied, value = tied & total[j], value | 1 << j
            else:
                sure, tied = both, tied & ~total[j]
        least = max(0, value - margin)
        more, equal = np.zeros_like(self.live), self.live.copy()
        for j in range(len(total) - 1, -1, -1):
            if least >> j & 1:
                equal = equal & total[j]
            else:
                more, equal = more | (equal & total[j]), equal & ~total[j]
        bits = np.unpackbits((more | equal).view(np.uint8), bitorder="little")
        return np.flatnonzero(bits[:self.rows])

    def best(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the block's k best rows other than ``own``."""
        step = max(1.0, np.abs(query).max(initial=0) / (2 ** WEIGHT_BITS - 1))
        weights = np.rint(query / step).astype(np.int64)
        if weights.any():
            used = weights * step
            error = np.linalg.norm(used) * self.rest + np.linalg.norm(query - used) * self.norm
            margin = int(2 * error * (1 + 1e-9) / (step * self.step)) + 2
            rows = self.boundary(self.score(weights), k + 1, margin)  # one more, as the query's own row may be there
        else:
            rows = np.arange(self.rows)
        rows = rows[ids[rows] != own]
        scores = self.values[rows] @ query
        order = np.lexsort((ids[rows], -scores))[:k]
        return ids[rows][order], scores[order]


LARGE = 2.0**27  # scaled components from here on do not fit the index


class Block:
    """The index of a block's rows and, apart from it, the rows with large components."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, scale: int):
        small = np.abs(values).max(axis=1) * scale < LARGE
        self.scale = scale
        self.ids = ids[small]
        self.slices = Slices(np.floor(values[small] * scale).astype(np.int64)) if small.any() else None
        self.far_ids, self.far = ids[~small], _exact(values[~small], scale)

    def best(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best rows other than ``own``."""
        small = np.abs(query).max(initial=0.0) * self.scale < LARGE
        exact = _exact(query[None], self.scale)[0]
        found: list[tuple[int, int]] = []
        if small and len(self.ids):
            ids, scores = self.slices.best(exact.astype(np.int64), self.ids, own, k)
            found = list(zip(scores.tolist(), ids.tolist()))
        elif len(self.ids):
            found = list(zip(self.slices.values.astype(object) @ exact, self.ids.tolist()))
        if len(self.far_ids):
            found += zip(self.far @ exact, self.far_ids.tolist())
        return sorted(((int(s), i) for s, i in found if i != own), key=lambda f: (-f[0], f[1]))[:k]


def _exact(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) in Python's own numbers; from 2 ** 53 upwards doubles are whole numbers themselves."""
    whole = [[int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in row] for row in values]
    return np.array(whole, object).reshape(values.shape)


def _ordered(score: int) -> str:
    """A text that sorts as the number does, whatever its size."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}" + digits.translate(str.maketrans("0123456789", "9876543210"))


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, block: int = 16_384) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest integer inner product for every query row.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on them. Components become floor(scale * x).
    Rows that are null or empty, hold null or non-finite components, or have a null vec_id take no part. Ties go to
    the smaller vec_id, rows of equal id and vector count as one row. Vectors of different lengths never meet. Fewer than ``k`` other
    rows give fewer ranks; an empty table gives none. Scores beyond 64 bits are null, though they rank exactly.
    """
    ship(vectors.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)

    def step(x):  # down to a multiple of 1 / scale; large doubles are one already
        x = x.cast("double")
        return F.when(F.abs(x) < float(2**40), F.floor(x * F.lit(scale)).cast("double") / F.lit(float(scale))).otherwise(x)

    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("asks"), F.transform("embedding", step).alias("v"))
    rows = store(rows.distinct(), "integers")
    sizes = [(r["n"], r["count"]) for r in rows.groupBy(F.size("v").alias("n")).count().collect()]  # one entry per vector length
    result = None
    for n, count in sizes:
        part = _search(rows.filter(F.size("v") == n), max(1, -(-count // block)), k, scale)
        result = part if result is None else result.unionByName(part)
    if result is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("ordered"), "vec_id")
    return (
        result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))


def _search(rows: DataFrame, parts: int, k: int, scale: int) -> DataFrame:
    data = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), F.lit(False).alias("asks"), "vec_id", "v")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asks = rows.filter("asks").select(every.alias("part"), F.lit(True).alias("asks"), "vec_id", "v")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, ids, values, index = None, [], [], None
        for batch in batches:  # sorted: a block's rows, then the queries to it
            out = []
            for own_part, asks, own, vector in zip(batch["part"], batch["asks"], batch["vec_id"], batch["v"]):
                if own_part != part:
                    part, ids, values, index = own_part, [], [], None
                if not asks:
                    ids.append(own)
                    values.append(vector)
                    continue
                if index is None:
                    index = Block(np.array(ids, np.int64), np.array(values, float), scale) if ids else None
                if index is not None:
                    out += [(own, i, s if -2**63 <= s < 2**63 else None, _ordered(s)) for s, i in index.best(np.asarray(vector, float), own, k)]
            made = pd.DataFrame(out, columns=["query_id", "vec_id", "score", "ordered"])
            yield made.astype({"query_id": "int64", "vec_id": "int64", "score": "Int64"})

    return data.unionByName(asks).repartition("part").sortWithinPartitions("part", "asks").mapInPandas(
        meet, "query_id long, vec_id long, score long, ordered string")


OP2_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum([t[1] * t[2] for t in list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op2_bit_sliced_top_k", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
