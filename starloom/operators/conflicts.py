"""What happens when rows share a key: first wins, last wins, partial update, skip known keys.

Arrival order does not exist in a distributed frame, so every rule takes the order columns that
define "first" and "last". The remaining columns break ties, which makes the outcome depend on
the data alone. Each rule is one grouped min/max: tasks reduce a key to a single row before the
shuffle, so a key that holds a large share of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.joins import fits_broadcast, in_reach
from starloom.session import materialize


def distinct_rows(df: DataFrame) -> DataFrame:
    """The distinct rows of a wide frame in which few rows repeat; ``df`` must be a stored one, it is read again.

    A first pass shuffles a hash of each row. Only rows whose hash comes more than once are compared, and so shuffled,
    whole; all others pass. Where those hashes are too many to replicate, all rows are compared as usual.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    counted = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = materialize(counted.filter("_rows > 1").select("_hash"), "repeated")
    if not fits_broadcast(repeated):
        return df.distinct()
    once = hashed.join(F.broadcast(repeated), "_hash", "left_anti").drop("_hash")
    return once.unionByName(hashed.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash").distinct())


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[Column, list[str]]:
    rest = [c for c in df.columns if c not in keys and c not in order]
    columns = [c for c in order if c not in keys] + rest
    return F.struct(*columns) if columns else F.struct(F.lit(0).alias("none")), columns


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    row, columns = _ranked(df, keys, order)
    picked = df.groupBy(*keys).agg(pick(row).alias("_row"))
    source = {c: F.col(f"_row.{c}") for c in columns}
    return picked.select([source.get(c, F.col(c)).alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first by ``order``; nulls sort first, null is a key like any other."""
    return _pick(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the last by ``order``."""
    return _pick(df, keys, order, F.max)


# A keyed store overwrites on insert, and skips on insert-if-not-exists.
last_write_wins = keep_last
first_write_wins = keep_first


def without_known(new: DataFrame, existing: DataFrame, keys: Sequence[str], prune: bool = False) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``; null is a key like any other.

    One shuffle per side at most, and adaptive execution can split hot keys of ``new``. ``prune``, for a batch that is
    small against a large stored table, shuffles only the stored rows that may share a key with it.
    """
    if prune:
        existing = in_reach(existing.select(*keys), new, keys)
    known = existing.select([F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)])
    same = reduce(and_, [new[k].eqNullSafe(known[f"_known_{i}"]) for i, k in enumerate(keys)])
    return new.join(known, same, "left_anti")


def without_stored(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``without_known`` for stored frames, which are read again: nothing shuffles if nothing is stored, else the keys do.

    Few unknown keys are replicated, so the rows need no shuffle; if they are many, the rows are looked up as usual.
    """
    if existing.isEmpty():
        return new
    unknown = materialize(without_known(new.select(*keys), existing, keys).distinct(), "unknown")
    if not fits_broadcast(unknown):
        return without_known(new, existing, keys)
    unknown = unknown.toDF(*[f"_unknown_{i}" for i in range(len(keys))])
    same = reduce(and_, [new[k].eqNullSafe(unknown[f"_unknown_{i}"]) for i, k in enumerate(keys)])
    return new.join(F.broadcast(unknown), same, "left_semi")


def insert_if_absent(
    new: DataFrame, existing: DataFrame | None, keys: Sequence[str], order: Sequence[str] = (), prune: bool = False,
) -> DataFrame:
    """The rows to append so that the first writer of each key wins."""
    if existing is None:
        return keep_first(new, keys, order)
    if prune:  # by the batch as it comes, which is cheaper than by its first rows
        existing = in_reach(existing.select(*keys), new, keys)
    return without_known(keep_first(new, keys, order), existing, keys)


def append_new(new: DataFrame, existing: DataFrame, keys: Sequence[str], prune: bool = False) -> DataFrame:
    """The rows to append on a rerun: those whose key is not stored yet.

    Rows that share a key within ``new`` are all kept, as a plain append would.
    """
    return without_known(new, existing, keys, prune)


def upsert_columns(
    new: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str],
    update: Sequence[str],
) -> DataFrame:
    """The merged table: ``update`` columns from the last row of a key, the others from its first.

    ``existing`` has one row per key, comes before every new row and lacks the order columns.
    """
    fixed = [c for c in new.columns if c not in (*keys, *order, *update)]
    rows = new.withColumn("_batch", F.lit(1))
    if existing is not None:
        rows = rows.unionByName(existing.withColumn("_batch", F.lit(0)), allowMissingColumns=True)
    ordering = ["_batch", *order]
    merged = rows.groupBy(*keys).agg(
        F.min(F.struct(*ordering, *fixed, *update)).alias("_first"),
        F.max(F.struct(*ordering, *update, *fixed)).alias("_last"),
    )
    source = {c: F.col(f"_last.{c}") for c in update} | {c: F.col(f"_first.{c}") for c in fixed}
    columns = [c for c in new.columns if c not in order]
    return merged.select([source.get(c, F.col(c)).alias(c) for c in columns])
