"""Equi-joins of a large frame with a lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import materialize

# A key that holds more than this share of the rows is spread over several tasks. At most
# 1 / HOT_SHARE keys can, which bounds every list of such keys that is broadcast.
HOT_SHARE = 0.005
# Lookup rows that make a key worth a task of its own.
MANY = 64
# Keys with many rows on both sides are cut into SIDE x SIDE tasks.
SIDE = 8


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate is below the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def replicated(dim: DataFrame) -> DataFrame:
    """A dimension kept on every node, if its size allows; otherwise Spark picks the join."""
    return F.broadcast(dim) if fits_broadcast(dim) else dim


def hot_hashes(df: DataFrame, column: str, share: float = HOT_SHARE) -> DataFrame:
    """Values of a hash column that may hold more than ``share`` of the rows.

    One pass without a shuffle. The list holds every such value, at most ``1 / share`` in all,
    and possibly a few cooler ones.
    """
    frequent = df.select(column).stat.freqItems([column], share)
    return frequent.select(F.explode(f"{column}_freqItems").alias(column))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, at_least: int = 0) -> DataFrame:
    """The keys that hold more than ``share`` of the rows, and more than ``at_least`` rows.

    Keys with a null are left out.
    """
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_key")).dropna(subset=list(keys))
    counted = hashed.join(F.broadcast(hot_hashes(hashed, "_key", share)), "_key").groupBy(*keys).agg(F.count("*").alias("_n"))
    return counted.filter(F.col("_n") > F.lit(max(share * df.count(), at_least))).select(*keys)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner", unique: bool = False,
) -> DataFrame:
    """Join a large frame with a lookup table on equally named keys.

    ``how`` is ``inner``, ``left`` or ``left_anti``. A lookup below the broadcast limit is left to
    Spark, which replicates it, and nothing shuffles. Beyond it both sides shuffle on the keys,
    and adaptive execution, which ``session.configure`` turns on, splits keys that hold many rows. ``unique`` says
    that the lookup was reduced to one row per key; it never changes the result.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if how == "left_anti" and not unique:
        return rows.join(lookup.select(*keys), keys, how)
    if fits_broadcast(lookup):
        return rows.join(lookup, keys, how)
    if unique:
        # Grouped on the same keys it would be joined as it is partitioned, which keeps adaptive
        # execution from splitting hot keys of the rows; a written table shuffles afresh.
        lookup = materialize(lookup, "lookup")
    elif how == "left":
        # A left join cannot split its right side, so keys with many lookup rows go separately.
        hot = hot_keys(lookup, keys, at_least=MANY).collect()  # at most 1 / HOT_SHARE keys
        if hot:
            heavy = F.broadcast(lookup.sparkSession.createDataFrame(hot, lookup.select(*keys).schema))
            matched = _in_squares(rows.join(heavy, keys, "left_semi"), lookup.join(heavy, keys, "left_semi"), keys)
            others = rows.join(heavy, keys, "left_anti").join(lookup.join(heavy, keys, "left_anti"), keys, how)
            return others.unionByName(matched)
    return rows.join(lookup, keys, how)


def _in_squares(rows: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys that all have many lookup rows: either side is cut into ``SIDE`` parts, and
    each task gets one part of both.

    Every key here has a match, so an inner join serves left joins too, and the copies of a row
    are fewer than the rows it yields.
    """
    def part(df: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*df.columns), F.lit(SIDE)).cast("int")

    every = F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1)))
    left = rows.withColumn("_part", part(rows)).withColumn("_other", every)
    right = lookup.withColumn("_other", part(lookup)).withColumn("_part", every)
    return left.join(right, [*keys, "_part", "_other"]).drop("_part", "_other")


# --- pruning the stored side ----------------------------------------------------------------
FILTER_BITS = 2**23  # one megabyte; keys beyond some millions let more rows through, never fewer


def _bit(keys: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_filter(batch: DataFrame, keys: Sequence[Column], bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the keys with one hash: one row with an array of ``bits / 64`` words, whatever the batch holds.

    A task first reduces its keys to the words they set. Null is a key like any other.
    """
    place = batch.select(_bit(keys, bits).alias("bit")).select(
        F.expr("bit div 64").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")).alias("mask"))
    words = place.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = batch.sparkSession.range(0, bits // 64, 1, 1).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    return filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("words"))


def in_reach(stored: DataFrame, batch: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The stored rows that may share a key with ``batch``: all that do, and few others.

    For a batch that is small against the stored table: its rows are tested where they are scanned, so a join on the
    keys shuffles about as many of them as the batch has. The test costs one more pass over the batch's keys.
    """
    if bits % 64:
        raise ValueError("the filter has whole words of 64 bits")
    kinds = {f.name: f.dataType for f in stored.schema}
    words = key_filter(batch, [F.col(k).cast(kinds[k]) for k in keys], bits).scalar()
    bit = _bit([F.col(k) for k in keys], bits)
    word = F.get(words, (F.shiftright(bit, 6)).cast("int"))
    return stored.filter(F.call_function("shiftright", word, (bit % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
