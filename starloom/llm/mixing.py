"""Mix sources to target weights (operator 10), with DataFrame functions only.

Every row gets a hash-random key. Within each source the rows stand in key order; key ranges (the key's first digits)
split a source over many tasks, and a prefix sum over the ranges gives every row the number of words before it. A
source's budget is then a cut at an exact word: whole epochs first, the rest from the front of the key order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, store, text_or_empty
from .registry import query

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place`` from 0 in code point order, null last, by range partitions and their offsets."""
    ranged = store(
        sources.repartitionByRange(8, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return ranged.join(offsets, "part").select(
        "source", "src", "source_size", (F.col("before") + F.row_number().over(within) - 1).alias("place"))


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Each source's target: its weight's part of ``share`` of all words, at most ``cap`` times its own words.

    What the capped sources leave is shared out by weight again until none is above its cap; every pass is one
    aggregate over the table of sources, and the capped set only grows.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = store(_numbered(sources).withColumn("weight", weight), "weights")
    limit = F.col("source_size") * float(cap)
    level = 0.0
    total = table.agg(F.sum("source_size")).first()[0] or 0
    while total:
        above = F.col("weight") * level >= limit
        fixed, open_weight = table.agg(
            F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        new = (share * total - fixed) / open_weight
        if new <= level:
            break
        level = new
    return table.select("src", "source_size", F.round(F.least(F.col("weight") * level, limit), 6).alias("target"))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, src (the source, null included) and key; the key follows from doc_id and size alone."""
    sized = docs.select(
        F.col("doc_id"), F.col("source"), word_count(text_or_empty()).alias("size"),
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("src"))
    return sized.withColumn("key", _key(F.col("doc_id"), F.col("size"), seed))


def _key(doc_id: Column, size: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("/", F.lit(seed), doc_id.cast("string"), size))


def _planned(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float, range_rows: int) -> tuple[Column, DataFrame]:
    """The range that a key falls into, and per source and range: words, offset, source_size, target, epochs, rest."""
    rows = sized.count()
    digits = max(1, math.ceil(math.log(max(1, rows / range_rows), 16)))
    bucket = F.substring("key", 1, digits)
    ranges = sized.groupBy("source", "src", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    ranges = store(ranges, "ranges")
    sources = ranges.groupBy("source", "src").agg(F.sum("words").alias("source_size"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        ranges.select("src", "bucket", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
        .join(targets(sources, weights, share, cap), "src")
        .withColumn("budget", F.round("target").cast("long"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")))
    return bucket, plan


def _ahead() -> Column:
    """The words of a source that stand before a row in the order of keys."""
    inside = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        range_rows: int = 20_000, seed: int = 11) -> DataFrame:
    """How many words of every row the mix takes.

    Returns one row per input row: doc_id, size, source_size, target, epochs (whole copies taken), partial (words of
    one more copy) and taken = epochs * size + partial. Over a source the taken words add up to its target, rounded.
    Null texts have size 0; a null source is a source of its own, last in order; equal rows are interchangeable, so
    ties in the key do not matter; an empty table or one without words gives targets of 0. Columns beyond doc_id, text
    and source are not read. The key is a hash of doc_id and size, so reruns agree.
    """
    sized = store(_sized(docs, seed), "sized")  # the texts are read once; the counted rows serve every later step
    bucket, plan = _planned(sized, weights, share, cap, range_rows)
    placed = sized.withColumn("bucket", bucket).join(plan, ["src", "bucket"]).withColumn("ahead", _ahead())
    partial = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("ahead")))
    return placed.select(
        "doc_id", "size", "source_size", "target", F.col("epochs").cast("long").alias("epochs"),
        partial.cast("long").alias("partial"),
        (F.col("epochs") * F.col("size") + partial).cast("long").alias("taken"))


def cuts(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float, range_rows: int) -> DataFrame:
    """Per source: epochs, and the row at which its further copies end.

    Rows with a key below ``cut`` are taken once more; of the ``twins`` rows that have this key, ``whole`` are, and
    the next one up to its word ``words``. Only the range that holds the cut is sorted.
    """
    bucket, plan = _planned(sized, weights, share, cap, range_rows)
    last = plan.filter((F.col("offset") <= F.col("rest")) & (F.col("rest") < F.col("offset") + F.col("words")))
    near = sized.withColumn("bucket", bucket).join(last.select("src", "bucket", "offset", "rest"), ["src", "bucket"])
    near = near.withColumn("ahead", _ahead()).groupBy("src", "rest", "key", "size").agg(
        F.min("ahead").alias("ahead"), F.count(F.lit(1)).alias("twins"))
    over = F.col("rest") - F.col("ahead")
    at = near.filter((over >= 0) & (over < F.col("size") * F.col("twins"))).select(
        "src", F.col("key").alias("cut"), "twins", F.floor(over / F.col("size")).alias("whole"), (over % F.col("size")).alias("words"))
    return store(plan.select("src", "epochs").distinct().join(at, "src", "left"), "cuts")


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its ``count``-th word."""
    pieces = F.split(text, rf"(?<=[^\x20\x09-\x0D])(?={SPACE})")
    return F.array_join(F.slice(pieces, F.lit(1), F.greatest(count, F.lit(1)).cast("int")), "")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                    range_rows: int = 20_000, seed: int = 11) -> DataFrame:
    """The mixed corpus itself: each document once per whole epoch, the document at the cut once more, up to the cut.

    Same columns as ``docs``; n_chars, if there, follows the text. Documents without words belong to no mix: they are
    taken once, as they cost nothing. Only keys and sizes are ranked; each text is read in place and compared with its
    source's cut. Equal rows are interchangeable: as many of them are taken as the budget asks for.
    """
    columns = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), word_count(text_or_empty()).alias("size"),
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("src"))
    rows = rows.withColumn("key", _key(F.col("row.doc_id"), F.col("size"), seed))
    ends = cuts(store(_sized(docs, seed), "sized"), weights, share, cap, range_rows)
    # One row per source: texts stay where they are unless there are very many sources.
    placed = rows.join(ends, "src")
    at = F.col("key").eqNullSafe(F.col("cut"))
    alone = F.when(F.col("key") < F.col("cut"), F.col("size")).when(at, F.col("words")).otherwise(0)
    taken = placed.withColumn("partial", alone)
    if not ends.filter("twins > 1").isEmpty():  # rows of one key at a cut are told apart by a number
        again = at & (F.col("twins") > 1)
        number = F.row_number().over(Window.partitionBy("src").orderBy(F.xxhash64("row.text"))) - 1
        part = F.when(F.col("number") < F.col("whole"), F.col("size")).when(F.col("number") == F.col("whole"), F.col("words")).otherwise(0)
        taken = taken.filter(~again).unionByName(
            placed.filter(again).withColumn("number", number).withColumn("partial", part).drop("number"))
    taken = taken.withColumn("partial", F.col("partial").cast("long"))
    whole = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("epochs"))
    none = F.array().cast("array<bigint>")
    copies = taken.select("size", "row", F.explode(F.concat(
        F.when(whole > 0, F.array_repeat(F.lit(-1).cast("long"), whole.cast("int"))).otherwise(none),
        F.when(F.col("partial") > 0, F.array("partial")).otherwise(none))).alias("words"))
    was = {c: F.col("row").getField(c) for c in columns}
    text = F.when((F.col("words") < 0) | (F.col("words") >= F.col("size")), was["text"]).otherwise(
        first_words(was["text"], F.col("words")))
    now = was | {"text": text}
    if "n_chars" in columns:
        now["n_chars"] = F.coalesce(F.length(text).cast("long"), was["n_chars"])
    return copies.select(*[now[c].alias(c) for c in columns])


# Which sources reach their caps is found in order of cap by weight: the level that the others would get, once every
# source before them has its cap, is right where it first stays within a source's own.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight FROM s),
c AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
        (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER earlier, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
      FROM w WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, ratio) AS level FROM c WHERE level <= ratio),
t AS (SELECT source, source_size, round(least(weight * coalesce((SELECT level FROM l), 0), 2.0::DOUBLE * source_size), 6) AS target FROM w),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget,
        CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(concat_ws('/', '11', CAST(d.doc_id AS VARCHAR), CAST(d.size AS VARCHAR))), d.doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - ahead)) AS BIGINT) AS taken,
       CAST(epochs AS BIGINT) AS epochs, CAST(greatest(0, least(size, rest - ahead)) AS BIGINT) AS partial FROM p
"""


@query("op10_mix_sources", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix(read(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "epochs", "partial")
