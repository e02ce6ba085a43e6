"""How filters interact in every order (operator 13).

A document is reduced to a mask of the filters that it fails, and a part of the corpus to the count of documents of each
mask. All orders of the filters are then folded over those few cells with higher-order functions: per cell, ``aggregate``
walks an order and carries the filters met so far, ``transform`` does so for all orders, and the cells' 600 weighted
structs are merged by elementwise sums. The corpus is read once, whatever the number of orders.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, store, text_or_empty
from .registry import query

SPACES = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
COPY = LETTERS.index("E")  # this filter looks at the whole table
ORDERS = ["".join(order) for order in permutations(LETTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D, which look at one text: too short, repetitive, capital letters, marks."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    conditions = [
        F.size(words) < 50,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(65) * F.size(words),
        F.lit(100) * capitals.cast("long") > F.lit(5) * F.char_length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)), F.lit(0))


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): documents with their masks; ``n`` equal rows come as one.

    The copy filter E needs the least doc_id of every text. Texts are compared by their SHA-256, and rows that share
    one meet in a minimum that each task takes first; the rows it is handed back to are found by text and doc_id
    together, so a text that a third of the table repeats stays dealt over all tasks.
    """
    text = text_or_empty()
    light = store(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
        own_failures(text).alias("mask")).groupBy("doc_id", "part", "digest", "mask").count(), "masks")
    first = light.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
    first = first.withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return light.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.when(copy, F.col("mask") + F.lit(1 << COPY)).otherwise(F.col("mask")).alias("mask"),
        F.col("count").alias("n"))


def cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): at most 128 rows a part."""
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    no = F.lit(False)
    return masked.join(marks, "doc_id", "left").groupBy(
        "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(
        F.sum("n").alias("n"))


def _orders() -> Column:
    """All orders of the filters' bits: an array of arrays, the same 120 in every task."""
    return F.array(*[F.array(*[F.lit(1 << LETTERS.index(c)) for c in order]) for order in ORDERS])


def _walk(order: Column, cell: Column) -> Column:
    """One struct of weighted counts per step of ``order`` for a cell."""
    mask, n = cell["mask"], cell["n"]

    def step(state: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        gone = mask.bitwiseAND(state["met"]) != 0
        removed = fails & ~gone
        weight = lambda c: F.when(c, n).otherwise(F.lit(0).cast("long"))
        counts = F.struct(
            weight(~fails & ~gone).alias("kept"), weight(removed).alias("removed"), weight(fails & gone).alias("redundant"),
            weight(mask == bit).alias("unique_fails"), weight(removed & cell["good"]).alias("good_lost"),
            weight(removed & cell["toxic"]).alias("toxic_lost"))
        return F.struct(state["met"].bitwiseOR(bit).alias("met"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    counts_type = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(0).alias("met"), F.array().cast(counts_type).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _add(a: Column, b: Column) -> Column:
    return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) per step of all orders.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic; other columns are not read. Null texts
    are empty, null sources count with the empty one. Every row counts, repeated ones too; rows that share a doc_id
    and a text are no copies of each other, as neither has the smaller id; rows without doc_id are no copies and have no labels. A document
    is good or toxic if any of its label rows says so; null marks say nothing. No documents give no rows.
    """
    found = cells(failures(docs), labels)
    per_part = found.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    orders = _orders()
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])
    steps = len(LETTERS)
    total = F.aggregate(
        "cells", F.array_repeat(none, steps * len(ORDERS)),
        lambda sums, cell: F.zip_with(sums, F.flatten(F.transform(orders, lambda order: _walk(order, cell))), _add))
    names = F.array(*[F.lit(order) for order in ORDERS])
    merged = per_part.select("part", total.alias("sums"))
    placed = merged.select("part", F.posexplode("sums").alias("at", "sum")).select(
        "part", F.element_at(names, F.expr(f"int(at div {steps} + 1)")).alias("filter_order"),
        (F.col("at") % steps + 1).cast("int").alias("step"), *[F.col(f"sum.{c}").alias(c) for c in COUNTS])
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    same = Window.partitionBy("part", "letter")  # the parts lie together already
    return placed.withColumn("letter", letter).withColumn("shapley", F.sum("removed").over(same)).drop("letter")


OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS copy FROM documents),
m AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN copy THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
      FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)),
p AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit,
        CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS met
      FROM p, range(1, 6) AS r(step)),
r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (WHERE mask & (met | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & met = 0), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & met <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
    coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & met = 0 AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & met = 0 AND toxic), 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


@query("op13_filter_audit", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
