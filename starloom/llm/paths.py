"""Near copies of texts: an n-gram Jaccard join by chosen paths (operator 5).

A path is a run of min-hash positions with their values; documents that share a path share that many sampled shingles.
Every bucket (path) of more than a few documents chooses two positions by a hash of the path, and its documents go on
to the buckets that their values there name. Two documents of similarity s meet in a given child with chance s, so
with two children per bucket a pair at 0.8 survives any number of levels with chance 0.93 at least (``survival``); whole
runs are repeated until the target recall. Small buckets, and buckets whose documents are so alike that splitting
would not thin them out, are compared pair by pair, in tiles: min-hashes pick candidates, shingle sets decide.

Documents with the same shingles are one class from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import connected_components, grouped, read, ship, store
from .registry import query
from .shingles import HASHES, minhash, shingles

#: Equal min-hashes of 64 that make a pair a candidate: four standard deviations below what 0.8 expects.
ALIKE = 38
SMALL = 64
TILE = 1_024
LEVELS = 8


def survival(similarity: float, branches: int = 2) -> float:
    """The chance that a pair still shares a path after any number of levels: the fixed point of the branching process."""
    alive = 1.0
    for _ in range(200):
        alive = 1 - (1 - similarity * alive) ** branches
    return alive


def runs_for(similarity: float, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity))))


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, mark, text in zip(batch["doc_id"], batch["mark"], batch["text"]):
            s = shingles(text)
            out.append((doc, mark, xxhash.xxh3_128_digest(s.tobytes()), minhash(s).tolist()) if len(s) else (doc, mark, None, None))
        yield pd.DataFrame(out, columns=["doc_id", "mark", "set", "least"])


def _children(rows: DataFrame) -> DataFrame:
    """Both children of every row's bucket: (path, child, way, id), from rows (path, id, least)."""
    first = F.pmod(F.xxhash64(F.lit(1), "path"), F.lit(HASHES))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64(F.lit(2), "path"), F.lit(HASHES - 1)), F.lit(HASHES))
    ways = rows.withColumn("way", F.explode(F.array(first, second)))
    value = F.get("least", F.col("way").cast("int"))
    return ways.select("path", F.xxhash64("path", "way", value).alias("child"), "way", "id")


def _buckets(classes: DataFrame, runs: int) -> DataFrame:
    """(path, id) of all buckets to compare, each of two documents or more."""
    least = classes.select("id", "least")
    rows = least.select(F.explode(F.array(*[F.xxhash64(F.lit(101 + r)) for r in range(runs)])).alias("path"), "id", "least")
    final = []
    for level in range(LEVELS + 1):
        split = store(_children(rows), "paths")
        sizes = store(split.groupBy("path", "way", "child").agg(F.count(F.lit(1)).alias("size")), "path-sizes")
        if level:
            # Sum of the children's squares over twice the bucket's: the mean share of the bucket that a document meets.
            alike = sizes.groupBy("path").agg(
                (F.sum(F.col("size") * F.col("size")) * 2 / F.pow(F.sum("size"), F.lit(2))).alias("alike"))
            whole = store(alike.filter((F.col("alike") >= 0.5) | F.lit(level == LEVELS)).select("path"), "whole-paths")
            final.append(rows.select("path", "id").join(whole, "path", "left_semi"))
            split, sizes = split.join(whole, "path", "left_anti"), sizes.join(whole, "path", "left_anti")
        sizes = sizes.filter("size > 1").select(F.col("child").alias("path"), "size")
        paired = split.select(F.col("child").alias("path"), "id").join(sizes, "path")
        paired = store(paired, "path-rows")
        final.append(paired.filter(F.col("size") <= SMALL).select("path", "id"))
        large = paired.filter(F.col("size") > SMALL).select("path", "id")
        if level == LEVELS or large.isEmpty():
            break
        rows = store(large.join(least, "id"), "large-paths")
    return reduce(DataFrame.unionByName, final).distinct()


def _tiled(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows (path, id, ...) with the tasks (a, b), a <= b, that compare the tiles of a bucket of ``members``.

    The sizes are written first: joined as the grouping leaves them, a large bucket's rows could not be split.
    """
    sizes = store(members.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "bucket-sizes")
    out = rows.join(sizes, "path").withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
    out = out.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return out.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other")).drop("size", "tiles", "other")


def _first_here(batch: pd.DataFrame) -> np.ndarray:
    """Pairs (i < j) that this task compares: across its two tiles, and not in a bucket of lesser name that they share."""
    a, b, tile, name = int(batch["a"].iloc[0]), int(batch["b"].iloc[0]), batch["tile"].to_numpy(), batch["path"].iloc[0]
    pairs = np.triu(np.ones((len(batch),) * 2, bool), 1)
    if a != b:
        pairs &= tile[:, None] != tile[None, :]
    before: dict[int, list[int]] = {}
    for i, own in enumerate(batch["paths"]):
        for other in own:
            if other < name:
                before.setdefault(other, []).append(i)
    for rows in before.values():
        if len(rows) > 1:
            pairs[np.ix_(rows, rows)] = False
    return pairs


def _candidates(batch: pd.DataFrame) -> dict[str, np.ndarray]:
    """Documents of the bucket with a candidate pair that no other bucket takes care of."""
    pairs = _first_here(batch)
    if pairs.any():
        least = np.stack(batch["least"].to_numpy())
        if len(least) <= SMALL:
            alike = (least[:, None] == least[None]).sum(axis=2)
        else:
            alike = np.zeros(pairs.shape, np.uint8)
            for column in least.T:
                alike += column[:, None] == column[None, :]
        pairs &= alike >= ALIKE
    ids = batch["id"].to_numpy(np.int64)[pairs.any(0) | pairs.any(1)]
    return {"path": np.full(len(ids), batch["path"].iloc[0]), "id": ids}


def _verified(batch: pd.DataFrame, similarity: float) -> dict[str, np.ndarray]:
    """Links of each document in the bucket and the least document of its linked group."""
    ids, n, pairs = batch["id"].to_numpy(np.int64), batch["n"].to_numpy(np.int64), _first_here(batch)
    if not pairs.any():
        return {"id": ids[:0], "links": ids[:0], "least": ids[:0]}
    sets = [np.frombuffer(s, np.uint64) for s in batch["shingles"]]
    sizes = np.array([len(s) for s in sets])
    every, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles of one document alone are in no intersection; the others get a bit each.
    shared = often > 1
    bit = np.cumsum(shared) - 1
    words = max(1, -(-int(shared.sum()) // 64))
    bits = np.zeros((len(ids), words), np.uint64)
    at = np.repeat(np.arange(len(ids)), sizes)
    use = shared[inverse]
    np.bitwise_or.at(bits, (at[use], bit[inverse[use]] >> 6), np.uint64(1) << (bit[inverse[use]] & 63).astype(np.uint64))
    linked = np.zeros(pairs.shape, bool)
    for i in np.flatnonzero(pairs.any(1)):
        js = np.flatnonzero(pairs[i])
        js = js[np.minimum(sizes[js], sizes[i]) >= similarity * np.maximum(sizes[js], sizes[i]) - 1e-9]
        common = np.bitwise_count(bits[js] & bits[i]).sum(axis=1, dtype=np.int64)
        linked[i, js[common >= similarity * (sizes[js] + sizes[i] - common) - 1e-9]] = True
    linked |= linked.T
    some = linked.any(1)
    label = ids[some].copy()
    links = linked[np.ix_(some, some)]
    while len(label):
        new = np.minimum(label, np.where(links, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            break
        label = new
    return {"id": ids[some], "links": links @ n[some], "least": label}


def near_texts(docs: DataFrame, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """Per row: doc_id, n_links, component_id, kept.

    Linked are documents whose sets of five-word shingles (lower case, split at white space) have a Jaccard similarity
    of ``similarity`` or more, by exact comparison; the join may miss a pair with chance 1 - ``recall`` at most at
    the threshold, less above it. n_links counts the other documents linked directly, copies included; component_id is the least
    doc_id reachable by links and kept marks that document. Texts of one to four words are one shingle. Texts that are
    null or without words link with nothing; repeated rows are documents linked with each other, rows with a null
    doc_id link with nothing. Rows of one doc_id with different texts are documents of their own. Other columns are not read.
    """
    return _joined(docs, *_classes(docs), similarity, recall).drop("mark")


def _mark() -> Column:
    """Names a row by its doc_id and text, nulls included: rows that share it are repetitions."""
    own = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat_ws("/", own, F.coalesce(F.concat(F.lit("text"), "text"), F.lit("null")))))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, mark, set) and the classes of equal sets: (id, doc, mark, set, n, least).

    A class has a number of its own, given when it is stored; ``doc`` is the least doc_id that has its set, ``mark``
    the name of such a row.
    """
    ship(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _mark().alias("mark"),
        F.when(F.col("doc_id").isNotNull(), F.col("text")).alias("text"))
    signed = store(texts.mapInPandas(_signed, "doc_id long, mark binary, set binary, least array<int>"), "signed")
    classes = signed.filter(F.col("set").isNotNull()).groupBy("set").agg(
        F.min(F.struct("doc_id", "mark")).alias("row"), F.count(F.lit(1)).alias("n"), F.min("least").alias("least"))
    classes = classes.select("set", F.col("row.doc_id").alias("doc"), F.col("row.mark").alias("mark"), "n", "least")
    return signed.select("doc_id", "mark", "set"), store(classes.withColumn("id", F.monotonically_increasing_id()), "classes")


def _joined(docs: DataFrame, signed: DataFrame, classes: DataFrame, similarity: float, recall: float) -> DataFrame:
    buckets = store(_buckets(classes, runs_for(similarity, recall)), "buckets")
    # A document has at most 2 ** LEVELS paths a run, two or so where buckets are small.
    paths = store(buckets.groupBy("id").agg(F.sort_array(F.collect_list("path")).alias("paths")), "own-paths")
    wide = buckets.join(paths, "id").join(classes.select("id", "least"), "id")
    needed = store(grouped(_tiled(wide, buckets), ["path", "a", "b"], _candidates, "path long, id long").distinct(), "needed")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "shingles": [shingles(t).tobytes() for t in batch["text"]]})

    # Shuffled at every size: few documents are wanted, but their number grows with the corpus.
    wanted = needed.select("id").distinct().join(classes.select("id", "mark"), "id").hint("merge")
    texts = docs.select(_mark().alias("mark"), "text").join(wanted, "mark").dropDuplicates(["mark"])
    shingled = store(texts.select("id", "text").mapInPandas(sets, "id long, shingles binary"), "sets")
    rows = needed.join(paths, "id").join(classes.select("id", "n"), "id").join(shingled, "id")
    found = store(grouped(
        _tiled(rows, needed), ["path", "a", "b"], lambda batch: _verified(batch, similarity), "id long, links long, least long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = connected_components(found.select(F.col("id").alias("u"), F.col("least").alias("v")))
    # Components are named by their least doc_id; only linked classes have one.
    members = store(linked.join(classes.select(F.col("id").alias("node"), "doc"), "node"), "members")
    names = members.groupBy("component").agg(F.min("doc").alias("name"))
    named = members.join(names, "component").select(F.col("node").alias("id"), "name")
    described = classes.select("set", "id", "doc", "n").join(links, "id", "left").join(named, "id", "left").select(
        "set", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("name", "doc").alias("component"))
    out = signed.join(described, "set", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "mark")


def one_of_each(docs: DataFrame, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One document of each group of near copies, with all its columns: the one of least doc_id.

    Documents without words stay, as they link with nothing; rows equal in doc_id and text stay once. Rows of one
    doc_id with different texts are told apart.
    """
    kept = _joined(docs, *_classes(docs), similarity, recall).filter("kept").select(F.col("mark").alias("kept")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _mark().alias("mark"))
    rows = rows.join(kept, F.col("mark") == F.col("kept"), "left_semi").dropDuplicates(["mark"])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[^ \t\n\r\f\v]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))]) AS s
      FROM w WHERE len(w) > 0),
g AS MATERIALIZED (SELECT doc_id, len(s) AS size, unnest(s) AS shingle FROM s),
e AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS w FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING count(*) >= 0.8 * (any_value(a.size) + any_value(b.size) - count(*))),
reach AS (SELECT u, w FROM e UNION SELECT reach.u, e.w FROM reach JOIN e ON reach.w = e.u),
n AS (SELECT u, count(*) AS n_links FROM e GROUP BY u), m AS (SELECT u, min(w) AS least FROM reach GROUP BY u)
SELECT doc_id, coalesce(n_links, 0) AS n_links, least(doc_id, coalesce(m.least, doc_id)) AS component_id,
       doc_id <= coalesce(m.least, doc_id) AS kept
FROM documents LEFT JOIN n ON n.u = doc_id LEFT JOIN m ON m.u = doc_id
"""


@query("op5_chosen_paths", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_texts(read(spark, sf_dir, "documents"))
