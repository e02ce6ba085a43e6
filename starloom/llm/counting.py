"""Token counts by overlap resynchronisation (operator 9).

A document longer than a chunk is cut into overlapping chunks, which are encoded in parallel with offsets. Two
neighbours are spliced at a position where both have a boundary between pre-tokens, well before the left chunk's end:
the pre-tokenizer only looks ahead, so from a common boundary on both read the same text alike, and what follows it
does not depend on what came before. A pair without such a position is encoded again with a wider overlap, up to the
rest of the document, so the count is that of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import read, ship, store, text_or_empty
from .registry import query
from .vocab import count_encoder, path, tokenizer

CHUNK = 32_768
OVERLAP = 512
#: Characters that the left chunk must still have after a splice: more than any look-ahead or special token needs.
AHEAD = 64


def _boundaries(encoding) -> dict[int, int]:
    """Position of every pre-token's start -> number of ids before it."""
    out, last = {}, None
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word is None or word != last:
            out[start] = i
        last = word
    return out


def _spans(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Chunks of ``chunk`` characters, each reaching ``overlap`` into the next; the one that reaches the end is the last."""
    last = max(0, length - overlap - 1) // chunk
    return [(k * chunk, min(length, (k + 1) * chunk + overlap)) for k in range(last + 1)]


def _cut(batches: Iterator[pd.DataFrame], chunk: int) -> Iterator[pd.DataFrame]:
    """Rows (row, chunk number, chunks, start, overlap, text); the overlap doubles with every round."""
    for batch in batches:
        for row, overlap, text in zip(batch["row"], batch["overlap"], batch["text"]):
            spans = _spans(len(text), chunk, overlap)
            for k in range(0, len(spans), 16):
                yield pd.DataFrame(
                    [(row, k + i, len(spans), a, overlap, text[a:b]) for i, (a, b) in enumerate(spans[k:k + 16])],
                    columns=["row", "k", "chunks", "start", "overlap", "text"])


def _encode(batches: Iterator[pd.DataFrame], vocabulary: str, chunk: int, ahead: int) -> Iterator[pd.DataFrame]:
    """Per chunk its ids, and in the overlaps at its head and tail: boundary positions and the ids before them."""
    encoder = tokenizer(vocabulary)
    for batch in batches:
        out = []
        for row, k, chunks, start, overlap, text in batch[["row", "k", "chunks", "start", "overlap", "text"]].itertuples(index=False):
            encoding = encoder.encode(text, add_special_tokens=False)
            marks = {start + at: n for at, n in _boundaries(encoding).items()}
            head = {p: n for p, n in marks.items() if k and start < p <= start + overlap - ahead}
            tail = {p: n for p, n in marks.items() if k < chunks - 1 and start + chunk < p <= start + len(text) - ahead}
            out.append((row, k, len(encoding.ids), head, tail))
        yield pd.DataFrame(out, columns=["row", "k", "ids", "head", "tail"])


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row; null and empty texts count 0.

    Exact at any length: a text up to ``chunk`` characters is one chunk; longer ones are spliced. Repeated rows are
    counted one by one, other columns are not read.
    """
    if overlap < 32 or chunk < 1:
        raise ValueError("chunks need a length and an overlap of at least 32 characters")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    short = F.length("text") <= chunk

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = count_encoder(vocabulary)
        for batch in batches:
            batch["n_tokens"] = [count(t) for t in batch["text"]]
            yield batch.drop(columns="text")

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = F.octet_length("text").cast("long").alias("n_bytes")
    small = rows.filter(short).select("doc_id", size, "text").mapInPandas(
        counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    large = store(rows.filter(~short).select(F.monotonically_increasing_id().alias("row"), "doc_id", size, "text"), "long-texts")
    total = spliced(large.select("row", "text"), vocabulary, chunk, overlap)
    long = large.drop("text").join(total, "row").select("doc_id", "n_bytes", "n_tokens")
    return small.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)


def ahead_of(overlap: int) -> int:
    return min(AHEAD, overlap // 2)


def spliced(texts: DataFrame, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens) of texts of any length; ``texts`` has (row, text) and is read once per widening.

    Documents whose chunks do not all align go through another round with twice the overlap. Once it spans the
    document the first chunk holds the whole text, so the loop ends.
    """
    todo, done, width = texts.withColumn("overlap", F.lit(overlap)), None, overlap
    while True:
        ahead = ahead_of(width)
        parts = todo.mapInPandas(lambda b: _cut(b, chunk), "row long, k int, chunks int, start long, overlap int, text string")
        parts = parts.repartition(F.col("row"), F.col("k"))
        coded = store(parts.mapInPandas(
            lambda b, ahead=ahead: _encode(b, vocabulary, chunk, ahead),
            "row long, k int, ids long, head map<long,long>, tail map<long,long>"), "chunks")
        following = Window.partitionBy("row").orderBy("k")
        # The first position both sides know; ids of the left part before it, of the right part from it on.
        paired = coded.withColumn("next", F.lead("head").over(following))
        common = F.array_min(F.array_intersect(F.map_keys("tail"), F.map_keys("next")))
        paired = paired.withColumn("at", F.when(F.col("next").isNotNull(), common))
        sums = paired.groupBy("row").agg(
            F.bool_or(F.col("next").isNotNull() & F.col("at").isNull()).alias("apart"),
            F.sum(F.when(F.col("at").isNull(), F.col("ids")).otherwise(F.element_at("tail", F.col("at")))).alias("kept"),
            F.sum(F.coalesce(F.element_at("next", F.col("at")), F.lit(0))).alias("skipped"))
        sums = store(sums, "splices")
        good = sums.filter(~F.col("apart")).select("row", (F.col("kept") - F.col("skipped")).alias("n_tokens"))
        done = good if done is None else done.unionByName(good)
        apart = sums.filter("apart").select("row")
        if apart.isEmpty():
            return done
        width = width * 2
        todo = texts.join(apart, "row", "left_semi").withColumn("overlap", F.lit(width))


@query("op9_count_tokens")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))
