"""Best-fit packing of documents into sequences by bin completion (operator 8).

Tokens are needed once, for lengths and checksums. How sequences are filled depends only on how often each length
occurs, a table of at most ``capacity`` rows whatever the corpus; that table is counted by Spark and the plan is
searched on it (``bins.complete``). Documents then find their places in parallel: the r-th document of a length takes
the plan's r-th place for that length. Ranks come from counts by (length, salt), so a length that a third of all
documents have is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bins import Fill, complete
from .common import read, ship, store, text_or_empty
from .registry import query
from .vocab import ids_encoder, path

SALTS = 64


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every row: its ids, then ``end_id``, cut only beyond ``capacity``.

    Null and empty texts hold ``end_id`` alone. Equal rows give equal pieces, once per row.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = ids_encoder(vocabulary)
        tail = np.array([end_id], "<u4").tobytes()
        width = capacity * 4
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                data = encode(text) + tail
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at:at + width]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(cut, schema)


def places(fills: list[Fill]) -> pd.DataFrame:
    """One row per length and run of ranks: rank r of ``length`` goes to sequence ``sequence + r - rank``."""
    out, ranks, sequence = [], {}, 0
    for fill in fills:
        offset = 0
        for n in fill.lengths:
            rank = ranks.get(n, 0)
            out.append((n, rank, sequence, offset))
            ranks[n] = rank + fill.times
            offset += n
        sequence += fill.times
    return pd.DataFrame(out, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"])


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored rows with a ``length`` of 1 to ``capacity``; other columns stay.

    Equal rows get different places. An empty table stays empty. ``parts`` is read twice, so store it first.
    """
    ship(parts.sparkSession)
    columns = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    salted = parts.select("length", F.struct(*columns).alias("row")).withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    counts = store(salted.groupBy("length", "salt").count(), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = places(complete(totals, capacity))
    starts = np.concatenate([plan["length"].to_numpy(np.int64) << 44 | plan["rank"].to_numpy(np.int64)])
    sequences, offsets = plan["sequence"].to_numpy(np.int64), plan["offset"].to_numpy(np.int64)

    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "salt", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "salt").orderBy(F.xxhash64(F.lit(1), "row"), F.col("row"))
    ranked = salted.join(first, ["length", "salt"]).withColumn("rank", F.col("first") + F.row_number().over(order) - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            at = np.searchsorted(starts, length << 44 | rank, side="right") - 1
            batch["sequence_id"] = sequences[at] + rank - (starts[at] & (1 << 44) - 1)
            batch["offset"] = offsets[at]
            yield batch.drop(columns="rank")

    flat = ranked.select(*[F.col("row").getField(c).alias(c) for c in columns], "rank")
    schema = ", ".join(f"`{c}` {parts.schema[c].dataType.simpleString()}" for c in columns)
    return flat.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048) -> DataFrame:
    """Tokenize, cut and pack whole documents; see ``pieces`` and ``pack``."""
    return pack(store(pieces(docs, vocabulary, capacity), "pieces"), capacity)


@query("op8_pack_documents")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), path("word_bpe_49k.json"))
