"""Language of web pages by fusing evidence (operator 6).

Four witnesses speak for each page: the text, by character n-gram likelihoods learned from documents of known language;
the language that the markup declares; the suffix of the address; and the host, whose prior is smoothed by its
domain's and that by the whole corpus'. How far declaration and suffix can be trusted is counted, not assumed: a grouped
count of text verdicts by declared language, and by suffix. The prior of a host leaves the page itself out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read, ship, store
from .registry import query

#: Labelled documents that the text model is fitted on at most, the first in hash order.
SAMPLE = 6_000
#: Documents that a language has in the sample at least, as far as it has them; if need be they are added to it.
LEAST = 200
BUCKETS = 1 << 14
#: The text's log likelihood counts as that of this many independent n-grams at most: neighbouring ones overlap.
EVIDENCE = 60.0

#: Languages that a text model can have: a row of buckets each stands in the driver and in every worker.
LANGUAGES = 1_000

_ELEMENTS = "script|style|nav|header|footer|aside|noscript|template"
_OPENS = re.compile(f"<!--|<(?:({_ELEMENTS})|(div))\\b", re.I | re.A)
_CLOSES = re.compile(f"-->|</({_ELEMENTS}|div)\\s*>", re.I | re.A)
_ADVERT = re.compile("class=[\"']?ad\\b", re.I | re.A)
_TAGS = re.compile(r"<[^>]*>|&[a-zA-Z#0-9]{2,8};")


def _next(places: list[tuple[int, int]], at: int) -> tuple[int, int] | None:
    i = bisect_left(places, (at, 0))
    return places[i] if i < len(places) else None


def page_text(html: str | None) -> str:
    """What a page says: without comments, scripts, frame elements and adverts, tags and entities as blanks.

    An element ends at the next closing tag of its name; what is never closed stays, but for the tag itself. Every
    closing tag is found once, so the time follows the length of the page, whatever its markup.
    """
    html = html or ""
    closes: dict[str, list[tuple[int, int]]] = {}
    for m in _CLOSES.finditer(html):
        closes.setdefault((m[1] or "-->").lower(), []).append(m.span())
    adverts = [m.span() for m in _ADVERT.finditer(html)]
    ends = [m.span() for m in re.finditer(">", html)] if adverts else []
    pieces, at = [], 0
    for m in _OPENS.finditer(html) if closes else ():
        if m.start() < at:
            continue
        if m[2]:
            advert, end = _next(adverts, m.end()), _next(ends, m.end())
            if not advert or end and end < advert:
                continue
        close = _next(closes.get((m[1] or m[2] or "-->").lower(), []), m.end())
        if close:
            pieces.append(html[at:m.start()])
            at = close[1]
    text = " ".join([*pieces, html[at:]])
    last = text.rfind(">") + 1  # behind it no tag can end
    return _TAGS.sub(" ", text[:last]) + re.sub(r"&[a-zA-Z#0-9]{2,8};", " ", text[last:])


def _grams(text: str) -> np.ndarray:
    """Buckets of the 1- to 3-grams of letters, words padded by blanks."""
    letters = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    points = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    out = []
    for n in (1, 2, 3):
        if len(points) >= n:
            key = np.full(len(points) - n + 1, n, np.uint64)
            for i in range(n):
                key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ points[i:len(points) - n + 1 + i]
            key = (key ^ key >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
            out.append((key >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(out).astype(np.int64) if len(letters) > 2 else np.zeros(0, np.int64)


class TextModel:
    """Languages and, per language, the log probability of every n-gram bucket."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    def likelihoods(self, text: str) -> list[float]:
        grams = _grams(text)
        if not len(grams) or not self.languages:
            return [0.0] * len(self.languages)
        mean = self.logs[:, grams].mean(axis=1)
        return ((mean - mean.max()) * min(EVIDENCE, float(len(grams)))).tolist()


def train(docs: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Count n-grams by language over up to ``sample`` documents, and about ``LEAST`` more of each language rare in them.

    Languages are all that occur; more than ``LANGUAGES`` of them are an error. Null texts and languages are left out.
    """
    ship(docs.sparkSession)
    chosen = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").alias("doc_id"), "lang")
    chosen = chosen.orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id", "lang").limit(sample).distinct()
    texts = docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")
    every = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    numbers = every.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("distinct"))
    numbers = numbers.limit(LANGUAGES + 1).collect()
    if len(numbers) > LANGUAGES:
        raise ValueError(f"documents name more than {LANGUAGES} languages")
    total = sum(r["n"] for r in numbers)
    rare = [(r["lang"], min(1.0, LEAST / max(1, r["distinct"]))) for r in numbers if r["n"] * sample < LEAST * total and total > sample]
    if rare:
        shares = docs.sparkSession.createDataFrame(rare, "lang string, share double")
        more = every.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        texts = texts.join(F.broadcast(shares), "lang", "left_anti").unionByName(more.dropDuplicates(["lang", "h"]).select("lang", "text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                seen = np.zeros(BUCKETS, np.int64)
                for text in part["text"]:
                    seen += np.bincount(_grams(text), minlength=BUCKETS)
                at = np.flatnonzero(seen)
                yield pd.DataFrame({"lang": lang, "bucket": at, "seen": seen[at]})

    counts = texts.mapInPandas(count, "lang string, bucket long, seen long").groupBy("lang", "bucket").agg(
        F.sum("seen").alias("seen")).toPandas()  # at most languages x BUCKETS rows
    languages = sorted(counts["lang"].unique())
    table = np.full((len(languages), BUCKETS), 0.5)
    for i, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        table[i, own["bucket"].to_numpy(np.int64)] += own["seen"].to_numpy(float)
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _sums(column: str, size: int) -> Column:
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)])


def identify(pages: DataFrame, model: TextModel, strength: float = 20.0) -> DataFrame:
    """Per row: page_id, lang, probability, text_lang, declared, suffix, host.

    ``pages`` has page_id, url and html; ``strength`` is the number of pages that a prior one level up weighs. Missing
    evidence (null or empty html, no declaration, no address) says nothing; a page without any gets the language that
    is most common. Ties go to the language first in alphabetical order, repeated rows are pages of their own. Without
    languages in the model lang is null. Other columns are not read.
    """
    ship(pages.sparkSession)
    size = len(model.languages)
    if not size:
        return pages.select("page_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("declared", "string"), ("suffix", "string"), ("host", "string"))])

    def read_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [model.likelihoods(page_text(h)) for h in batch["html"]]
            yield batch.drop(columns="html")

    declared = F.lower(F.regexp_extract(F.col("html"), r"(?i)<html\b[^>]{0,400}?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))
    host = F.lower(F.regexp_extract(F.col("url"), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    empty = lambda c: F.when(F.length(c) > 0, c)
    rows = pages.select("page_id", empty(declared).alias("declared"), empty(host).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = rows.mapInPandas(read_text, f"page_id {kind}, declared string, host string, text array<double>")
    parts = F.split("host", r"\.")
    rows = rows.withColumns({
        "suffix": F.element_at(parts, -1), "domain": F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), "."),
        "belief": _softmax(F.col("text"))})
    rows = store(rows, "pages")

    # Each table is counted from the one below it and stored: a small one is then replicated, and with a large one the
    # pages of a hot host, or those without a host, can be split over tasks.
    def table(source: DataFrame, keys: list[str], name: str, of: str) -> DataFrame:
        return store(source.filter(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(_sums(of, size).alias(name)), f"pages-by-{keys[-1]}")

    overall = rows.agg(_sums("belief", size)).first()[0]
    overall = [x or 0.0 for x in overall] if overall else [0.0] * size
    total = sum(overall)
    base = F.array(*[F.lit((x + 1.0) / (total + size)) for x in overall])
    totals = F.array(*[F.lit(float(x)) for x in overall])

    def witness(seen: DataFrame, column: str) -> DataFrame:
        """log P(value | language), smoothed towards the value's share of all pages."""
        share = F.aggregate("seen", F.lit(0.0), lambda a, x: a + x) / F.lit(max(total, 1.0))
        return seen.select(column, F.zip_with("seen", totals, lambda s, n: F.log((s + strength * share) / (n + strength))).alias(f"{column} log"))

    by_host = table(rows, ["domain", "host"], "host seen", "belief")
    by_domain = table(by_host, ["domain"], "domain seen", "host seen")
    suffixes = by_domain.withColumn("suffix", F.element_at(F.split("domain", r"\."), -1))
    by_suffix = table(suffixes, ["suffix"], "seen", "domain seen")
    by_declared = table(rows, ["declared"], "seen", "belief")
    joined = (
        rows.join(by_host, ["domain", "host"], "left").join(by_domain, "domain", "left")
        .join(witness(by_declared, "declared"), "declared", "left").join(witness(by_suffix, "suffix"), "suffix", "left"))
    nothing = F.array(*[F.lit(0.0)] * size)

    def without_self(column: str) -> Column:
        return F.zip_with(F.coalesce(F.col(column), nothing), F.when(F.col(column).isNotNull(), F.col("belief")).otherwise(nothing),
                          lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def prior(seen: Column, above: Column) -> Column:
        number = F.aggregate(seen, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(seen, above, lambda s, p: (s + strength * p) / (number + strength))

    joined = joined.withColumn("domain prior", prior(without_self("domain seen"), base))
    joined = joined.withColumn("host prior", prior(without_self("host seen"), F.col("domain prior")))
    logs = F.transform("host prior", lambda p: F.log(p))
    for column in ("text", "declared log", "suffix log"):
        logs = F.zip_with(logs, F.coalesce(F.col(column), nothing), lambda a, b: a + b)
    joined = joined.withColumn("posterior", _softmax(logs))
    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    text = F.col("belief")
    return joined.select(
        "page_id", best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"),
        best(text).alias("text_lang"), "declared", "suffix", "host")


@query("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "pages"), train(read(spark, sf_dir, "documents")))
