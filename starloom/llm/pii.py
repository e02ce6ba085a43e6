"""Personal data by bootstrapped contextual extraction (operator 1), with DataFrame functions only.

Base identifiers follow fixed expressions and checks. They are the seeds: the words before them are lexical patterns,
patterns and values form a graph, and scores travel along its edges for a few rounds, from seeds to patterns to further
values. Values that look like identifiers, match no base expression and stand in trusted patterns are added.

Possessive quantifiers and look-behinds below change no match; they keep the engine from going back over long runs,
so the time is linear in the text and the stack does not grow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, store
from .registry import query

# The expressions of the four kinds, in their order.
KINDS = ("email", "ip", "card", "phone")
EXPRESSIONS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What may be an identifier of a form that no expression above knows, of any length: groups of digits joined by blanks,
#: brackets, dots or hyphens, or a token with digits or an at sign in it. Letters right after a run of groups are taken
#: along, so that the engine does not try the run again from its next group; such a value has no number's shape.
CANDIDATE = (
    r"(?<![^\s(\[:=,;\"'<])(?:[+(]{0,2}[0-9]++(?:[\x20().-]{1,3}+[0-9]++)++(?:[A-Za-z@/%_+][A-Za-z0-9+@._%/-]*+)?+"
    r"|(?=[A-Za-z0-9+])(?:[A-Za-z+][A-Za-z+._%/-]*+)?+[0-9@][A-Za-z0-9+@._%/-]*[A-Za-z0-9])")
LEAST = 6  # characters of a candidate
#: Quick tests that a text must pass for its expression to be worth running.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum, read from the right."""
    back = F.reverse(digits)
    doubled = F.translate(back, "0123456789", "0246813579")
    place = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(place, F.lit(0), lambda a, i: a + F.when(i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
        F.substring(doubled, i, F.lit(1)).cast("int")))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    small = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{small}\.{small}\.{small}\.{small}$"))
        .when(kind == "card", F.length(digits).between(16, 19) & _luhn(digits))
        .when(kind == "phone", F.length(digits).between(8, 15)))


def _hits(text: Column, expression: str, needed: str) -> Column:
    """Matches in order: the length of the gap before each (code points and bytes), the match, and the words left of it."""
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    gaps = F.split(text, expression, -1)

    def hit(match: Column, gap: Column) -> Column:
        line = F.regexp_replace(F.substring_index(gap, "\n", -1), "[ \t]++", " ")
        return F.struct(
            F.length(gap).alias("gap"), F.octet_length(gap).alias("bytes"), match.alias("value"),
            F.substring_index(F.rtrim(line, F.lit(" \"'(<")), " ", -2).alias("left"))

    none = F.array().cast("array<struct<gap:int,bytes:int,value:string,left:string>>")
    made = F.filter(F.zip_with(found, gaps, hit), lambda h: h["value"].isNotNull())  # behind the last match is a gap more
    return F.when(text.rlike(needed), made).otherwise(none)


def _keyed(docs: DataFrame) -> DataFrame:
    """(key a, key b, row): two hashes of id and text name a document, rows that share them are the same."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("key a"), F.xxhash64(F.lit(5), "text", F.lit(5), "doc_id").alias("key b"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def hits(docs: DataFrame) -> DataFrame:
    """Stored: the document's keys, doc_id and, by kind, the matches of the expressions and of ``CANDIDATE``."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    columns = [_hits(text, EXPRESSIONS[k], NEEDED[k]).alias(k) for k in KINDS]
    columns.append(_hits(text, CANDIDATE, "[0-9@]").alias("other"))
    return store(_keyed(docs.select("doc_id", "text")).select("key a", "key b", "row.doc_id", *columns), "pii")


def _spans(found: DataFrame) -> DataFrame:
    """Every match with its place: (key a, key b, kind, value, left, start, end, from, to), repeated documents once.

    ``start`` and ``end`` are in code points, ``from`` and ``to`` in bytes.
    """
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda h: F.struct(
            F.lit(kind).alias("kind"), *[h[c].alias(c) for c in ("gap", "bytes", "value", "left")]))

    arrays = [named(k) for k in (*KINDS, "other")]
    some = reduce(lambda a, b: a | b, [F.size(k) > 0 for k in (*KINDS, "other")])
    once = found.filter(some).dropDuplicates(["key a", "key b"])
    rows = once.select("key a", "key b", F.posexplode(F.concat(*arrays)).alias("i", "h")).select("key a", "key b", "i", "h.*")
    so_far = Window.partitionBy("key a", "key b", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "end": F.sum(F.col("gap") + F.length("value")).over(so_far).cast("long"),
        "to": F.sum(F.col("bytes") + F.octet_length("value")).over(so_far).cast("long")})
    rows = rows.withColumns({"start": F.col("end") - F.length("value"), "from": F.col("to") - F.octet_length("value")})
    other = F.col("kind") == "other"
    return rows.filter(other & (F.length("value") >= LEAST) | ~other & _valid(F.col("kind"), F.col("value")))


def _patterns(left: Column) -> Column:
    """The one and the two words before a value on its line, in lower case, digits as one sign."""
    tidy = F.regexp_replace(F.lower(F.trim(left)), "[0-9]++", "0")
    two = F.when(tidy.contains(" "), tidy)
    return F.filter(F.array(F.substring_index(tidy, " ", -1), two), lambda p: F.length(p) > 1)


def _shaped(kind: Column, value: Column) -> Column:
    """Whether a value could be of the kind at all."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == "email", value.rlike(r"^[^@\s]++@[^@\s]++$")).when(kind == "ip", value.rlike(r"^[0-9]+(?:[.:/][0-9]+)+$"))
        .when(kind == "card", digits.between(12, 19) & ~value.rlike("[A-Za-z@]"))
        .when(kind == "phone", digits.between(7, 15) & ~value.rlike("[A-Za-z@]")))


def discovered(spans: DataFrame, rounds: int = 3, least_seeds: int = 5, trust: float = 0.7, accept: float = 0.8) -> DataFrame:
    """Further spans (key a, key b, kind, start, end, from, to) that the graph of patterns and values supports.

    Every value has a score for each kind, 1 for seeds. A pattern's score for a kind is the mean over its distinct
    values, with one value of score 0 added; it counts if ``least_seeds`` values support it and it reaches ``trust``.
    A candidate's score is the chance that one of its patterns is right, were they independent. After the last round
    candidates that reach ``accept`` and have the kind's shape are added, unless they overlap a base span.
    """
    by_start = Window.partitionBy("key a", "key b").orderBy("start", F.col("kind") == "other")
    backwards = Window.partitionBy("key a", "key b").orderBy(F.desc("start"), F.desc(F.col("kind") == "other"))
    base = F.col("kind") != "other"
    free = (
        spans.withColumn("covered", F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("ahead", F.min(F.when(base, F.col("start"))).over(backwards.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(base | ((F.coalesce("covered", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True)))))
    placed = store(free.select("key a", "key b", "kind", "value", "start", "end", "from", "to", _patterns(F.col("left")).alias("patterns")), "pii-spans")
    edges = store(
        placed.select("kind", F.lower("value").alias("value"), F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    totals = edges.groupBy("pattern").agg(F.count_distinct("value").alias("values"))
    seeds = edges.filter("kind <> 'other'").select("pattern", "value", "kind", F.lit(1.0).alias("score"))
    candidates = edges.filter("kind = 'other'").select("pattern", "value")
    scores = seeds
    for _ in range(rounds):
        trusted = (
            scores.groupBy("pattern", "kind").agg(F.sum("score").alias("support")).filter(F.col("support") >= least_seeds)
            .join(totals, "pattern").withColumn("trust", F.col("support") / (F.col("values") + 1)).filter(F.col("trust") >= trust))
        missed = F.least(F.sum(F.log(1 - F.least(F.col("trust"), F.lit(0.999)))), F.lit(0.0))
        found = (
            candidates.join(trusted.select("pattern", "kind", "trust"), "pattern").filter(_shaped(F.col("kind"), F.col("value")))
            .groupBy("value", "kind").agg((1 - F.exp(missed)).alias("score")))
        found = store(found, "pii-scores")
        scores = seeds.unionByName(candidates.join(found, "value").select("pattern", "value", "kind", "score"))
    best = found.filter(F.col("score") >= accept).groupBy("value").agg(
        F.max(F.struct("score", "kind"))["kind"].alias("found"))
    return placed.filter("kind = 'other'").withColumn("word", F.lower("value")).join(
        best, F.col("word") == best["value"]).select("key a", "key b", F.col("found").alias("kind"), "start", "end", "from", "to")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, found: DataFrame | None = None, **options) -> DataFrame:
    """Per row: key a, key b, doc_id, the numbers of base spans, base_sha256, spans, n_added and ``parts``.

    ``parts`` are all spans by kind as listed, then start: place, start, end (code points), kind, base, from, to (bytes)
    and before, the furthest byte that an earlier span of the document reaches. Null texts are empty, documents
    without spans have an empty list and its hash; repeated rows give equal rows; an empty table gives none. Only
    doc_id and text are read. Counts and the hash cover the base spans; what the graph adds is in spans and n_added.
    """
    found = hits(docs) if found is None else found
    spans = store(_spans(found), "pii-matches")
    place = reduce(lambda w, k: w.when(F.col("kind") == k, KINDS.index(k)), KINDS[1:], F.when(F.col("kind") == KINDS[0], 0))
    every = spans.filter("kind <> 'other'").select("key a", "key b", "kind", "start", "end", "from", "to", F.lit(True).alias("base")).unionByName(
        discovered(spans, **options).withColumn("base", F.lit(False)))
    earlier = Window.partitionBy("key a", "key b").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("before", F.coalesce(F.max("to").over(earlier), F.lit(0)))
    part = F.struct(place.alias("place"), "start", "end", "kind", "base", "from", "to", "before")
    by_doc = every.groupBy("key a", "key b").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    none = F.array().cast("array<struct<place:int,start:bigint,end:bigint,kind:string,base:boolean,from:bigint,to:bigint,before:bigint>>")
    rows = found.select("key a", "key b", "doc_id").join(by_doc, ["key a", "key b"], "left").withColumn(
        "parts", F.coalesce("parts", none))
    base = F.filter("parts", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "key a", "key b", "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("parts")).alias("spans"),
        F.size(F.filter("parts", lambda s: ~s["base"])).cast("long").alias("n_added"), "parts")


def redacted(docs: DataFrame, **options) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; same columns, n_chars follows the text.

    Overlapping spans become one, named after the one that starts first. Null texts stay null.
    """
    parts = find(docs, **options).filter(F.size("parts") > 0).dropDuplicates(["key a", "key b"]).select("key a", "key b", "parts")
    ordered = F.array_sort(F.transform("parts", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["from"].alias("from"), s["before"].alias("before"))))
    reach = F.array_max(F.transform("parts", lambda s: s["to"]))
    joined = _keyed(docs).join(parts.select("key a", "key b", ordered.alias("spans"), reach.alias("reach")), ["key a", "key b"], "left")
    # Bytes are cut out in place, so every part of the text is copied once.
    joined = joined.withColumn("data", F.when(F.col("spans").isNotNull(), F.col("row.text").cast("binary")))
    cut = lambda a, b: F.substring(F.col("data"), (a + 1).cast("int"), (b - a).cast("int")).cast("string")
    pieces = F.transform("spans", lambda s: F.when(
        s["from"] >= s["before"], F.concat(cut(s["before"], s["from"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(""))
    rest = cut(F.col("reach"), F.octet_length("data"))
    text = F.when(F.col("spans").isNotNull(), F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("row.text"))
    out = joined.withColumn("masked", text)
    now = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("masked")}
    if "n_chars" in now:
        now["n_chars"] = F.coalesce(F.length("masked").cast("long"), now["n_chars"])
    return out.select(*[now[c].alias(c) for c in docs.columns])


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read(spark, sf_dir, "documents")).drop("key a", "key b", "parts")
