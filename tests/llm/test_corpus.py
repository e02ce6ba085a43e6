"""Corpus operators against SQL, plain Python and their stated results on odd rows."""

import hashlib
import math
import random
import re
import time
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from starloom.llm import bins, chat, counting, forest, language, mixing, packing, paths, pii, quality, topk, vocab

SF = Path("/root/testdata/sf0.001")
ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, start int"
DOCS = [
    (1, "one two three four five six", "en", "a", 27, "x", 1, 1), (2, "one two three four five six", "en", "a", 27, "x", 1, 1),
    (2, "one two three four five six", "en", "a", 27, "x", 1, 1), (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, "", 0, 0), (5, "word " * 4000, "de", None, 20000, "y", 2, 2), (None, "call +1 (555) 010-9999 or a@b.co", "fr", "b", 9, "z", 3, 3),
]

pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(DOCS, ODD)


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").df()


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    found = contract.queries()[name](spark, str(SF)).select(*columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_every_operator_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


# --- 1: personal data ---
def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    number = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(number(m)) <= 19 and luhn(number(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(number(m)) <= 15]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_equal_plain_search(spark):
    texts = list(table("documents")["text"]) + [
        "", "a@b.cc_d@e.ff x@y", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.004", "4111 1111 1111 1111 4111-1111-1111-1112", "é +49 (0) 30 1234-567. ü",
        "9" * 30_000, "a.b" * 20_000 + "@x.y", "a@b" + ".c" * 20_000, "1.2.3." * 5_000, "+1 ((((((", "x@y.z" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find(docs).collect():
        spans = base_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS)


def test_contexts_discover_unseen_identifiers_and_nothing_else(spark):
    seeds = [f"w{i} please reach phone: +1 (555) 010-{1000 + i} today" for i in range(12)]
    texts = [*seeds, "please reach phone: 555-010-4444 today", "the order number 555-010-4444x1 went out", "version 12.34567 of 2024-01-02"]
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found[12]["n_added"] == 1 and found[12]["spans"] == "phone:20:32"
    assert sum(r["n_added"] for r in found.values()) == 1


def test_redaction_keeps_rows_and_columns(odd):
    out = pii.redacted(odd)
    assert out.columns == odd.columns and out.count() == len(DOCS)
    assert out.filter("doc_id is null").first()["text"] == "call [PHONE] or [EMAIL]"


# --- 2: top-k ---
def test_top_k_handles_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 0.5], 0) for i in range(30)] + [(100, [2.0, float("nan")], 1), (200, None, 1), (300, [None, 1.0], 1), (400, [-1.0, 3.0], 2), (500, [1.0], 0)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int"), F.col("vec_id") % 100 == 0, k=5)
    out = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found.collect()}
    assert [out[0, k][0] for k in range(1, 6)] == [1, 2, 3, 4, 5] and [out[400, k][0] for k in range(1, 6)] == [0, 1, 2, 3, 4]
    assert {q for q, _ in out} == {0, 400} and out[400, 1][1] == -1024 * 1024 + 3 * 1024 * 512


def test_top_k_over_many_blocks_equals_full_scan(spark):
    values = np.random.default_rng(1).normal(size=(700, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    whole = np.floor(values * 1024).astype(np.int64)
    expected = {(int(q), r + 1, int(j), int(whole[j] @ whole[q])) for q in range(0, 700, 100)
                for r, j in enumerate([j for j in np.lexsort((np.arange(700), -(whole @ whole[q]))) if j != q][:10])}
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, block=128).collect()} == expected


# --- 3: quality ---
def test_held_out_accuracy_and_odd_rows(spark, odd):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    held = quality.scored(docs, model).join(labels, "doc_id").filter(quality.held_out())
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.95
    out = quality.scored(odd, model).collect()
    assert len(out) == len(DOCS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert quality.good_documents(odd.limit(0), model).count() == 0
    alike = quality.fit(np.zeros((3, len(quality.NAMES))), np.ones(3, bool))
    assert (alike.score(np.zeros((1, len(quality.NAMES)))) >= quality.CUT).all()


def plain_features(text):
    """The features, one character and one word at a time."""
    words = text.split()
    if not words:
        return [0.0] * len(quality.NAMES)
    ascii_ = [c for c in text if ord(c) < 128]
    number = lambda test: sum(map(test, ascii_))
    blank, upper, lower = number(lambda c: c in " \n\t\r"), number(str.isupper), number(str.islower)
    digits, marks = number(str.isdigit), number(lambda c: c in ".,;:'\"?()-")
    symbols = number(lambda c: c in "#$%&*@^~<>{}[]\\/_=+`")
    bars, shouts = text.count("|"), text.count("!")
    other = len(ascii_) - blank - upper - lower - digits - marks - symbols - bars - shouts
    n, w, visible, kinds = len(text), len(words), max(1, len(text) - blank), sorted(set(words))
    lines = [x for x in text.split("\n") if x.strip()]
    shares = [ascii_.count(c) / max(1, len(ascii_)) for c in set(ascii_)]
    return [
        math.log1p(n), math.log1p(w), visible / w, (lower + n - len(ascii_)) / visible, upper / visible, digits / visible, marks / visible,
        symbols / visible, bars / w, shouts / w, blank / n, other / visible, len(kinds) / w, math.log1p(len(kinds)) / math.log1p(w),
        max(words.count(k) for k in kinds) / w, math.log1p(len(lines)), len(set(lines)) / len(lines), math.log1p(w / len(lines)),
        sum(x.rstrip()[-1] in ".!?:" for x in lines) / len(lines), sum(k.isupper() for k in kinds) / len(kinds),
        sum(x[-1] in "#$%&*@!|~^" for x in words) / w, 1 - len({(a, b) for a, b in zip(words, words[1:])}) / (w - 1) if w > 1 else 0.0,
        -sum(p * math.log2(p) for p in shares), sum(len(k) > 20 for k in kinds) / len(kinds)]


def test_features_and_scores_equal_plain_python(spark):
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.filter(F.length("text") < 20_000).unionByName(spark.createDataFrame(
        [(-1, None), (-2, " \n\t"), (-3, "SHOUT!!! |a| \u00e9\u4e2d \x00 {x}"), (-4, "x")], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in quality.scored(docs, model).collect():
        x = plain_features(texts[r["doc_id"]])
        assert np.allclose(x, quality.features(texts[r["doc_id"]]))
        z = [max(-8, min(8, (a - m) / s)) for a, m, s in zip(x, model.mean, model.scale)]
        z = z + [max(a - 1, 0) for a in z] + [max(-a - 1, 0) for a in z]
        raw = sum(a * b for a, b in zip(z, model.weights)) - model.threshold
        assert math.isclose(r["score"], 1 / (1 + math.exp(-max(-40, min(40, raw + math.log(0.3 / 0.7))))), rel_tol=1e-6, abs_tol=1e-12)
        assert r["predicted"] == (r["score"] >= 0.3)


def test_pairs_are_fitted_to_the_least_logistic_loss():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, len(quality.NAMES)))
    good = x[:, 0] - 0.5 * x[:, 3] + rng.normal(size=400) > -0.5
    model = quality.fit(x, good, pairs=4_000, steps=2_000, penalty=1e-2)
    z = np.clip((x - x.mean(0)) / x.std(0), -8, 8)
    z = np.hstack([z, np.maximum(z - 1, 0), np.maximum(-z - 1, 0)])
    weights = np.array(model.weights)
    # Over all pairs the derivative of loss and ridge is near nought: each row stands in about as many pairs.
    difference = (z[good][:, None] - z[~good][None]).reshape(-1, z.shape[1])
    gradient = -(difference / (1 + np.exp(difference @ weights))[:, None]).mean(0) + 1e-2 * weights
    start = np.linalg.norm(difference.mean(0) / 2)
    assert np.linalg.norm(gradient) < 0.1 * start
    raw = z @ weights
    assert (raw[good][:, None] > raw[~good][None]).mean() > 0.75
    assert np.isclose((model.score(x) >= quality.CUT).mean(), good.mean(), atol=0.01)


def test_repeated_ids_and_labels_count_once(spark):
    docs = [(i, ("good words in a line. " if i % 2 else "|| ## ") * (i % 7 + 1)) for i in range(200)]
    labels = [(i, i % 2) for i in range(200)]
    frames = lambda n: (spark.createDataFrame(docs * n, "doc_id long, text string"),
                        spark.createDataFrame(labels * n, "doc_id long, quality int"))
    assert quality.train(*frames(1)) == quality.train(*frames(5))
    empty = quality.train(*(f.limit(0) for f in frames(1)))
    assert {r["predicted"] for r in quality.scored(frames(1)[0], empty).collect()} <= {0, 1}


# --- 4: vectors ---
def test_forest_recall_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = rng.normal(size=(500, 32))
    noise -= (noise * x[:500]).sum(1)[:, None] * x[:500]
    y = 0.92 * x[:500] + np.sqrt(1 - 0.92**2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    ball = x[1400] + 0.02 * rng.normal(size=(400, 32))
    every = np.vstack([x, y, ball, x[:20] * 3])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(every)] + [(5000, None, 0), (5001, [0.0] * 32, 0), (5002, [float("inf")] * 32, 0), (5003, every[700].tolist(), 0)]
    out = {r["vec_id"]: r for r in forest.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int"), leaf=100).collect()}
    unit = np.vstack([every, every[700]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    found = np.array([out[i if i < len(every) else 5003]["n_links"] for i in range(len(unit))])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()
    assert all((out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True) for i in (5000, 5001, 5002))
    assert out[5003]["component_id"] == out[700]["component_id"]


def grouped_vectors(rng, others, groups):
    """Random directions, and groups (size, cosine): vectors that have about that cosine with each other."""
    parts = [rng.normal(size=(others, 64))]
    for size, cosine in groups:
        centre, noise = rng.normal(size=64), rng.normal(size=(size, 64))
        parts.append(centre / np.linalg.norm(centre) + np.sqrt(1 / cosine - 1) * noise / np.linalg.norm(noise, axis=1)[:, None])
    every = np.vstack(parts)
    return every / np.linalg.norm(every, axis=1)[:, None]


def forest_links(spark, every, **options):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>")
    out = sorted(forest.near_vectors(rows, **options).collect())
    return np.array([r["n_links"] for r in out]), np.array([r["component_id"] for r in out])


@pytest.mark.parametrize("cosine", [0.91, 0.93, 0.95, 0.97])
def test_forest_links_all_of_a_large_loose_group(spark, cosine):
    every = grouped_vectors(np.random.default_rng(4), 6000, [(3000, cosine)])
    links = (every @ every.T >= 0.9).sum(1) - 1
    found, component = forest_links(spark, every, leaf=20)
    assert links[6000:].mean() > 1500 and (found[6000:] == links[6000:]).all()
    assert (found <= links).all() and (component[6000:][links[6000:] > 0] == component[6000:].min()).all()


def test_forest_links_groups_that_the_sample_is_too_small_for(spark):
    every = grouped_vectors(np.random.default_rng(5), 12_000, [(110, 0.99), (110, 0.985)])
    links = (every @ every.T >= 0.9).sum(1) - 1
    found, _ = forest_links(spark, every, leaf=20, trees=4)
    assert (found <= links).all() and found[12_000:].sum() >= 0.99 * links[12_000:].sum()


def test_trees_follow_from_depth_and_recall():
    rng = np.random.default_rng(6)
    x = rng.normal(size=200_000)
    y = 0.9 * x + np.sqrt(1 - 0.81) * rng.normal(size=200_000)
    low, high = np.quantile(x, [0.5 - forest.BAND, 0.5 + forest.BAND])
    apart = ((x < low) & (y > high)) | ((y < low) & (x > high))
    assert abs(forest.kept(0.9) - (1 - apart.mean())) < 0.003
    assert forest.trees_for(0, 0.9, 0.999) == 1 and forest.depth_for(500, 640) == 0
    counts = [forest.trees_for(forest.depth_for(n, 640), 0.9, 0.999) for n in (10**4, 10**6, 10**8, 10**10)]
    assert counts == sorted(counts) and 4 <= counts[0] < counts[-1] < 100


@pytest.mark.parametrize("sf,leaf", [("sf0.01", 20), ("sf0.1", 160)])
def test_forest_recall_with_splits(spark, sf, leaf):
    """Leaves small enough that the vectors are split at three levels or more, against all pairs.

    The given vectors hold no pair at 0.9, so half of them come a second time, turned to a cosine of 0.9 to 0.99.
    """
    rows = [r[0] for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").select("embedding").collect()]
    unit = np.array([r for r in rows if r and len(r) == len(rows[0]) and np.isfinite(r).all() and np.any(r)], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    rng = np.random.default_rng(9)
    turned, cosine = unit[::2], rng.uniform(0.9, 0.99, len(unit[::2]))[:, None]
    aside = rng.normal(size=turned.shape)
    aside -= (aside * turned).sum(1)[:, None] * turned
    every = np.vstack([unit, cosine * turned + np.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside, axis=1)[:, None]])
    links = (every @ every.T >= 0.9).sum(1) - 1
    assert forest.depth_for(len(unit), leaf) >= 3 and links.sum() >= len(unit) * 0.95
    found, _ = forest_links(spark, every, leaf=leaf)
    assert (found <= links).all() and found.sum() >= 0.99 * links.sum()


# --- 5: texts ---
def test_joins_planted_copies(spark, odd):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words, 120)) for _ in range(60)]
    near = [t.split() for t in texts[:40]]
    for n in near:
        n[60] = "changed"
    rows = list(enumerate(texts)) + [(100 + i, " ".join(n)) for i, n in enumerate(near)] + [(200, texts[50].upper())]
    out = {r["doc_id"]: r for r in paths.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[100 + i]["component_id"] == i and not out[100 + i]["kept"] and out[i]["n_links"] == 1 for i in range(40))
    assert out[200]["component_id"] == 50 and all(out[i]["kept"] for i in range(60)) and out[45]["n_links"] == 0
    kept = paths.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, None], key=repr)
    assert paths.near_texts(odd.limit(0)).count() == 0
    assert paths.survival(0.8) > 0.93


# --- 6: language ---
def test_languages_of_pages(spark):
    out = contract.queries()["op6_language"](spark, "/root/testdata/sf0.01").collect()
    urls = duckdb.sql("SELECT page_id, url FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    truth = {p: re.search(r"//[^/]+/(\w\w)/", u)[1] for p, u in urls}
    assert np.mean([r["lang"] == truth[r["page_id"]] for r in out]) >= 0.95
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    odd = spark.createDataFrame([(1, None, None), (2, "", ""), (2, "", ""), (3, "no address", "<html lang=fr>")], "page_id long, url string, html string")
    assert len(language.identify(odd, model).collect()) == 4


def test_rare_languages_are_in_the_model(spark):
    docs = [(i, "the cat sat on the mat", "en") for i in range(300)] + [(1000 + i, "qaxu wozi qaxu", x) for i, x in enumerate(("xx", "yy", "zz"))]
    model = language.train(spark.createDataFrame([*docs, (None, "vemo vemo", "ww")], "doc_id long, text string, lang string"), sample=20)
    assert model.languages == ["en", "ww", "xx", "yy", "zz"]


def plain_languages(pages, model, strength=20.0):
    """The fused evidence of every page, one page after the other."""
    size, beliefs, rows = len(model.languages), [], []
    for page_id, url, html in pages:
        declared = re.search(r"<html\b[^>]{0,400}?\blang\s*=\s*[\"']?([a-z]{2,3})", html or "", re.I)
        host = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", url or "", re.I)
        host = host and host[1].lower()
        logs = np.array(model.likelihoods(language.page_text(html)))
        belief = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        domain = host and ".".join(host.split(".")[-2:])
        rows.append((page_id, declared and declared[1].lower(), host, domain, host and host.split(".")[-1], logs, belief))
    overall = sum(r[6] for r in rows)
    share = lambda i, v: sum((r[6] for r in rows if r[i] == v), np.zeros(size))
    out = []
    for page_id, declared, host, domain, suffix, logs, belief in rows:
        prior = (overall + 1) / (overall.sum() + size)
        for i, value in ((3, domain), (2, host)):
            seen = np.maximum(share(i, value) - belief, 0) if value else np.zeros(size)
            prior = (seen + strength * prior) / (seen.sum() + strength)
        total = np.log(prior) + logs
        for i, value in ((1, declared), (4, suffix)):
            if value is not None:
                total += np.log((share(i, value) + strength * share(i, value).sum() / overall.sum()) / (overall + strength))
        total = np.exp(total - total.max())
        out.append((page_id, model.languages[int(total.argmax())], total.max() / total.sum(), declared, suffix, host))
    return out


def test_fused_evidence_equals_plain_python(spark):
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    pages += [(-1, None, None), (-2, "http://HOST/", ""), (-3, "http://u@a.b.example:80/x", "<html lang=fr><nav>" * 9), (-4, "x", "le chat"),
              (-5, pages[0][1], None), (-6, "http://a../", "<HTML class=x LANG='DE'>")]
    found = language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model)
    found = sorted(tuple(r) for r in found.select("page_id", "lang", "probability", "declared", "suffix", "host").collect())
    expected = sorted(plain_languages(pages, model))
    assert [f[:2] + f[3:] for f in found] == [e[:2] + e[3:] for e in expected]
    assert np.allclose([f[2] for f in found], [e[2] for e in expected], rtol=1e-9)


def test_languages_of_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "x"), (2, "le chat", "fr", "y")], "doc_id long, text string, lang string, seen string")
    model = language.train(docs)
    pages = spark.createDataFrame([(1, "http://a.b", "the cat", "x", 1, "z")], "page_id long, url string, html string, text string, belief int, host string")
    assert language.identify(pages.limit(0), model).count() == 0
    assert [tuple(r)[:2] for r in language.identify(pages, model).select("page_id", "lang").collect()] == [(1, "en")]
    nothing = language.train(docs.limit(0))
    assert nothing.languages == [] and [r["lang"] for r in language.identify(pages, nothing).collect()] == [None]


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "a", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        language.train(docs)


def test_text_of_pages():
    assert language.page_text("a<script x>b</Script >c<!-- d -->e<nav>f<nav>g</nav>h</nav>i").split() == ["a", "c", "e", "h", "i"]
    assert language.page_text("<div id=x class='ad big'>b</div>c<div class=adult>d</div><nav>e &amp; 1 < 2").split() == ["c", "d", "e", "1", "<", "2"]
    assert language.page_text(None) == language.page_text("") == ""


@pytest.mark.parametrize("part", ["<nav>", "<!--", "<div ", "<", "</nav ", "<div class=ad>", "&amp"])
def test_time_of_page_text_follows_its_length(part):
    start = time.perf_counter()
    language.page_text(part * 100_000)
    assert time.perf_counter() - start < 5


# --- 7: chats ---
def test_chats_are_read_back(spark):
    control = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 0, "user", control), (1, 1, "assistant", "<\\|é<"), (1, 1, "assistant", "|x"), (2, None, None, None), (3, 5, "a\nb<|", "<\\\\<|\n")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(df)
    for r in chat.digest(formatted).collect():
        own = sorted((t for t in turns if t[0] == r["conv_id"]), key=lambda t: (t[1] is not None, t[1], t[2] or "", t[3] or ""))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own).encode()).hexdigest()
        loss = "".join(t[3] for t in own if t[2] == "assistant")
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(own), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert formatted.filter("conv_id = 1").first()["formatted"].count("<|im_start|>") == 3
    assert chat.format_turns(df.limit(0)).count() == 0


# --- 8: packing ---
@pytest.mark.parametrize("seed", range(8))
def test_bin_completion_is_valid_and_no_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(rng.integers(1, 40)) for n in rng.choice(np.arange(5, 101), 25, replace=False)}
    fills, plain = bins.complete(counts, 100), bins.best_fit(counts, 100)
    for plan in (fills, plain):
        used = {}
        for f in plan:
            assert sum(f.lengths) <= 100
            for n in f.lengths:
                used[n] = used.get(n, 0) + f.times
        assert used == counts
    number = sum(f.times for f in fills)
    assert bins.lower_bound(counts, 100) <= number <= sum(f.times for f in plain)
    assert bins.complete({}, 10) == [] and bins.complete({6: 2, 4: 2, 3: 2, 7: 2}, 10) and number


def test_packs_documents(spark, odd):
    out = packing.pack_documents(odd, vocab.path("word_bpe_49k.json"), capacity=64).toPandas()
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 64
    tokens = vocab.tokenizer(vocab.path("word_bpe_49k.json"))
    ids = np.array([*tokens.encode(DOCS[5][1], add_special_tokens=False).ids, 0], "<u4")
    long = out[out["doc_id"] == 5].sort_values("piece")
    assert list(long["ids_crc32"]) == [zlib.crc32(ids[a:a + 64].tobytes()) for a in range(0, len(ids), 64)]
    assert (out["length"][out["doc_id"].isin([3, 4])] == 1).all() and (out["doc_id"] == 2).sum() == 2
    assert packing.pack_documents(odd.limit(0), vocab.path("word_bpe_49k.json")).count() == 0


# --- 9: token counts ---
def test_spliced_counts_equal_whole_texts(spark):
    texts = [t for t in table("documents")["text"]][:120] + ["", "x" * 3000, " " * 900 + "a", "<|endoftext|>" * 90, "a\t\n  b " * 300, "é漢🙂 " * 200, "it's " * 400]
    file = vocab.path("byte_bpe_50k.json")
    encoder = vocab.tokenizer(file)
    df = spark.createDataFrame([*enumerate(texts), (9999, None)], "doc_id long, text string")
    for options in ({}, {"chunk": 200, "overlap": 40}):
        out = {r["doc_id"]: r for r in counting.count_tokens(df, file, **options).collect()}
        for i, text in enumerate(texts):
            assert (out[i]["n_tokens"], out[i]["n_bytes"]) == (len(encoder.encode(text, add_special_tokens=False).ids), len(text.encode()))
        assert (out[9999]["n_tokens"], out[9999]["over_limit"]) == (0, False)


# --- 10: mixing, and the pipeline ---
def test_mix_meets_targets_and_repeats(spark, odd):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    words = lambda df: df.agg(F.sum(mixing.word_count(F.coalesce("text", F.lit(""))))).first()[0]
    assert abs(words(out) - 1.5 * words(odd)) <= 3
    assert sorted(map(repr, out.collect())) == sorted(map(repr, mixing.mixed_documents(odd).collect()))
    assert mixing.mix(odd.limit(0)).count() == 0


@pytest.mark.parametrize("range_rows", [20, 20_000])
def test_mixed_documents_hold_the_words_that_the_mix_takes(spark, range_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit("mine")).withColumn("cut", F.lit("ours"))
    taken = {r["doc_id"]: r for r in mixing.mix(docs, range_rows=range_rows).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = {}
    for r in mixing.mixed_documents(docs, range_rows=range_rows).collect():
        assert r["row"] == "mine" and r["cut"] == "ours" and texts[r["doc_id"]].startswith(r["text"] or "")
        found.setdefault(r["doc_id"], []).append(len(re.findall(mixing.WORD, r["text"] or "")))
    for i, r in taken.items():
        expected = [r["size"]] * (r["epochs"] if r["size"] else 1) + [r["partial"]] * (r["partial"] > 0)
        assert sorted(found.get(i, [])) == sorted(expected)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_repeated_rows_at_the_cut_are_taken_up_to_the_word(spark):
    docs = [(7, "a b c d e", "x")] * 40 + [(8, "f g", "y")] * 3 + [(None, "h i j", None)] * 5 + [(9, None, "z"), (9, "", "z")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = {(r["source_size"], r["target"]) for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    words = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.coalesce("text", F.lit("")))).alias("n")).collect()}
    assert {(200, words["x"]), (6, words["y"]), (15, words[None]), (0, words["z"])} == {(s, round(t)) for s, t in targets}
    assert out.filter("source = 'z'").count() == 2


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes, kept = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.store(stage(spark, kept, sf), "test-stage")
        sizes.append(kept.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
        if name == "PII":
            assert not any(base_spans(r["text"]) for r in kept.collect())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] and kept.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()


# --- 1 once more: whole texts of any shape ---
def test_discovery_time_follows_the_number_of_matches(spark):
    def seconds(n):
        text = " ".join(f"write to u{i}@x.org or call 555-01{i % 10}-{1000 + i}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.perf_counter()
        assert pii.redacted(docs).first()["text"].count("[EMAIL]") == n
        return time.perf_counter() - begin

    seconds(100)
    assert seconds(20_000) < 4 * seconds(5_000) + 10


def test_spaced_numbers_are_discovered_and_masked(spark):
    seeds = [f"w{i} please reach me at phone: +1 (555) 010-{1000 + i} today é" for i in range(12)]
    seeds += [f"w{i} kindly charge my card: {card(i)} now" for i in range(12)]
    local = "b" * 80 + "@localhost"
    seeds += [f"w{i} send it to mail: u{i}@x.org soon" for i in range(12)]
    texts = [*seeds, "é please reach me at phone: (555) 010-4444 today", "please reach me at phone: 555 010 4444", "kindly charge my card: 3782 822463 10005 now",
             f"send it to mail: {local} soon", "the years 1990 1991 1992 1993 and 3.14159", "phone: none", "x (((((((((1 2 3", "1 2 3 " * 20_000 + "4x", "(" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert found[36] == "é please reach me at phone: [PHONE] today" and found[37] == "please reach me at phone: [PHONE]"
    assert found[38] == "kindly charge my card: [CARD] now" and found[39] == "send it to mail: [EMAIL] soon"
    assert all(found[i] == texts[i] for i in range(40, len(texts)))


def card(i):
    body = f"411111111111{i:03d}"
    return next(body + str(k) for k in range(10) if luhn(body + str(k)))


def test_redaction_joins_overlaps_and_leaves_other_columns(spark):
    rows = [(1, "ééé a@1.2.3.4 x", "mine", 5, "s"), (2, None, "mine", 5, "s"), (3, "漢 +49 30 1234567 +49 30 1234567", "mine", 5, "s"), (1, "ééé a@1.2.3.4 x", "other", 5, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `key a` string, `row` int, spans string")
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    assert sorted(out.collect(), key=repr) == sorted([
        (1, "ééé [EMAIL] x", "mine", 5, "s"), (1, "ééé [EMAIL] x", "other", 5, "s"), (2, None, "mine", 5, "s"), (3, "漢 [PHONE] [PHONE]", "mine", 5, "s")], key=repr)
    assert pii.redacted(docs.limit(0)).count() == 0 and pii.find(docs.limit(0)).count() == 0


# --- 2 and 7 once more ---
def test_top_k_scores_large_components_exactly(spark):
    values = np.random.default_rng(2).normal(size=(60, 4))
    values[3], values[7], values[20], values[41] = [1e6, 2.5, 0, -1], [1e30] * 4, [-3e300, 1, 1, 1], [131072.0, 0, 0, 0]
    whole = [[math.floor(1024 * x) if abs(x) < 2**53 else int(x) * 1024 for x in v] for v in values.tolist()]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    out = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") % 10 < 2, k=6, block=16).collect()}
    for q in (i for i in range(60) if i % 10 < 2):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in range(60) if i != q))[:6]
        assert [out[q, r + 1] for r in range(6)] == [(i, -s if -2**63 <= -s < 2**63 else None) for s, i in scores]


def test_chats_over_batch_borders(spark, conf):
    rng = random.Random(3)
    turns = [(c, t, rng.choice(["user", "assistant", "tool\n<|"]), "".join(rng.choice("ab<|\\é漢🙂\n") for _ in range(rng.randrange(9))))
             for c in range(40) for t in range(rng.choice([1, 2, 3, 30]))]
    df = spark.createDataFrame([(None if c == 5 else c, t, r, x) for c, t, r, x in turns], "conv_id int, turn int, role string, text string")
    chat.format_turns(df.limit(0))  # the library sets its own batch size first
    for size in ("1", "7", "1000"):
        conf(spark__sql__execution__arrow__maxRecordsPerBatch=size)
        formatted = chat.format_turns(df)
        conf(spark__sql__execution__arrow__maxRecordsPerBatch=size)
        out = {r["conv_id"]: r for r in formatted.collect()}
        assert len(out) == 40
        for c in range(40):
            row = out[None if c == 5 else c]
            own = [(r, x) for k, _, r, x in turns if k == c]
            read = [(chat.unescape(m[1], role=True), chat.unescape(m[2])) for m in chat._TURN.finditer(row["formatted"])]
            assert read == own
            assert [chat.unescape(row["formatted"][a:b]) for a, b in zip(row["loss_starts"], row["loss_ends"])] == [x for r, x in own if r == "assistant"]


# --- 5 once more ---
def test_different_texts_of_one_id_are_told_apart(spark):
    rng = np.random.default_rng(8)
    base = [" ".join(f"w{i}" for i in rng.integers(0, 900, 120)) for _ in range(4)]
    near = [t.replace(t.split()[60], "changed", 1) for t in base]
    rows = [(1, base[0]), (1, base[1]), (2, near[0]), (3, near[1]), (5, base[2]), (5, base[2]), (6, near[2]), (0, base[3]), (6, near[3]), (9, base[3].upper())]
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in rows], "doc_id long, text string, `long id` string, mark int")
    out = sorted(map(tuple, paths.near_texts(docs).collect()))
    assert out == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False),
                          (0, 2, 0, True), (6, 2, 0, False), (9, 2, 0, False)])
    kept = paths.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted([(1, base[0], "own", 1), (1, base[1], "own", 1), (5, base[2], "own", 1), (0, base[3], "own", 1)])
