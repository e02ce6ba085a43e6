"""Sharding, centroid clustering and the filter audit against plain Python, and their stated results on odd rows."""

import hashlib
import math
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from starloom.llm import audit, centroids, sharding

ODD = "doc_id long, text string, source string, shard string, mask int, part string, cluster int, at long, digest int"
ROWS = [
    (1, "one two three four five six", "a", "x", 1, "p", 1, 1, 1), (2, "one two three four five six", "a", "x", 1, "p", 1, 1, 1),
    (2, "one two three four five six", "a", "x", 1, "p", 1, 1, 1), (3, None, None, None, None, None, None, None, None), (4, "", "b", "", 0, "", 0, 0, 0),
    (5, "word " * 60_000, None, "y", 2, "q", 2, 2, 2), (None, "ABC éé $ 漢🙂", "b", "z", 3, "r", 3, 3, 3), (None, "", "", "z", 3, "r", 3, 3, 3),
    (7, " ".join(f"w{i}" for i in range(50)), "b", "z", 3, "r", 3, 3, 3), (8, " ".join(f"w{i % 33}" for i in range(51)), "b", "z", 3, "r", 3, 3, 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


# --- 11: shards ---
def plain_shard(key, tree):
    """The descent by its definition."""
    path, left = "", tree
    for level in range(3):
        weights = Counter()
        for leaf in left:
            weights[leaf[level]] += leaf.weight
        draw = lambda c: int(hashlib.md5(f"{key}/{path}/{c}".encode()).hexdigest()[:13], 16)
        child = min((-math.log((draw(c) + 0.5) / 2**52) / w, c) for c, w in weights.items() if w)[1]
        path, left = f"{path}/{child}", [x for x in left if x[level] == child]
    return left[0].shard


def test_shards_of_odd_rows(spark, odd):
    tree = sharding.balanced()
    out = sharding.assign(odd, tree, sharding.with_one_more(tree)).collect()
    key = lambda i: "null" if i is None else str(i)
    size = lambda t: len((t or "").encode()) + 1
    expected = sorted(((r[0], size(r[1]), zlib.crc32((r[1] or "").encode()), plain_shard(key(r[0]), tree)) for r in ROWS), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in out), key=repr) == expected
    for shard in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in out)
    assert sorted(map(repr, out)) == sorted(map(repr, sharding.assign(odd, tree, sharding.with_one_more(tree)).collect()))
    assert all(r["grown_shard"] is None for r in sharding.assign(odd, tree).collect())
    assert sharding.assign(odd.limit(0), tree).count() == 0


def test_moves_stay_within_changed_subtrees(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "cast(null as string) as text")
    tree = [sharding.Leaf(r, k, (r * 2 + k) * 2 + s, 1.0 + s) for r in range(3) for k in range(2) for s in range(2)]
    heavier = [x._replace(weight=5.0) if x.shard == 6 else x for x in tree]  # region 1, rack 1
    more = sharding.with_one_more(tree, 3.0)
    count = Counter()
    for new, name in ((heavier, "heavier"), (more, "more")):
        for r in sharding.assign(docs, tree, new).collect():
            count[name, r["shard"], r["grown_shard"]] += 1
    region = lambda shard: shard // 4
    rack = lambda shard: shard // 2
    assert all(a == b or region(b) == 1 for n, a, b in count if n == "heavier")  # nothing moves between other regions
    assert all(a == b or rack(b) == 3 for n, a, b in count if n == "heavier" and region(a) == 1)  # nor from a heavier rack
    assert all(a == b or b == 6 for n, a, b in count if n == "heavier" and rack(a) == 3)
    assert all(b in (a, 12) for n, a, b in count if n == "more") and any(b == 12 for n, _, b in count if n == "more")
    held = Counter()
    for (name, a, _), n in count.items():
        if name == "more":
            held[a] += n
    assert all(abs(held[x.shard] / 20_000 - x.weight / 18) < 0.02 for x in tree)


def test_equal_rows_are_dealt_over_ranges(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    docs = spark.range(9_000).selectExpr("case when id % 3 < 2 then 5 else id end as doc_id", "'same' as text")
    out = sharding.assign(docs, sharding.balanced())
    assert out.groupBy("shard").agg({"slot": "max", "*": "count"}).filter("`max(slot)` + 1 <> `count(1)`").isEmpty()
    assert out.select("shard", "slot").distinct().count() == 9_000


def test_trees_are_checked():
    for bad in ([], [sharding.Leaf(0, 0, 1, 0.0)], [sharding.Leaf(0, 0, 1, -1.0)], [sharding.Leaf(0, 0, 1), sharding.Leaf(0, 1, 1)]):
        with pytest.raises(ValueError):
            sharding._children(bad)


# --- 12: clusters ---
def plain_clusters(rows, k, rounds):
    """(rows' clusters, distances, centroids) by comparing every vector with every centroid, in Python's numbers."""
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2**53 else int(x) * 1024 for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in start[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for n in range(rounds + 1):
        best = [min((gap(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if n < rounds:
            for j in range(len(centres)):
                mine = [v for (_, v), (_, b) in zip(kept, best) if b == j]
                if mine:
                    centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, best)], centres


def vectors(rng, n, scale=0.2):
    middle = rng.normal(size=(6, 64))
    return [(int(i), (middle[i % 6] * scale + rng.normal(size=64) * scale / 4).tolist()) for i in range(n)]


@pytest.mark.parametrize("kind", ["plain", "ties", "huge", "few"])
def test_clusters_equal_full_comparison(spark, kind):
    rng = np.random.default_rng(7)
    rows = vectors(rng, 4 if kind == "few" else 240)
    if kind == "ties":
        rows = [(i, [float(i % 3)] * 64) for i in range(30)] + [(3, [3.0] * 64), (3, [3.0] * 64), (None, [0.5] * 64), (None, [1.5] * 64)]
    if kind == "huge":
        rows += [(900, [1e30] * 64), (901, [-3e5] + [0.0] * 63), (902, [2e18] * 64), (903, [1500.25] * 64)]
    rows += [(990, None), (991, [0.1] * 63), (992, [0.1] * 65), (993, [float("nan")] * 64), (994, [None] * 64), (995, [float("-inf")] * 64), (996, [])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, cluster int").repartition(3)
    out = centroids.cluster(df).collect()
    expected, centres = plain_clusters(rows, 8, 10)
    own = Counter()
    for _, j, d in expected:
        own[j] += d
    fits = lambda d: d if d < 2**63 else None
    known = {j: all(d < 2**63 for _, c, d in expected if c == j) and fits(n) is not None for j, n in own.items()}
    for j, n in own.items():
        for r in (r for r in out if r["cluster"] == j):
            assert r["cluster_inertia"] == (n if known[j] else None)
            assert r["inertia"] == (fits(sum(own.values())) if all(known.values()) else None)
            assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in out), key=repr) == sorted(((i, j, fits(d)) for i, j, d in expected), key=repr)


def test_no_vectors_no_clusters(spark):
    assert centroids.cluster(spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")).count() == 0


def test_transform_is_exact_and_coarse_first():
    v = np.random.default_rng(1).integers(-1000, 1000, (9, 64))
    t = centroids.transform(v)
    assert ((t * t).sum(1) == 64 * (v * v).sum(1)).all() and (t[:, 0] == v.sum(1)).all()
    signs = centroids.transform(np.eye(64, dtype=np.int64))  # its columns are the waves that the coefficients measure
    assert list((signs[1:] != signs[:-1]).sum(0)) == list(range(64))


def test_elimination_keeps_equal_centroids():
    c = np.array([[5] * 64, [1] * 64, [-1] * 64, [1] * 64])
    assert centroids.nearest(np.zeros((2, 64), np.int64), c)[0].tolist() == [1, 1]


# --- 13: filters ---
def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = {}
    for part in {s or "" for _, _, s in rows}:
        docs = []
        for i, text, source in rows:
            if (source or "") == part:
                text = text or ""
                words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
                fails = {
                    "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                    "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
                    "E": i is not None and i > least[text]}
                docs.append(({f for f in fails if fails[f]}, i in good, i in toxic))
        shares = Counter()
        for order in permutations("ABCDE"):
            alive = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if f in d[0]]
                alive = [d for d in alive if f not in d[0]]
                failing = sum(f in d[0] for d in docs)
                shares[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(alive), len(gone), failing - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shares[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_filtering_in_every_order(spark, odd):
    labels = [(1, 1, 0), (1, 0, 1), (2, None, None), (3, 1, None), (5, 0, 1), (7, 1, 1), (8, 1, 0), (None, 1, 1), (77, 1, 1)]
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.audit(odd, marks).collect()}
    assert out == plain_audit([r[:3] for r in ROWS], labels)
    assert len(out) == 3 * 600
    assert audit.audit(odd.limit(0), marks).count() == 0
    assert all(r["good_lost"] == 0 for r in audit.audit(odd, marks.limit(0)).collect())
