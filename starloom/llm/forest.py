"""Near-duplicate vectors by a forest of random-projection trees (operator 4).

Every tree splits the vectors along random directions near the median, again and again, and a band around each split
goes to both sides. Vectors are compared within leaves only; several trees make up for pairs that one tree separates.

Exact copies are one vector from the start. Groups of vectors within half the linking angle of one of their own (a
ball) are all linked with each other, so their pairs need no comparison; such groups, found on a bounded sample, do not
enter the forest, and only what lies near a ball is compared with its members, in tiles. So a third of all
vectors in one such group costs a pass, not all its pairs. Looser groups, within the whole linking angle of their mean,
do not enter the forest either, as it would cut through them: all their pairs are compared, in tiles. What the sample is
too small to show is looked for again in every leaf that is too large, on the leaf's own sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import connected_components, read, ship, store
from .registry import query

SAMPLE = 2_048  # vectors that balls and the first levels of all trees are fitted on, the first in hash order
LEAST_BALL = 0.01  # share of the sample that makes a ball worth setting apart
MARGIN = 1e-9
TILE = 8_192  # vectors of a loose group on each side of a task at most
BAND = 0.05  # of a node's vectors on either side of a split that go both ways


def _unit(data: pd.Series) -> np.ndarray:
    """Rows of unit length in double precision from packed components."""
    v = np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
    top = np.abs(v).max(axis=1, keepdims=True)
    v = v / top  # keeps squares in range for very large and very small components
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a @ b.T


def balls(sample: np.ndarray, threshold: float) -> np.ndarray:
    """Centres of balls that hold ``LEAST_BALL`` of the sample, each less the earlier ones; at most 1 / LEAST_BALL.

    A centre is a vector of the sample or the mean of those linked with one, whichever ball holds more.
    """
    if not len(sample):
        return sample
    cosines = _cosines(sample, sample)
    open_, centres = np.ones(len(sample), bool), []
    while True:
        tight, wide = (cosines >= _half(threshold)) & open_, (cosines >= threshold) & open_
        options = [sample[int(tight.sum(1).argmax())], _mean(sample[wide[int(wide.sum(1).argmax())]])]
        found = [(sample @ c >= _half(threshold)) & open_ for c in options]
        best = int(np.argmax([f.sum() for f in found]))
        if found[best].sum() < max(16, LEAST_BALL * len(sample)):
            return np.array(centres).reshape(-1, sample.shape[1])
        centres.append(options[best])
        open_ &= ~found[best]


def loose(sample: np.ndarray, threshold: float, least: float) -> np.ndarray:
    """Centres of groups of at least ``least`` vectors within the linking angle of their mean, each less the earlier ones."""
    linked = _cosines(sample, sample) >= threshold
    open_, centres = np.ones(len(sample), bool), []
    while open_.any():
        around = linked & open_
        best = int(around.sum(1).argmax())
        if around[best].sum() < least:
            break
        centres.append(_mean(sample[around[best]]))
        open_ &= ~(around[best] | (sample @ centres[-1] >= threshold))
    return np.array(centres).reshape(-1, sample.shape[1])


def _mean(vectors: np.ndarray) -> np.ndarray:
    """Of unit length; the vectors are linked with one of them or none, so they do not cancel out."""
    total = vectors.sum(axis=0)
    return total / max(np.linalg.norm(total), np.finfo(float).tiny)


def _half(threshold: float) -> float:
    """Two vectors at least this close to a third are linked, whatever rounding does."""
    return float(np.cos(np.arccos(threshold) / 2)) + MARGIN


def _reach(threshold: float, radius: float = 0.5) -> float:
    """A vector further from a centre than this is linked with none within ``radius`` linking angles of it."""
    return float(np.cos(min(np.pi, (1 + radius) * np.arccos(threshold)))) - MARGIN


def kept(threshold: float) -> float:
    """The chance that a split leaves a pair of this cosine together: their projections are normal, correlated by it."""
    edge = _quantile(0.5 + BAND)
    x = np.linspace(edge, 10.0, 20_001)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    beyond = np.array([0.5 * math.erfc(z / math.sqrt(2)) for z in (edge + threshold * x) / math.sqrt(1 - threshold**2)])
    return float(1 - 2 * np.trapezoid(density * beyond, x))  # one below the band, the other above it, and the reverse


def _quantile(share: float) -> float:
    """Of the normal distribution, for a share above one half."""
    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if 0.5 * math.erfc(-middle / math.sqrt(2)) < share else (low, middle)
    return low


def depth_for(vectors: float, leaf: int) -> int:
    """Splits on the way to a leaf of at most ``leaf`` vectors."""
    return max(0, math.ceil(math.log(max(1.0, vectors / leaf)) / -math.log(0.5 + BAND)))


def trees_for(depth: int, threshold: float, recall: float) -> int:
    """Trees after which a pair at the threshold has shared a leaf with chance ``recall``; one, if nothing is split."""
    together = kept(threshold) ** depth
    return 1 if together >= recall else math.ceil(math.log(1 - recall) / math.log(1 - together))


def grow(sample: np.ndarray, levels: int, seed: int) -> tuple[int, np.ndarray, np.ndarray]:
    """A tree of ``levels`` splits: its seed and, by node in heap order, the two ends of the band; NaN: no split."""
    low, high = np.full(2**levels - 1, np.nan), np.full(2**levels - 1, np.nan)
    sides = _directions(seed, len(low), sample.shape[1])
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        if node >= len(low) or len(rows) < 16:
            continue
        along = sample[rows] @ sides[node]
        a, b = np.quantile(along, [0.5 - BAND, 0.5 + BAND])
        if a == b:  # alike in this direction: a split would part nothing
            continue
        low[node], high[node] = a, b
        todo += [(2 * node + 1, rows[along <= b]), (2 * node + 2, rows[along >= a])]
    return seed, low, high


def _directions(seed: int, nodes: int, width: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((nodes, width))


def route(tree: tuple[int, np.ndarray, np.ndarray], vectors: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows) for the vectors; rows in a band are in several leaves."""
    seed, low, high = tree
    sides, out, todo = _directions(seed, len(low), vectors.shape[1]), [], [(0, np.arange(len(vectors)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node >= len(low) or np.isnan(low[node]):
            out.append((node, rows))
            continue
        along = vectors[rows] @ sides[node]
        todo += [(2 * node + 1, rows[along <= high[node]]), (2 * node + 2, rows[along >= low[node]])]
    return out


def _linked(v: np.ndarray, threshold: float) -> np.ndarray:
    out = _cosines(v, v) >= threshold
    np.fill_diagonal(out, False)
    return out


def _least_reachable(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every row the least id among the rows it reaches."""
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (new == label).all():
            return label
        label = new


def _met(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which vectors of both sides are linked, found in blocks."""
    linked = np.empty((len(x), len(y)), bool)
    for at in range(0, len(x), 1_024):
        linked[at:at + 1_024] = _cosines(x[at:at + 1_024], y) >= threshold
    return linked


def _weighed(linked: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows linked with each vector of the first side: copies of the other side's vectors, exact below 2**53."""
    blocks = [linked[at:at + 1_024].astype(np.float64) @ n.astype(np.float64) for at in range(0, len(linked), 1_024)]
    return np.concatenate(blocks).astype(np.int64)


def _least_across(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the ids of both sides the least id reached by links between the sides; their own where there are none."""
    least_x, least_y, open_x, open_y = x.copy(), y.copy(), linked.any(1), linked.any(0)
    while open_x.any():
        new_x, all_x, all_y = np.array([open_x.argmax()]), [], []
        while len(new_x):
            open_x[new_x] = False
            all_x.append(new_x)
            new_y = np.flatnonzero(linked[new_x].any(0) & open_y)
            open_y[new_y] = False
            all_y.append(new_y)
            new_x = np.flatnonzero(linked[:, new_y].any(1) & open_x) if len(new_y) else new_y
        in_x, in_y = np.concatenate(all_x), np.concatenate(all_y)
        least_x[in_x] = least_y[in_y] = min(x[in_x].min(), y[in_y].min())
    return least_x, least_y


def _key(leaf: int, tree: int, parent: int = 0) -> int:
    """A leaf's name: mixed from its tree, the node it was split from, and its number there."""
    x = (parent * 0x9E3779B97F4A7C15 + tree * 0xC2B2AE3D27D4EB4F + leaf * 0x165667B19E3779F9 + 0x27D4EB2F165667C5) & (2**64 - 1)
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & (2**64 - 1)
    return (x ^ x >> 31) - 2**63


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, trees: int | None = None, leaf: int = 640, seed: int = 17, recall: float = 0.999,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    The number of trees follows from the depth they need for leaves of ``leaf`` vectors and from the target ``recall`` of
    pairs at the threshold, unless ``trees`` gives it; vectors that fit a leaf are compared once, without a split.

    ``vectors`` has vec_id and embedding. Linked are rows whose cosine, in double precision, reaches ``threshold``; the
    forest may miss pairs (see the recall test) and never links others. n_links counts the other rows linked directly,
    component_id is the least vec_id reachable by links. Null, empty and zero vectors, those with null or non-finite
    components and rows with a null vec_id link with nothing; vectors of different lengths never link. Repeated rows
    are rows of their own, linked with each other; rows that share a vec_id are one node of the graph. Other columns
    are not read; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    valid = F.coalesce(whole & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = vectors.select("vec_id", F.when(valid, F.col("embedding").cast("array<double>")).alias("v"))
    classes = rows.filter(F.col("v").isNotNull()).groupBy("v").agg(F.min("vec_id").cast("long").alias("id"), F.count(F.lit(1)).alias("n"))
    members = store(classes.select("id", "n", "v", F.size("v").alias("width"), F.xxhash64("v").alias("h")), "vector-classes")
    found = [r["width"] for r in members.select("width").distinct().collect()]
    links, edges = [], []
    for width in found:
        of = members.filter(F.col("width") == width)
        _by_width(of.select("id", "n", "v", "h"), threshold, trees, leaf, seed, recall, links, edges)
    if links:
        total = reduce(DataFrame.unionByName, links).groupBy("id").agg(F.sum("links").alias("links"))
        components = connected_components(reduce(DataFrame.unionByName, edges))
    else:
        total = spark.createDataFrame([], "id long, links long")
        components = spark.createDataFrame([], "node long, component long")
    named = members.select("v", "id", "n").join(total, "id", "left").join(
        components, F.col("id") == F.col("node"), "left").select(
        F.col("v"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component"))
    out = rows.join(named, "v", "left")
    component = F.coalesce("component", F.col("vec_id").cast("long"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _by_width(
    classes: DataFrame, threshold: float, trees: int | None, leaf: int, seed: int, recall: float, links: list, edges: list,
) -> None:
    spark = classes.sparkSession
    count = classes.count()
    head = classes.orderBy(F.xxhash64(F.lit(seed), "h"), "id").limit(SAMPLE).select("v").toPandas()["v"]
    sample = _unit(pd.Series([np.asarray(v, np.float64).tobytes() for v in head]))
    tight = balls(sample, threshold)
    free = sample[_cosines(sample, tight).max(axis=1, initial=-1) < _half(threshold)]
    centres = np.concatenate([tight, loose(free, threshold, max(16, LEAST_BALL * len(sample)))]) if len(sample) else sample
    n_tight = len(tight)
    inner = np.where(np.arange(len(centres)) < n_tight, _half(threshold), threshold)
    outer = np.where(np.arange(len(centres)) < n_tight, _reach(threshold), _reach(threshold, 1.0))

    # --- balls, then loose groups: members (core) and what lies within their reach (shell) ---
    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [np.asarray(v, np.float64).tobytes() for v in batch["v"]]
            core, near = np.full(len(batch), -1), [[] for _ in data]
            if len(centres) and len(batch):
                close = _cosines(_unit(pd.Series(data)), centres)
                inside = close >= inner
                core = np.where(inside.any(1), inside.argmax(1), -1)
                for i, ball in zip(*np.nonzero(close >= outer)):
                    if ball != core[i]:
                        near[i].append(int(ball))
            yield pd.DataFrame({"id": batch["id"], "n": batch["n"], "v": data, "core": core, "near": near})

    settled = store(classes.select("id", "n", "v").mapInPandas(
        settle, "id long, n long, v binary, core int, near array<int>"), "vectors")
    cores = settled.filter("core >= 0")
    sizes = {r["core"]: r for r in cores.groupBy("core").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"), F.min("id").alias("least")).collect()}  # at most 1 / LEAST_BALL rows
    if sizes:
        table = spark.createDataFrame([(k, r["rows"], r["least"]) for k, r in sizes.items() if k < n_tight], "core int, rows long, least long")
        joined = cores.select("id", "n", "core").join(F.broadcast(table), "core")
        links.append(joined.select("id", (F.col("rows") - F.col("n")).alias("links")))
        edges.append(joined.select(F.col("id").alias("u"), F.col("least").alias("v")))
        spread_out = {k: r["classes"] for k, r in sizes.items() if k >= n_tight}
        if spread_out:
            _compare_loose(cores, spread_out, threshold, 4 * leaf, links, edges)
        shell = settled.select("id", "n", "v", F.col("core").alias("own"), F.explode("near").alias("core"))
        around = {r["core"]: r["count"] for r in shell.groupBy("core").count().collect()}
        if around:
            _compare_balls(cores, shell, {k: (sizes[k]["classes"], c) for k, c in around.items() if k in sizes}, threshold, leaf, links, edges)

    # --- the forest over everything else ---
    rest = settled.filter("core < 0").select("id", "n", "v")
    left = count - sum(r["classes"] for r in sizes.values())
    if left < 2:
        return
    if len(centres):
        sample = sample[(_cosines(sample, centres) < inner).all(axis=1)]
    depth = depth_for(left, leaf)
    levels = min(depth, int(np.log2(max(1, len(sample) / 16))))
    forest = [grow(sample, levels, seed * 1000 + t) for t in range(trees or trees_for(depth, threshold, recall))]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            v, ids, data = _unit(batch["v"]), batch["id"].to_numpy(), batch["v"].to_numpy(object)
            for t, tree in enumerate(forest):
                parts = route(tree, v)
                at = np.concatenate([r for _, r in parts])
                names = np.repeat(np.array([_key(node, t) for node, _ in parts], np.int64), [len(r) for _, r in parts])
                yield pd.DataFrame({"leaf": names, "id": ids[at], "v": data[at]})

    placed = store(rest.select("id", "v").mapInPandas(spread, "leaf long, id long, v binary"), "leaves")
    finished = []
    for _ in range(40):  # leaves that the sample could not make small enough are split further, each on its own sample
        counted = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
        large = store(counted.filter(F.col("size") > 4 * leaf), "large-leaves")
        if large.isEmpty():
            break
        finished.append(placed.join(large, "leaf", "left_anti"))
        placed, stuck = _split(placed.join(large, "leaf"), leaf, threshold)
        finished.append(stuck)
    finished.append(placed)
    _compare_leaves(reduce(DataFrame.unionByName, finished), rest, threshold, 4 * leaf, links, edges)


def _split(placed: DataFrame, leaf: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Split large leaves again, on a hashed sample of each: (rows in their new leaves, rows of leaves that are done).

    Groups that the sample shows become leaves of their own with all that is near them, and are done; their members
    are not split. A leaf is done as a whole if it cannot be split or if its groups overlap so much that comparing them
    costs more than comparing the leaf.
    """
    share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("size"))
    chosen = placed.filter(F.pmod(F.xxhash64("leaf", "id"), F.lit(1 << 20)) < share * (1 << 20))

    def fit(key, batch: pd.DataFrame) -> pd.DataFrame:
        name, size = int(batch["leaf"].iloc[0]), int(batch["size"].iloc[0])
        sample = _unit(batch["v"])
        centres = loose(sample, threshold, max(16, LEAST_BALL * len(sample)))
        close = _cosines(sample, centres)
        if ((close >= _reach(threshold, 1.0)).mean(axis=0) ** 2).sum() >= 1:
            low = high = np.full(1, np.nan)
            centres = centres[:0]
        else:
            others = sample[(close < threshold).all(axis=1)]
            levels = depth_for(size * len(others) / len(sample), leaf)
            _, low, high = grow(others, max(1, min(levels, int(np.log2(max(2, len(others) / 16))))), abs(name))
        return pd.DataFrame({"leaf": [name], "low": [low.tobytes()], "high": [high.tobytes()], "centres": [centres.tobytes()]})

    trees = store(chosen.groupBy("leaf").applyInPandas(fit, "leaf long, low binary, high binary, centres binary"), "subtrees")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("leaf"):
                low, high, centres = (np.frombuffer(part[c].iloc[0], np.float64) for c in ("low", "high", "centres"))
                v = _unit(part["v"])
                close = _cosines(v, centres.reshape(-1, v.shape[1]))
                around = [(_key(-1 - g, 0, int(name)), np.flatnonzero(close[:, g] >= _reach(threshold, 1.0)), True) for g in range(close.shape[1])]
                free = np.flatnonzero((close < threshold).all(axis=1))
                if np.isnan(low[0]):
                    around.append((int(name), free, True))
                else:
                    around += [(_key(node, 0, int(name)), free[r], False) for node, r in route((abs(int(name)), low, high), v[free])]
                at, sizes = np.concatenate([r for _, r, _ in around]), [len(r) for _, r, _ in around]
                names, done = np.repeat(np.array([k for k, _, _ in around], np.int64), sizes), np.repeat([d for _, _, d in around], sizes)
                yield pd.DataFrame({"leaf": names, "id": part["id"].to_numpy()[at], "v": part["v"].to_numpy(object)[at], "stuck": done})

    moved = store(placed.drop("size").join(trees, "leaf").mapInPandas(spread, "leaf long, id long, v binary, stuck boolean"), "leaves")
    return moved.filter("not stuck").drop("stuck"), moved.filter("stuck").drop("stuck")


def _tiled(placed: DataFrame, tile: int) -> DataFrame:
    """Rows with the tasks (a, b), a <= b, that compare their tile of a leaf with every tile of it; mostly one."""
    tiles = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = placed.join(tiles, "leaf").withColumn("tiles", F.ceil(F.col("size") / tile).cast("int"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    rows = rows.withColumn("other", other)
    return rows.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other")).drop("size", "tiles", "other")


def _between(batch: pd.DataFrame) -> np.ndarray:
    """Which pairs the task compares: all in one tile, or only those across its two tiles."""
    a, b, tile = int(batch["a"].iloc[0]), int(batch["b"].iloc[0]), batch["tile"].to_numpy()
    return np.ones((len(batch),) * 2, bool) if a == b else tile[:, None] != tile[None, :]


def _compare_leaves(placed: DataFrame, rest: DataFrame, threshold: float, tile: int, links: list, edges: list) -> None:
    """Links within leaves. First who is linked at all and with which component, then the counts.

    A pair that shares several leaves is counted in the one of least name: rows know the leaves in which they have
    links, and two linked rows have links in every leaf they share.
    """
    def find(batch: pd.DataFrame) -> pd.DataFrame:
        ids = batch["id"].to_numpy(np.int64)
        linked = _linked(_unit(batch["v"]), threshold) & _between(batch)
        some = linked.any(1)
        least = _least_reachable(linked[np.ix_(some, some)], ids[some])
        return pd.DataFrame({"leaf": batch["leaf"].iloc[0], "id": ids[some], "least": least})

    active = store(_tiled(placed, tile).groupBy("leaf", "a", "b").applyInPandas(find, "leaf long, id long, least long"), "linked")
    edges.append(active.select(F.col("id").alias("u"), F.col("least").alias("v")))
    pairs = active.select("leaf", "id").distinct()
    leaves = pairs.groupBy("id").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))  # as many as trees and bands give

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        ids, n, name = batch["id"].to_numpy(np.int64), batch["n"].to_numpy(np.int64), batch["leaf"].iloc[0]
        linked = _linked(_unit(batch["v"]), threshold) & _between(batch)
        before: dict[int, list[int]] = {}
        for i, own in enumerate(batch["leaves"]):
            for other in own:
                if other >= name:
                    break
                before.setdefault(other, []).append(i)
        for rows in before.values():
            if len(rows) > 1:
                linked[np.ix_(rows, rows)] = False
        return pd.DataFrame({"id": ids, "links": linked @ n})

    rows = pairs.join(leaves, "id").join(rest, "id")
    links.append(store(
        _tiled(rows, tile).groupBy("leaf", "a", "b").applyInPandas(count, "id long, links long").filter("links > 0"), "link-counts"))


def _compare_balls(cores: DataFrame, shell: DataFrame, sizes: dict[int, tuple[int, int]], threshold: float, leaf: int, links: list, edges: list) -> None:
    """Links between members of balls or loose groups and the vectors near them, in tiles of both.

    A pair of members of two balls is met from both; it counts in the ball of the lower number.
    """
    spark, tile = cores.sparkSession, 4 * leaf
    table = spark.createDataFrame(
        [(k, -(-a // tile), -(-b // tile)) for k, (a, b) in sizes.items()], "core int, mine int, theirs int")
    place = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    inside = cores.select("id", "n", "v", "core").join(F.broadcast(table), "core").withColumn("a", place("mine")).withColumn("b", every("theirs"))
    outside = shell.join(F.broadcast(table), "core").withColumn("b", place("theirs")).withColumn("a", every("mine"))
    outside = outside.toDF(*outside.columns)  # both sides come from one table; new names keep their columns apart

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"id": [], "links": [], "least": []}).astype("int64")
        if not len(x) or not len(y):
            return out
        linked = _met(_unit(x["v"]), _unit(y["v"]), threshold)
        own, ball = y["own"].to_numpy(), x["core"].iloc[0]
        linked &= ((own < 0) | (own > ball))[None, :]
        out = _both(x, y, linked)
        return out[out["links"] > 0]

    met = store(inside.groupBy("core", "a", "b").cogroup(outside.groupBy("core", "a", "b")).applyInPandas(
        meet, "id long, links long, least long"), "ball-links")
    links.append(met.select("id", "links"))
    edges.append(met.select(F.col("id").alias("u"), F.col("least").alias("v")))


def _both(x: pd.DataFrame, y: pd.DataFrame, linked: np.ndarray) -> pd.DataFrame:
    """id, links and least reachable id for the rows of both sides."""
    ids, others = x["id"].to_numpy(np.int64), y["id"].to_numpy(np.int64)
    least, least_other = _least_across(linked, ids, others)
    mine = pd.DataFrame({"id": ids, "links": _weighed(linked, y["n"].to_numpy()), "least": least})
    return pd.concat([mine, pd.DataFrame({"id": others, "links": _weighed(linked.T, x["n"].to_numpy()), "least": least_other})])


def _compare_loose(cores: DataFrame, sizes: dict[int, int], threshold: float, tile: int, links: list, edges: list) -> None:
    """Links within loose groups: all pairs, in tasks of two tiles. Up to 16 tiles are small, then they grow to ``TILE``."""
    parts = [(k, max(min(16, -(-n // tile)), -(-n // TILE))) for k, n in sizes.items()]
    table = cores.sparkSession.createDataFrame(parts, "core int, tiles int")
    rows = cores.select("id", "n", "v", "core").join(F.broadcast(table), "core").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other")).drop("tiles", "other")

    def meet(batch: pd.DataFrame) -> pd.DataFrame:
        first = batch["tile"].to_numpy() == batch["a"].iloc[0]
        x, v = batch[first], _unit(batch["v"])
        if batch["a"].iloc[0] == batch["b"].iloc[0]:
            linked = _met(v, v, threshold)
            np.fill_diagonal(linked, False)
            out = _both(x, x, linked).iloc[:len(x)]
        else:
            if first.all() or not first.any():
                return pd.DataFrame({"id": [], "links": [], "least": []}).astype("int64")
            out = _both(x, batch[~first], _met(v[first], v[~first], threshold))
        return out[out["links"] > 0]

    met = store(rows.groupBy("core", "a", "b").applyInPandas(meet, "id long, links long, least long"), "loose-links")
    links.append(met.select("id", "links"))
    edges.append(met.select(F.col("id").alias("u"), F.col("least").alias("v")))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0),
e AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT u, w FROM e UNION SELECT reach.u, e.w FROM reach JOIN e ON reach.w = e.u),
n AS (SELECT u, count(*) AS n_links FROM e GROUP BY u), m AS (SELECT u, min(w) AS least FROM reach GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(m.least, vec_id)) AS component_id,
       vec_id <= coalesce(m.least, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN m ON m.u = vec_id
"""


@query("op4_projection_forest", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))
