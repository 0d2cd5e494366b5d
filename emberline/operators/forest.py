"""A random forest over quantile bins: Gini splits, a bootstrap of the rows for every tree, some predictors for every node.

Bootstraps are drawn from the row's key and the tree, predictors from the node's place in its tree, and class counts are
whole numbers, so a forest does not depend on files, partitions or cores. Up to ``ALONE`` rows a task is given all rows, and
grows its share of the trees level by level. Larger parts are worked over some trees at a time: the upper levels are
grown by jobs that add up histograms of all rows, until no node has more than ``ALONE`` rows; then the rows of every node
go to one task, which grows what is below it. All rows are used at every level; no task holds more than about ``ALONE``.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from emberline.operators.blocks import Binned, binned, binned_rows, drawn, edges, uniform

#: Bins of a predictor.
BINS = 32
#: Rows of a block.
BLOCK_ROWS = 32_768
#: Rows that one task grows trees from.
ALONE = 1_048_576
#: Rows, over all trees, that are dealt to tasks at a time.
DEALT = 134_217_728
#: Both class counts of a cell are added as one number: that of class 1 counts so much.
PAIR = float(1 << 26)
# Fixed value: a bootstrap draws a row k times where a uniform number is from the k-th of these up to the next.
DRAWS = np.ceil(np.cumsum(np.exp(-1) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320], float)) * (1 << 53)).astype(np.uint64)


@dataclass
class Nodes:
    """Nodes as arrays; ``feature`` is -1 at leaves, a row goes left if its bin is at most ``split``, the right child is next to the left."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def bytes(self) -> bytes:
        return b"".join(a.astype(kind).tobytes() for a, kind in zip(vars(self).values(), KINDS, strict=True))


KINDS = ("int16", "uint8", "int32", "float64")


def nodes_of(raw: bytes) -> Nodes:
    sizes = [np.dtype(k).itemsize for k in KINDS]
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(KINDS, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * size
    return Nodes(*out)


class Walk:
    """A tree ready to be walked by blocks of rows; a leaf leads to itself."""

    def __init__(self, nodes: Nodes):
        inner, own = nodes.feature >= 0, np.arange(len(nodes.feature))
        self.feature = np.where(inner, nodes.feature, 0).astype(np.int64)
        self.split, self.left = np.where(inner, nodes.split, 255).astype(np.uint8), np.where(inner, nodes.left, own)
        self.inner, self.value = inner, nodes.value

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``bins`` has a line for every predictor."""
        n = bins.shape[1]
        flat, out, rows = bins.reshape(-1), np.zeros(n, np.int64), np.arange(n)
        at = out if len(self.inner) else out[:0]
        while len(rows):
            open_rows = np.flatnonzero(self.inner[at])
            if len(open_rows) < len(rows):
                out[rows] = at
                rows, at = rows[open_rows], at[open_rows]
            at = self.left[at] + (flat[self.feature[at] * n + rows] > self.split[at])
        return out


@dataclass(frozen=True)
class Plan:
    """What all trees of a forest have in common."""

    width: int
    depth: int
    take: int
    weights: tuple[float, float]
    seed: int

    def salt(self, tree: int) -> int:
        return self.seed * 1_000_003 + tree

    def features(self, tree: int, places: np.ndarray) -> np.ndarray:
        """Predictors that nodes may use, a line for every node, in order. A node's place: 1 for the root, twice its parent's or one more."""
        order = np.argsort(uniform(places, self.salt(tree), self.width), 1, kind="stable")
        return np.sort(order[:, : self.take], 1)


def bootstrap(key: np.ndarray, salt: int) -> np.ndarray:
    """How often a row is drawn: on average once."""
    return np.searchsorted(DRAWS, drawn(key, salt), side="right")


def paired(y: np.ndarray, times: np.ndarray) -> np.ndarray:
    return np.where(y > 0, PAIR, 1.0) * times


def sums(bins: np.ndarray, pair: np.ndarray, at: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Class counts by class, node, predictor of the node and bin. Rows whose node is one after the last are left out."""
    n, (k, take) = bins.shape[1], features.shape
    flat, rows, cells = bins.reshape(-1), np.arange(n), (k + 1) * BINS
    lines, start, out = np.vstack([features, np.zeros((1, take), int)]) * n, at * BINS, np.empty((2, k, take, BINS), np.int64)
    for j in range(take):
        place = lines[:, j][at]
        place += rows
        both = np.bincount(start + flat[place], pair, cells)[: k * BINS].reshape(k, BINS)
        out[1, :, j] = one = np.floor(both / PAIR)
        out[0, :, j] = both - one * PAIR
    return out


def best_splits(found: np.ndarray, features: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, ...]:
    """By node: predictor (-1 if no split has any gain), bin, class counts to the left. Equal gains: first predictor, first bin."""
    left, whole = np.cumsum(found, 3)[..., :-1], found.sum(3, keepdims=True)
    right = whole - left

    def purity(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = counts[0] * weights[0], counts[1] * weights[1]
        return (a * a + b * b) / np.maximum(a + b, 1e-300), counts[0] + counts[1]

    (l_pure, l_n), (r_pure, r_n), (pure, _) = purity(left), purity(right), purity(whole)
    gain = np.where((l_n > 0) & (r_n > 0), l_pure + r_pure - pure, 0.0)
    k = len(features)
    flat = gain.reshape(k, -1)
    at = flat.argmax(1)
    nodes, slot, split = np.arange(k), at // (BINS - 1), at % (BINS - 1)
    good = flat[nodes, at] > 1e-9 * np.maximum(pure[:, 0, 0], 1e-300)
    return np.where(good, features[nodes, slot], -1), split, left[:, nodes, slot, split]


class Growing:
    """A tree, or what is below a node of one, while it grows: its nodes so far, and those that may still be parted."""

    def __init__(self, plan: Plan, tree: int, counts: np.ndarray, place: int = 1, level: int = 0):
        self.plan, self.tree, self.level = plan, tree, level
        self.feature, self.split, self.left = [np.array([-1])], [np.array([0])], [np.array([0])]
        self.counts, self.size = [counts.reshape(2, 1)], 1
        self.front, self.places = self.open(np.array([0]), np.array([place]), counts.reshape(2, 1))

    def open(self, nodes: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        may = (counts > 0).all(0) & (self.level < self.plan.depth)
        return nodes[may], places[may]

    def features(self) -> np.ndarray:
        return self.plan.features(self.tree, self.places)

    def grow(self, feature: np.ndarray, split: np.ndarray, left: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Children of the front's nodes. By node of the front, the place of its left child in the new front, of its right one; -1: none."""
        good = np.flatnonzero(feature >= 0)
        ids = self.size + 2 * np.arange(len(good))
        every = [np.concatenate(a) for a in (self.feature, self.split, self.left)]
        for values, new in zip(every, (feature[good], split[good], ids), strict=True):
            values[self.front[good]] = new
        none = np.zeros(2 * len(good), int)
        self.feature, self.split, self.left = ([a, b] for a, b in zip(every, (none - 1, none, none), strict=True))
        both = np.stack([left[:, good], whole[:, good] - left[:, good]], 2).reshape(2, -1)
        self.counts.append(both)
        self.size += 2 * len(good)
        self.level += 1
        children = np.stack([ids, ids + 1], 1).reshape(-1)
        places = (self.places[good, None] * 2 + np.arange(2)).reshape(-1)
        self.front, self.places = self.open(children, places, both)
        at = np.full(self.size, -1)
        at[self.front] = np.arange(len(self.front))
        out = np.full((len(feature), 2), -1)
        out[good] = at[children].reshape(-1, 2)
        return out

    def nodes(self) -> Nodes:
        a, b = np.concatenate(self.counts, 1) * np.array(self.plan.weights)[:, None]
        return Nodes(*(np.concatenate(x) for x in (self.feature, self.split, self.left)), b / np.maximum(a + b, 1e-300))


def grown(bins: np.ndarray, pair: np.ndarray, plan: Plan, tree: int, place: int = 1, level: int = 0) -> Nodes:
    """A tree, or what is below one of its nodes, from all rows that are there."""
    one = np.floor(pair / PAIR)
    state = Growing(plan, tree, np.array([(pair - one * PAIR).sum(), one.sum()]).astype(np.int64), place, level)
    at = np.zeros(len(pair), np.int64)
    while len(state.front):
        n, k, features = len(pair), len(state.front), state.features()
        found = sums(bins, pair, at, features)
        feature, split, left = best_splits(found, features, plan.weights)
        children = np.vstack([state.grow(feature, split, left, found[:, :, 0].sum(2)), [[-1, -1]]])
        line, split = np.append(np.maximum(feature, 0), 0) * n, np.append(split, 0)
        right = bins.reshape(-1)[line[at] + np.arange(n)] > split[at]
        at = children.reshape(-1)[2 * at + right]
        use = np.flatnonzero(at >= 0)
        if len(use) < 0.8 * n:
            bins, pair, at = bins.take(use, 1), pair[use], at[use]
        else:
            at[at < 0] = len(state.front)
    return state.nodes()


# ---- jobs over rows ---------------------------------------------------------------------------------


def alone(rows: RDD, plan: Plan, trees: int, tasks: int) -> list[Nodes]:
    """A forest whose rows fit a task: every task gets all rows and its share of the trees."""

    def share(some: Iterable[tuple[int, Binned]]) -> Iterable[tuple[int, bytes]]:
        found: dict[int, list[Binned]] = {}
        for task, b in some:
            found.setdefault(task, []).append(b)
        for task, blocks in found.items():
            key, bins, y = (np.concatenate(x, -1) for x in zip(*((b.key, b.bins, b.y) for b in blocks), strict=True))
            for tree in range(task, trees, tasks):
                times = bootstrap(key, plan.salt(tree))
                use = np.flatnonzero(times)
                yield tree, grown(bins.take(use, 1), paired(y[use], times[use]), plan, tree).bytes()

    dealt = rows.flatMap(lambda b: [(task, b) for task in range(tasks)]).partitionBy(tasks, lambda task: task)
    return [nodes_of(raw) for _, raw in sorted(dealt.mapPartitions(share).collect())]


def walked(b: Binned, plan: Plan, tree: int, walk: Walk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins and pairs of a block's rows that a tree draws, and their nodes."""
    times = bootstrap(b.key, plan.salt(tree))
    use = np.flatnonzero(times)
    bins = b.bins.take(use, 1)
    return bins, paired(b.y[use], times[use]), walk.nodes(bins)


def upper(rows: RDD, plan: Plan, trees: Sequence[int], tasks: int) -> list[Growing]:
    """Trees grown until no node that may be parted has more than ``ALONE`` rows; a job a level."""

    def counted(some: Iterable[Binned]) -> Iterable[tuple[int, np.ndarray]]:
        out = np.zeros((len(trees), 2), np.int64)
        for b in some:
            for k, tree in enumerate(trees):
                out[k] += np.bincount(b.y > 0, bootstrap(b.key, plan.salt(tree)), 2).astype(np.int64)
        yield out

    state = [Growing(plan, tree, c) for tree, c in zip(trees, rows.mapPartitions(counted).treeReduce(lambda a, b: a + b), strict=True)]
    while True:
        wide = [k for k, s in enumerate(state) if len(s.front) and np.concatenate(s.counts, 1)[:, s.front].sum(0).max() > ALONE]
        if not wide:
            return state
        open_trees = [(k, state[k].tree, Walk(state[k].nodes()), state[k].front, state[k].features()) for k in wide]

        def added(some: Iterable[Binned], open_trees=open_trees) -> Iterable[tuple[tuple[int, int], np.ndarray]]:
            out = {}
            for b in some:
                for k, tree, walk, front, features in open_trees:
                    bins, pair, node = walked(b, plan, tree, walk)
                    at = np.full(len(walk.inner), len(front))
                    at[front] = np.arange(len(front))
                    found = sums(bins, pair, at[node], features)
                    out[k] = out[k] + found if k in out else found
            for k, found in out.items():
                for j in range(found.shape[1]):
                    yield (k, j), found[:, j]

        of = {k: features for k, _, _, _, features in open_trees}

        def parted(item: tuple[tuple[int, int], np.ndarray], of=of) -> tuple:
            (k, j), found = item
            feature, split, left = best_splits(found[:, None], of[k][j : j + 1], plan.weights)
            return k, j, feature[0], split[0], left[:, 0], found[:, 0].sum(1)

        nodes = sum(len(front) for _, _, _, front, _ in open_trees)
        got: dict[int, list] = {k: [] for k in wide}
        for k, *rest in rows.mapPartitions(added).reduceByKey(lambda a, b: a + b, min(tasks, nodes)).map(parted).collect():
            got[k].append(rest)
        for k, some in got.items():
            some.sort(key=lambda r: r[0])
            _, feature, split, left, whole = zip(*some, strict=True)
            state[k].grow(np.array(feature), np.array(split), np.array(left).T, np.array(whole).T)


def lower(rows: RDD, plan: Plan, state: Sequence[Growing]) -> list[Nodes]:
    """Whole trees: the rows of every open node go to one task, which grows what is below it."""
    groups, full, task = {}, 0, 0
    for k, s in enumerate(state):
        counts = np.concatenate(s.counts, 1)[:, s.front].sum(0)
        for j, n in enumerate(counts.tolist()):
            if full and full + n > ALONE:
                full, task = 0, task + 1
            full += n
            groups[k, j] = task, s.tree, int(s.places[j]), s.level
    walks = [(k, s.tree, Walk(s.nodes()), s.front) for k, s in enumerate(state) if len(s.front)]

    def sent(b: Binned) -> Iterable[tuple[int, tuple]]:
        for k, tree, walk, front in walks:
            bins, pair, node = walked(b, plan, tree, walk)
            at = np.full(len(walk.inner), -1)
            at[front] = np.arange(len(front))
            node = at[node]
            order = np.argsort(node, kind="stable")
            ends = np.searchsorted(node[order], np.arange(len(front) + 1))
            for j in range(len(front)):
                if ends[j] < ends[j + 1]:
                    use = order[ends[j] : ends[j + 1]]
                    yield groups[k, j][0], ((k, j), bins.take(use, 1), pair[use])

    def below(some: Iterable[tuple[int, tuple]]) -> Iterable[tuple]:
        found: dict[tuple[int, int], list] = {}
        for _, (group, bins, pair) in some:
            found.setdefault(group, []).append((bins, pair))
        for group, parts in found.items():
            _, tree, place, level = groups[group]
            bins, pair = (np.concatenate(x, -1) for x in zip(*parts, strict=True))
            yield group, grown(bins, pair, plan, tree, place, level).bytes()

    got = dict(rows.flatMap(sent).partitionBy(task + 1, lambda t: t).mapPartitions(below).collect()) if groups else {}
    out = []
    for k, s in enumerate(state):
        whole = s.nodes()
        pieces = [[a] for a in vars(whole).values()]
        size = len(whole.feature)
        for j, node in enumerate(s.front.tolist()):
            piece = nodes_of(got[k, j])
            if len(piece.feature) < 2:
                continue
            # The piece's root is the node itself; its other nodes come after all that are there.
            left = np.where(piece.feature >= 0, piece.left + size - 1, 0)
            for values, new in zip(pieces, (piece.feature, piece.split, left, piece.value), strict=True):
                values[0][node] = new[0]
                values.append(new[1:])
            size += len(piece.feature) - 1
        out.append(Nodes(*(np.concatenate(p) for p in pieces)))
    return out


class ForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A random forest: adds ``probability`` (vector) and ``prediction`` to rows with features."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    cuts = Param(Params._dummy(), "cuts", "edges of the bins: their numbers and values", TypeConverters.toListListFloat)
    sizes = Param(Params._dummy(), "sizes", "nodes of every tree", TypeConverters.toListInt)
    trees = Param(Params._dummy(), "trees", "nodes of all trees, packed", TypeConverters.toString)

    def __init__(self, cuts: Sequence[np.ndarray] | None = None, trees: Sequence[Nodes] | None = None):
        super().__init__()
        self._setDefault(featuresCol="features")
        if cuts is not None:
            raw = zlib.compress(b"".join(t.bytes() for t in trees), 1)
            self._set(cuts=[c.tolist() for c in cuts], sizes=[len(t.feature) for t in trees], trees=base64.b64encode(raw).decode())

    @property
    def getNumTrees(self) -> int:
        return len(self.getOrDefault(self.sizes))

    def grown_trees(self) -> list[Nodes]:
        raw, at, out = zlib.decompress(base64.b64decode(self.getOrDefault(self.trees))), 0, []
        for size in self.getOrDefault(self.sizes):
            end = at + size * sum(np.dtype(k).itemsize for k in KINDS)
            out.append(nodes_of(raw[at:end]))
            at = end
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, trees = [np.array(c) for c in self.getOrDefault(self.cuts)], self.grown_trees()

        @F.pandas_udf("array<double>")
        def likely(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            walks = [Walk(t) for t in trees]
            for x in batches:
                if not len(x):
                    yield pd.Series([], dtype=object)
                    continue
                bins = binned(np.stack(x.to_numpy()), cuts)
                p = sum((walk.value[walk.nodes(bins)] for walk in walks), np.zeros(len(x))) / len(walks)
                yield pd.Series(list(np.stack((1 - p, p), 1)))

        p = dataset.withColumn("_p", likely(vector_to_array(self.getOrDefault(self.featuresCol))))
        best = (F.element_at("_p", 2) > 0.5).cast("double")
        return p.withColumns({"probability": array_to_vector("_p"), "prediction": best}).drop("_p")


def fit_forest(
    train: DataFrame,
    predictors: Sequence[str],
    target: str,
    n_estimators: int,
    max_depth: int,
    weights: tuple[float, float] = (1.0, 1.0),
    seed: int = 42,
    key: Column | None = None,
) -> ForestModel:
    """A forest on a 0/1 target. A node may use the root of the number of predictors, rounded up."""
    spark = train.sparkSession
    n, cuts = train.where(F.col(target).isNotNull()).count(), edges(train, predictors, BINS)
    if not n:
        raise ValueError("no rows with a label")
    plan = Plan(len(predictors), max_depth, int(np.ceil(np.sqrt(len(predictors)))), weights, seed)
    rows = binned_rows(train, predictors, target, cuts, BLOCK_ROWS, key).persist(StorageLevel.MEMORY_AND_DISK)
    cores = spark.sparkContext.defaultParallelism
    try:
        if n <= ALONE:
            trees = alone(rows, plan, n_estimators, min(n_estimators, 2 * cores))
        else:
            trees, most = [], max(1, DEALT // n)
            while len(trees) < n_estimators:
                some = range(len(trees), min(n_estimators, len(trees) + most))
                trees += lower(rows, plan, upper(rows, plan, some, 2 * cores))
    finally:
        rows.unpersist()
    return ForestModel(cuts, trees)
