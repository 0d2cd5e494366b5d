"""Second-order boosted trees over quantile bins, grown in one running fit.

Predictors are cut into bins by a quantile sketch. A tree grows level by level: every task adds up first and second
derivatives of its rows per node, predictor and bin; the histograms of a node are summed by a shuffle keyed by
node, and its best split is found where they meet, so that the driver gets one small row per node. Derivatives are
added as whole numbers (fixed point), so sums, and with them the whole fit, do not depend on partitions or order.

A tree begins with its sampled rows and their derivatives, which are kept while it grows: a level only walks them to their
nodes and adds them up. Blocks are dealt evenly to as many partitions as there are cores, or more where a partition would
hold over ``MOST_ROWS`` rows, so that there are few histograms to sum; at most ``FEW`` of them are summed by the driver.

Rows that fit one task (``ALONE``) need no exchange at all. There a task grows in a row all the trees that are certainly made
before the fit can end. It adds up only the rows of the smaller child of a node; those of the other one are the rest of its
parent's, which in whole numbers is the same.

Rows keep their margin in the executors. Every tree brings it forward, within the first job that reads it; after
``KEEP`` trees the rows are checkpointed in the shared folder, so that no plan reaches back over all trees. The fit ends
when the loss on validation rows has not fallen for ``patience`` rounds. That can come at the earliest ``patience`` rounds
after the best one known, so the losses of all rounds up to there are read in one job: no round is made twice or too much.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from emberline.operators.blocks import PART_ROWS, Blocks, binned, binned_rows, dealt_evenly, drawn, edges, limit, uniform
from emberline.session import shared_folder

BINS = 256
#: Trees after which the margins of the rows are checkpointed.
KEEP = 20
#: Derivatives are added in units of one in so many.
UNIT = 1 << 20
#: Validation losses are added in units of one in so many.
LOSS_UNIT = 1 << 32
#: Rows whose derivatives are added up at a time.
BLOCK_ROWS = 32_768
#: No partition gets more than about so many rows; up to that there is one for every ``PART_ROWS`` rows, at most one a core.
MOST_ROWS = 2_097_152
#: Rows from which one task grows whole trees.
ALONE = 1_048_576
#: Histograms (37 kB for nine predictors) that the driver sums itself. A level that has more of them, over all tasks, sums
#: them by a shuffle, with a task for so many.
FEW = 192
# Penalty on leaf values, least second derivative of a child.
PENALTY = 1.0
LEAST = 1.0


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 at leaves, a row goes left if its bin is at most ``split``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    split: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, split: int, values: tuple[float, float]) -> tuple[int, int]:
        """Children of a node: left and the one after it."""
        left = len(self.feature)
        self.feature[node], self.split[node], self.left[node] = feature, split, left
        self.feature += [-1, -1]
        self.split += [0, 0]
        self.left += [0, 0]
        self.value += values
        return left, left + 1

    def depth(self) -> int:
        depth = [0] * len(self.feature)
        for node, left in enumerate(self.left):
            if self.feature[node] >= 0:
                depth[left] = depth[left + 1] = depth[node] + 1
        return max(depth)


class Walk:
    """A tree ready to be walked by blocks of rows; a leaf leads to itself."""

    def __init__(self, tree: Tree):
        feature, own = np.array(tree.feature), np.arange(len(tree.feature))
        inner = feature >= 0
        self.feature = np.where(inner, feature, 0)
        self.split = np.where(inner, tree.split, BINS).astype(np.int16)
        self.left, self.value, self.depth = np.where(inner, tree.left, own), np.array(tree.value), tree.depth()

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``bins`` has a line for every predictor."""
        n = bins.shape[1]
        flat, rows, at = bins.reshape(-1), np.arange(n), np.zeros(n, np.int64)
        for _ in range(self.depth):
            place = self.feature[at]
            place *= n
            place += rows
            right = flat[place] > self.split[at]
            at = self.left[at]
            at += right
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]


@dataclass
class Rows:
    """A block with bins instead of values, a line for every predictor, and the margins of its rows so far."""

    key: np.ndarray
    bins: np.ndarray
    y: np.ndarray
    margin: np.ndarray


@dataclass
class Drawn:
    """What a tree sees of a block: bins and both derivatives, as whole numbers, of the rows sampled for it."""

    bins: np.ndarray
    both: np.ndarray


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int
    left: tuple[float, float]
    right: tuple[float, float]


def chosen(width: int, share: float, salt: int) -> np.ndarray:
    """Predictors that a tree may use: a share of them, one at least."""
    take = max(1, round(share * width))
    return np.sort(np.argsort(uniform(np.arange(width), salt), kind="stable")[:take])


def sampled(r: Rows, features: np.ndarray, sample: float, salt: int, weight: float) -> Drawn:
    """Rows and predictors that a tree uses; ``weight`` is that of positive rows."""
    y, margin = r.y, r.margin
    if sample < 1:
        use = np.flatnonzero(drawn(r.key, salt) < limit(sample))
        bins, y, margin = np.stack([r.bins[f].take(use) for f in features]), y[use], margin[use]
    else:
        bins = r.bins[features]
    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    w = np.where(y > 0, weight, 1.0)
    return Drawn(bins, np.rint(np.stack(((p - y) * w, np.maximum(p * (1 - p), 1e-16) * w)) * UNIT))


def histograms(rows: Iterable[Drawn], walk: Walk, frontier: Sequence[int]) -> Iterable[tuple[int, np.ndarray]]:
    """(node, sums by derivative, predictor and bin) over some rows."""
    first, sums = np.full(len(walk.feature), -1), None
    first[list(frontier)] = np.arange(len(frontier)) * BINS
    for r in rows:
        if sums is None:
            sums = np.zeros((2, len(r.bins), len(frontier) * BINS), np.int64)
        start, bins, both = first[walk.nodes(r.bins)], r.bins, r.both
        if (start < 0).any():  # rows of nodes that are done
            use = np.flatnonzero(start >= 0)
            start, bins, both = start[use], bins.take(use, 1), both.take(use, 1)
        cell = np.empty_like(start)
        for k, line in enumerate(bins):
            np.add(start, line, out=cell)
            for which, values in enumerate(both):
                found = np.bincount(cell, weights=values, minlength=sums.shape[2])
                np.add(sums[which, k], found, out=sums[which, k], casting="unsafe")
    if sums is None:
        return
    sums = sums.reshape(2, -1, len(frontier), BINS)
    for k, node in enumerate(frontier):
        if sums[1, :, k].any():
            yield node, sums[:, :, k]


def best_split(sums: np.ndarray, features: np.ndarray) -> Split:
    """The split of most gain; gain 0 and feature -1 if none has any. Equal gains: first predictor, then first bin."""
    g, h = sums / UNIT
    left_g, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
    all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - all_g**2 / (all_h + PENALTY)
    gain = np.where((left_h >= LEAST) & (right_h >= LEAST), gain, 0)
    k, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[k, b] <= 1e-9:
        return Split(0.0, -1, 0, (float(all_g[0, 0]), float(all_h[0, 0])), (0.0, 0.0))
    return Split(
        float(gain[k, b]), int(features[k]), int(b), (float(left_g[k, b]), float(left_h[k, b])), (float(right_g[k, b]), float(right_h[k, b]))
    )


def best_of(sums: np.ndarray, features: np.ndarray) -> list[Split]:
    """The same for several nodes, the first axis of ``sums``."""
    g, h = np.moveaxis(sums / UNIT, 1, 0)
    left_g, left_h = np.cumsum(g, 2)[..., :-1], np.cumsum(h, 2)[..., :-1]
    all_g, all_h = g.sum(2, keepdims=True), h.sum(2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - all_g**2 / (all_h + PENALTY)
    gain = np.where((left_h >= LEAST) & (right_h >= LEAST), gain, 0).reshape(len(sums), -1)
    at = gain.argmax(1)
    k, b = np.divmod(at, BINS - 1)
    n = np.arange(len(sums))
    whole = zip(all_g[:, 0, 0].tolist(), all_h[:, 0, 0].tolist(), strict=True)
    sides = (zip(x[n, k, b].tolist(), y[n, k, b].tolist(), strict=True) for x, y in ((left_g, left_h), (right_g, right_h)))
    found = zip(gain[n, at].tolist(), features[k].tolist(), b.tolist(), *sides, whole, strict=True)
    return [Split(0.0, -1, 0, every, (0.0, 0.0)) if best <= 1e-9 else Split(best, f, cut, left, right) for best, f, cut, left, right, every in found]


def best_splits(rows: RDD, walk: Walk, frontier: Sequence[int], features: np.ndarray) -> dict[int, Split]:
    """The best split of every node of a level, by one job."""
    parts = rows.getNumPartitions()
    sums = rows.mapPartitions(lambda some: histograms(some, walk, frontier))
    if parts > 1 and parts * len(frontier) <= FEW:
        total: dict[int, np.ndarray] = {}
        for node, some in sums.collect():
            total[node] = total[node] + some if node in total else some
        return {node: best_split(s, features) for node, s in total.items()}
    if parts > 1:  # the sums of one partition have nothing to meet
        sums = sums.reduceByKey(lambda a, b: a + b, min(parts, len(frontier), -(-parts * len(frontier) // FEW)))
    return dict(sums.mapValues(lambda s: best_split(s, features)).collect())


def leaf(eta: float, sums: tuple[float, float]) -> float:
    return -eta * sums[0] / (sums[1] + PENALTY)


def grown(rows: RDD | Ahead, features: np.ndarray, depth: int, eta: float, sample: float, salt: int, weight: float) -> Tree:
    """One more tree; a job for every level that still has nodes to part, or none where a task has grown it ahead."""
    if isinstance(rows, Ahead):
        return rows.tree(salt)
    tree, frontier, at = Tree(), [0], {f: k for k, f in enumerate(features.tolist())}
    some = rows.map(lambda r: sampled(r, features, sample, salt, weight)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for level in range(depth):
            seen = replace(tree, feature=[at.get(f, -1) for f in tree.feature])  # by place among the tree's predictors
            found = best_splits(some, Walk(seen), frontier, features)
            frontier = next_level(tree, frontier, found, eta)
            if not frontier:
                break
    finally:
        some.unpersist()
    return tree


def next_level(tree: Tree, frontier: Sequence[int], found: dict[int, Split], eta: float) -> list[int]:
    """Parts the nodes of a level that have a split, and gives their children. A root without one gets its value."""
    if frontier == [0] and 0 in found and found[0].feature < 0:
        tree.value[0] = leaf(eta, found[0].left)
    return [
        child
        for node in frontier
        if node in found and (s := found[node]).feature >= 0
        for child in tree.grow(node, s.feature, s.bin, (leaf(eta, s.left), leaf(eta, s.right)))
    ]


def cells(bins: np.ndarray, both: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
    """Sums by node, derivative, predictor and bin; every row's node is given."""
    out, start = np.empty((nodes, 2, len(bins), BINS)), node * BINS
    cell = np.empty_like(start)
    for k, line in enumerate(bins):
        np.add(start, line, out=cell)
        for which, values in enumerate(both):
            out[:, which, k] = np.bincount(cell, values, nodes * BINS).reshape(nodes, BINS)
    return out


def grown_alone(r: Rows, features: np.ndarray, depth: int, eta: float, sample: float, salt: int, weight: float) -> Tree:
    """The tree that ``grown`` makes of the same rows, without jobs."""
    seen, tree, frontier = sampled(r, features, sample, salt, weight), Tree(), [0]
    bins, both, place = seen.bins, seen.both, np.zeros(int(features.max()) + 1, np.int64)
    place[features] = np.arange(len(features))
    at, sums = np.zeros(bins.shape[1], np.int64), cells(bins, both, np.zeros(bins.shape[1], np.int64), 1)
    for level in range(depth):
        found = best_of(sums, features)
        parted = [k for k, s in enumerate(found) if s.feature >= 0]
        frontier = next_level(tree, frontier, dict(zip(frontier, found, strict=True)), eta)
        if not frontier or level + 1 == depth:
            return tree
        n = bins.shape[1]
        line, cut, child = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64), np.full(len(found), -1)
        line[parted], cut[parted] = place[[found[k].feature for k in parted]] * n, [found[k].bin for k in parted]
        child[parted] = 2 * np.arange(len(parted))
        if len(parted) < len(found):  # rows of nodes that are done
            use = np.flatnonzero(child[at] >= 0)
            bins, both, at, line = bins.take(use, 1), both.take(use, 1), at[use], line // max(n, 1) * len(use)
        right = bins.reshape(-1)[line[at] + np.arange(len(at))] > cut[at]
        at = child[at] + right
        size = np.bincount(at, minlength=len(frontier))
        small = np.arange(len(parted)) * 2 + (size[1::2] < size[::2])
        of = np.full(len(frontier), -1)
        of[small] = np.arange(len(parted))
        node = of[at]
        use = np.flatnonzero(node >= 0)
        less, every = cells(bins.take(use, 1), both.take(use, 1), node[use], len(parted)), sums[parted]
        sums = np.empty((len(frontier), *less.shape[1:]))
        sums[small], sums[small ^ 1] = less, every - less
    return tree


class Ahead:
    """Rows in one partition, and the trees that its task has grown and that are not yet taken."""

    def __init__(self, rows: RDD):
        self.rows, self.trees = rows, {}

    def grow(self, plans: Sequence[tuple]) -> None:
        """Trees by what ``grown`` is told of them, each on the margins that those before it leave."""

        def ran(some: Iterable[Rows]) -> Iterable[list[dict]]:
            key, bins, y, margin = (np.concatenate(x, -1) for x in zip(*((r.key, r.bins, r.y, r.margin) for r in some), strict=True))
            out = []
            for plan in plans:
                out.append(grown_alone(Rows(key, bins, y, margin), *plan))
                margin = margin + Walk(out[-1]).values(bins)
            yield [vars(t) for t in out]

        found = [t for trees in self.rows.mapPartitions(ran).collect() for t in trees]
        self.trees = {plan[4]: Tree(**t) for plan, t in zip(plans, found, strict=True)}

    def tree(self, salt: int) -> Tree:
        return self.trees.pop(salt)


def mean_losses(rows: RDD, trees: Sequence[Tree]) -> list[float]:
    """Mean logistic loss after each of some more trees."""

    def added(some: Iterable[Rows]) -> Iterable[np.ndarray]:
        out, walks = [0] * (len(trees) + 1), [Walk(t) for t in trees]
        for r in some:
            margin = r.margin
            for k, walk in enumerate(walks):
                margin = margin + walk.values(r.bins)
                out[k] += int(np.rint(np.logaddexp(0, np.where(r.y > 0, -margin, margin)) * LOSS_UNIT).sum())
            out[-1] += len(r.margin)
        yield np.array(out, object)  # whole numbers of any size

    *losses, n = rows.mapPartitions(added).treeReduce(lambda a, b: a + b)
    return [float(loss / LOSS_UNIT / max(n, 1)) for loss in losses]


@dataclass
class Part:
    """Binned rows of a part, and how many there are."""

    rows: int
    packed: RDD


class Margins:
    """Rows under the trees so far. At most ``KEEP`` steps are open, and two generations of rows are held."""

    def __init__(self, rows: RDD):
        self.rows, self.before, self.steps = rows.persist(StorageLevel.MEMORY_AND_DISK), None, 0

    def add(self, *trees: Tree) -> None:
        if self.before is not None:
            self.before.unpersist()
        self.before = self.rows

        def moved(some: Iterable[Rows]) -> Iterable[Rows]:
            walks = [Walk(t) for t in trees]
            for r in some:
                margin = r.margin
                for walk in walks:
                    margin = margin + walk.values(r.bins)
                yield Rows(r.key, r.bins, r.y, margin)

        self.rows = self.rows.mapPartitions(moved).persist(StorageLevel.MEMORY_AND_DISK)
        self.steps += 1
        if self.steps % KEEP == 0:
            self.rows.checkpoint()

    def drop(self) -> None:
        for used in (self.rows, self.before):
            if used is not None:
                used.unpersist()


def part_count(blocks: Blocks | Part, cores: int) -> int:
    """A partition a core, fewer for few rows; where that is over ``MOST_ROWS`` rows each, twice as many, and so on."""
    least = -(-blocks.rows // MOST_ROWS)
    return max(1, min(cores, -(-blocks.rows // PART_ROWS))) if least <= cores else -(-least // cores) * cores


def kept_rounds(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the best loss before the first ``patience`` rounds without a better one; whether that came."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def next_look(losses: Sequence[float], patience: int) -> int:
    """Rounds after which the fit may end at the earliest."""
    return kept_rounds(losses, patience)[0] + patience if losses else patience + 1


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees: adds ``probability`` (vector) and ``prediction`` to rows with features."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    cuts = Param(Params._dummy(), "cuts", "edges of the bins, as JSON", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "trees, as JSON", TypeConverters.toString)

    def __init__(self, cuts: Sequence[np.ndarray] | None = None, trees: Sequence[Tree] | None = None):
        super().__init__()
        self._setDefault(featuresCol="features")
        self.losses: list[float] = []
        if cuts is not None:
            self._set(cuts=json.dumps([c.tolist() for c in cuts]), trees=json.dumps([vars(t) for t in trees]))

    @property
    def getNumTrees(self) -> int:
        return len(self.grown_trees())

    def grown_trees(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault(self.trees))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts = [np.array(c) for c in json.loads(self.getOrDefault(self.cuts))]
        walks = [Walk(t) for t in self.grown_trees()]

        @F.pandas_udf("array<double>")
        def likely(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            bins = binned(np.stack(x.to_numpy()), cuts)
            margin = sum((walk.values(bins) for walk in walks), np.zeros(len(x)))
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            return pd.Series(list(np.stack((1 - p, p), 1)))

        p = dataset.withColumn("_p", likely(vector_to_array(self.getOrDefault(self.featuresCol))))
        best = (F.element_at("_p", 2) >= 0.5).cast("double")
        return p.withColumns({"probability": array_to_vector("_p"), "prediction": best}).drop("_p")


def fit_boosted(
    train: DataFrame,
    val: DataFrame | None,
    predictors: Sequence[str],
    target: str,
    max_depth: int = 8,
    eta: float = 0.1,
    rounds: int = 500,
    subsample: float = 0.8,
    colsample: float = 0.8,
    patience: int = 25,
    positive_weight: float | None = None,
    seed: int = 42,
    key: Column | None = None,
    parts: int | None = None,
) -> BoostedModel:
    """Logistic boosting on a 0/1 target; positives weigh negatives per positive unless told otherwise.

    With ``val`` the fit ends ``patience`` rounds after the lowest validation loss and keeps the rounds up to it;
    ``losses`` of the model has the loss of every round that was made.
    """
    spark = train.sparkSession
    shared_folder(spark)  # margins are checkpointed there
    if positive_weight is None:
        n = train.agg(F.count_if(F.col(target) == 0).alias("zero"), F.count_if(F.col(target) == 1).alias("one")).first()
        positive_weight = n["zero"] / max(n["one"], 1)
    cuts = edges(train, predictors, BINS)

    def binned_part(df: DataFrame, key: Column | None) -> Part:
        return Part(df.where(F.col(target).isNotNull()).count(), binned_rows(df, predictors, target, cuts, BLOCK_ROWS, key))

    def held(part: Part, parts: int | None) -> Margins:
        parts = parts or part_count(part, spark.sparkContext.defaultParallelism)
        return Margins(dealt_evenly(part.packed, parts).map(lambda b: Rows(b.key, b.bins, b.y, np.zeros(len(b.y)))))

    def plan(made: int) -> tuple:
        salt = seed * 1_000_003 + made
        return chosen(len(predictors), colsample, salt), max_depth, eta, subsample, salt, positive_weight

    whole = binned_part(train, key)
    single = parts is None and 0 < whole.rows <= ALONE
    state, seen = held(whole, 1 if single else parts), None if val is None else held(binned_part(val, None), None)
    trees, losses = [], []
    try:
        while len(trees) < rounds:
            sure = range(len(trees), rounds if seen is None else min(rounds, next_look(losses, patience)))
            new, rows = [], state.rows
            if single:
                rows = Ahead(state.rows)
                rows.grow([plan(made) for made in sure])
            for made in sure:
                new.append(grown(rows, *plan(made)))
                if not single:
                    state.add(new[-1])
                    rows = state.rows
            if single:
                state.add(*new)
            trees += new
            if seen is not None:
                losses += mean_losses(seen.rows, new)
                seen.add(*new)
                if kept_rounds(losses, patience)[1]:
                    break
    finally:
        for used in (state, seen):
            if used is not None:
                used.drop()
    model = BoostedModel(cuts, trees[: kept_rounds(losses, patience)[0]] if losses else trees)
    model.losses = losses
    return model
