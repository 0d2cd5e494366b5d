"""A network for tables, trained by synchronous mini-batch steps over blocks of rows.

Layers are linear, batch-normalised where asked for, rectified and thinned by dropout; the loss is cross entropy;
weights move by Adam. A step takes the blocks that a hash of block, epoch and seed deals to it. Batch moments are
those of a block (small "ghost" batches), so they need no exchange within a step and do not depend on partitions.
Dropout is drawn from the row's key, the epoch and the unit.

Rows are dealt to lanes by their block, one lane for every ``PART_ROWS`` rows. A lane makes its share of all steps of an
epoch within one task, from the state that all lanes begin with, and the states that the lanes end with are averaged by
rows in a tree: an epoch is one job, and a vector of the size of the weights reaches the driver. With one lane that is
plain mini-batch descent; with L lanes a step of ``batch`` rows takes an L-th of them in every lane, one block at least.
Lanes follow from the number of rows, so a fit does not depend on cores or files, up to the rounding of sums. Where a
number of partitions is asked for, every step is a job of its own instead: tasks add up the gradients of their blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from emberline.operators.blocks import Block, drawn, limit, store_blocks, uniform

# Hidden units, dropout of the normalised layers, learning rate, epochs, rows of a step.
HIDDEN = (128, 64, 32)
DROPPED = (0.3, 0.2)
LEARNING_RATE = 1e-3
EPOCHS = 8
BATCH = 8192
# Adam's decay rates and guard, the guard and the memory of batch normalisation.
DECAY = (0.9, 0.999)
TINY = 1e-8
NORM_TINY = 1e-5
NORM_RATE = 0.1
#: Rows of a block, over which batch moments are taken.
GHOST = 256


@dataclass(frozen=True)
class Shape:
    """Widths from input to output, and for every hidden layer whether it is normalised and its dropout."""

    widths: tuple[int, ...]
    normed: tuple[bool, ...]
    dropped: tuple[float, ...]

    def pieces(self) -> list[tuple[str, tuple[int, ...]]]:
        """Names and shapes of the trained values, in the order they lie in the weight vector."""
        out = []
        for k, (a, b) in enumerate(zip(self.widths, self.widths[1:], strict=False)):
            out += [(f"w{k}", (a, b)), (f"b{k}", (b,))]
            if k < len(self.normed) and self.normed[k]:
                out += [(f"scale{k}", (b,)), (f"shift{k}", (b,))]
        return out

    def moments(self) -> list[tuple[str, tuple[int, ...]]]:
        """Names and shapes of the running moments."""
        return [(f"{m}{k}", (self.widths[k + 1],)) for k, yes in enumerate(self.normed) if yes for m in ("mean", "var")]


def views(values: np.ndarray, pieces: list[tuple[str, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in pieces:
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape)
        at += size
    return out


def total(pieces: list[tuple[str, tuple[int, ...]]]) -> int:
    return sum(int(np.prod(shape)) for _, shape in pieces)


def initial(shape: Shape, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights drawn within one over the root of a layer's inputs, scales of one; moments of zero and one."""
    draw = np.random.default_rng(seed)
    weights, moments = np.zeros(total(shape.pieces())), np.zeros(total(shape.moments()))
    named = views(weights, shape.pieces())
    for k, inputs in enumerate(shape.widths[:-1]):
        for name in (f"w{k}", f"b{k}"):
            named[name][...] = draw.uniform(-1, 1, named[name].shape) / np.sqrt(inputs)
        if f"scale{k}" in named:
            named[f"scale{k}"][...] = 1.0
    for name, values in views(moments, shape.moments()).items():
        values[...] = name.startswith("var")
    return weights, moments


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def probabilities(shape: Shape, weights: np.ndarray, moments: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Class probabilities, with running moments and without dropout."""
    w, m = views(weights, shape.pieces()), views(moments, shape.moments())
    for k in range(len(shape.widths) - 1):
        x = x @ w[f"w{k}"] + w[f"b{k}"]
        if k < len(shape.normed):
            if shape.normed[k]:
                x = (x - m[f"mean{k}"]) / np.sqrt(m[f"var{k}"] + NORM_TINY) * w[f"scale{k}"] + w[f"shift{k}"]
            x = np.maximum(x, 0)
    return np.exp(log_softmax(x))


@dataclass
class Sums:
    """What blocks add up to: gradient of the summed loss, loss, right rows, rows, moments weighted by rows."""

    gradient: np.ndarray
    loss: float
    right: float
    rows: float
    moments: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        return Sums(
            self.gradient + other.gradient, self.loss + other.loss, self.right + other.right, self.rows + other.rows,
            self.moments + other.moments,
        )


def block_sums(shape: Shape, weights: np.ndarray, block: Block, salt: int) -> Sums:
    """Forward and backward through one block, with its own moments and with dropout."""
    w, n, y = views(weights, shape.pieces()), len(block.y), block.y.astype(np.int64)
    gradient, moments = np.zeros_like(weights), np.zeros(total(shape.moments()))
    g, seen = views(gradient, shape.pieces()), views(moments, shape.moments())
    hidden, a, kept = len(shape.normed), block.x, []
    for k in range(hidden):
        # Matrices are changed in place where nothing else needs them.
        z = a @ w[f"w{k}"]
        z += w[f"b{k}"]
        spread = unit = None
        if shape.normed[k]:
            mean = z.mean(0)
            z -= mean
            var = (z * z).mean(0)
            seen[f"mean{k}"][...], seen[f"var{k}"][...] = n * mean, n * var * n / max(n - 1, 1)
            spread = np.sqrt(var + NORM_TINY)
            z /= spread
            unit = z
            z = unit * w[f"scale{k}"]
            z += w[f"shift{k}"]
        open_units = z > 0
        if shape.dropped[k]:
            open_units &= drawn(block.key, salt * hidden + k, z.shape[1]) >= limit(shape.dropped[k])
        through = open_units * (1 / (1 - shape.dropped[k]))
        z *= through
        kept.append((a, unit, spread, through))
        a = z
    scores = log_softmax(a @ w[f"w{hidden}"] + w[f"b{hidden}"])
    loss, right = -scores[np.arange(n), y].sum(), (scores.argmax(1) == y).sum()
    back = np.exp(scores)
    back[np.arange(n), y] -= 1
    for k in range(hidden, -1, -1):
        if k < hidden:
            a, unit, spread, through = kept[k]
            back *= through
            if shape.normed[k]:
                both = back * unit
                g[f"scale{k}"][...], g[f"shift{k}"][...] = both.sum(0), back.sum(0)
                back *= w[f"scale{k}"]
                np.multiply(back, unit, out=both)
                np.multiply(unit, both.mean(0), out=both)
                back -= back.mean(0)
                back -= both
                back /= spread
        g[f"w{k}"][...], g[f"b{k}"][...] = a.T @ back, back.sum(0)
        if k:
            back = back @ w[f"w{k}"].T
    return Sums(gradient, float(loss), float(right), float(n), moments)


# ---- jobs over blocks -------------------------------------------------------------------------------


def step_sums(blocks: RDD, shape: Shape, weights: np.ndarray, salt: int, steps: int, step: int) -> Sums | None:
    """Summed over the blocks that are dealt to a step of an epoch (``salt`` tells epochs and fits apart)."""

    def added(some: Iterable[Block]) -> Iterable[Sums | None]:
        out = None
        for block in some:
            if int(uniform(np.array([block.number]), salt)[0] * steps) == step:
                found = block_sums(shape, weights, block, salt)
                out = found if out is None else out + found
        yield out

    return blocks.mapPartitions(added).treeReduce(lambda a, b: b if a is None else a if b is None else a + b)


def judged(blocks: RDD, shape: Shape, weights: np.ndarray, moments: np.ndarray) -> tuple[float, float]:
    """Mean loss and share of right rows."""

    def added(some: Iterable[Block]) -> Iterable[np.ndarray]:
        out = np.zeros(3)
        for block in some:
            p, y = probabilities(shape, weights, moments, block.x), block.y.astype(np.int64)
            likely = np.maximum(p[np.arange(len(y)), y], 1e-300)
            out += (-np.log(likely).sum(), (p.argmax(1) == y).sum(), len(y))
        yield out

    loss, right, rows = blocks.mapPartitions(added).treeReduce(lambda a, b: a + b)
    return loss / max(rows, 1), right / max(rows, 1)


@dataclass
class Epoch:
    """Losses, accuracies, and the state after an epoch."""

    train_loss: float
    train_acc: float
    val_loss: float | None
    val_acc: float | None
    weights: np.ndarray = field(repr=False)
    moments: np.ndarray = field(repr=False)


class Adam:
    def __init__(self, size: int, rate: float):
        self.rate, self.t, self.first, self.second = rate, 0, np.zeros(size), np.zeros(size)

    def moved(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.first = DECAY[0] * self.first + (1 - DECAY[0]) * gradient
        self.second = DECAY[1] * self.second + (1 - DECAY[1]) * gradient**2
        first, second = self.first / (1 - DECAY[0] ** self.t), self.second / (1 - DECAY[1] ** self.t)
        return weights - self.rate * first / (np.sqrt(second) + TINY)


@dataclass
class State:
    """What a fit carries from step to step, and what was met on the way in this epoch."""

    weights: np.ndarray
    moments: np.ndarray
    adam: Adam
    loss: float = 0.0
    right: float = 0.0
    met: float = 0.0

    def step(self, s: Sums) -> None:
        self.weights = self.adam.moved(self.weights, s.gradient / s.rows)
        self.moments = (1 - NORM_RATE) * self.moments + NORM_RATE * s.moments / s.rows
        self.loss, self.right, self.met = self.loss + s.loss, self.right + s.right, self.met + s.rows

    def __add__(self, other: State) -> State:
        """Both as one, by the rows that each has met."""
        met = self.met + other.met
        a, b = self.met / met, other.met / met
        adam = Adam(0, self.adam.rate)
        adam.t = max(self.adam.t, other.adam.t)
        adam.first, adam.second = a * self.adam.first + b * other.adam.first, a * self.adam.second + b * other.adam.second
        weights, moments = a * self.weights + b * other.weights, a * self.moments + b * other.moments
        return State(weights, moments, adam, self.loss + other.loss, self.right + other.right, met)


def lane_steps(blocks: Sequence[Block], shape: Shape, state: State, salt: int, steps: int) -> State | None:
    """The steps of an epoch over the blocks of one lane; nothing if it has none."""
    if not blocks:
        return None
    dealt: dict[int, list[Block]] = {}
    for block, at in zip(blocks, (uniform(np.array([b.number for b in blocks]), salt) * steps).astype(int).tolist(), strict=True):
        dealt.setdefault(at, []).append(block)
    for step in sorted(dealt):
        out = None
        for block in dealt[step]:
            found = block_sums(shape, state.weights, block, salt)
            out = found if out is None else out + found
        state.step(out)
    return state


def lanes_epoch(lanes: RDD, shape: Shape, state: State, salt: int, steps: int) -> State:
    """An epoch as one job, every partition being a lane."""
    several = lanes.getNumPartitions() > 1

    def ran(some: Iterable[Block]) -> Iterable[State | None]:
        blocks = list(some)
        if several:  # a shuffle brings them in any order
            blocks.sort(key=lambda b: (b.number, b.key.tobytes()))
        yield lane_steps(blocks, shape, state, salt, steps)

    return lanes.mapPartitions(ran).treeReduce(lambda a, b: b if a is None else a if b is None else a + b) or state


def steps_epoch(train: RDD, shape: Shape, state: State, salt: int, steps: int) -> State:
    """An epoch with a job for every step."""
    for step in range(steps):
        s = step_sums(train, shape, state.weights, salt, steps, step)
        if s is not None:
            state.step(s)
    return state


def run_epochs(
    train: RDD,
    val: RDD | None,
    rows: int,
    shape: Shape,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = LEARNING_RATE,
    seed: int = 42,
    lanes: bool = False,
) -> list[Epoch]:
    """All epochs of a fit; with ``lanes`` the partitions are lanes. Losses of the training part are those met on the way."""
    weights, moments = initial(shape, seed)
    state, steps, history = State(weights, moments, Adam(len(weights), rate)), max(1, round(rows / batch)), []
    for epoch in range(epochs):
        state.loss = state.right = state.met = 0.0
        state = (lanes_epoch if lanes else steps_epoch)(train, shape, state, seed * 1_000_003 + epoch, steps)
        seen = judged(val, shape, state.weights, state.moments) if val is not None else (None, None)
        history.append(Epoch(state.loss / max(state.met, 1), state.right / max(state.met, 1), *seen, state.weights, state.moments))
    return history


# ---- the model ----------------------------------------------------------------------------------------


class NetworkModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A trained network: adds ``probability`` (vector) and ``prediction`` (likeliest class) to rows with features."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    widths = Param(Params._dummy(), "widths", "units from input to output", TypeConverters.toListInt)
    normed = Param(Params._dummy(), "normed", "1 for normalised hidden layers", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "trained values", TypeConverters.toListFloat)
    moments = Param(Params._dummy(), "moments", "running moments", TypeConverters.toListFloat)

    def __init__(self, shape: Shape | None = None, weights: np.ndarray | None = None, moments: np.ndarray | None = None):
        super().__init__()
        self._setDefault(featuresCol="features")
        self.history: list[Epoch] = []
        if shape is not None:
            self._set(
                widths=list(shape.widths), normed=[int(k) for k in shape.normed],
                weights=np.asarray(weights).tolist(), moments=np.asarray(moments).tolist(),
            )

    def shape(self) -> Shape:
        normed = tuple(bool(k) for k in self.getOrDefault(self.normed))
        return Shape(tuple(self.getOrDefault(self.widths)), normed, (0.0,) * len(normed))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shape = self.shape()
        weights, moments = (np.array(self.getOrDefault(p)) for p in (self.weights, self.moments))

        @F.pandas_udf("array<double>")
        def likely(x: pd.Series) -> pd.Series:
            table = np.stack(x.to_numpy()) if len(x) else np.zeros((0, shape.widths[0]))
            return pd.Series(list(probabilities(shape, weights, moments, table)))

        p = dataset.withColumn("_p", likely(vector_to_array(self.getOrDefault(self.featuresCol))))
        best = F.array_position("_p", F.array_max("_p")).cast("double") - 1
        return p.withColumns({"probability": array_to_vector("_p"), "prediction": best}).drop("_p")


def fit_network(
    train: DataFrame,
    val: DataFrame | None,
    predictors: Sequence[str],
    target: str,
    hidden: Sequence[int] = HIDDEN,
    normed: Sequence[bool] | None = None,
    dropped: Sequence[float] | None = None,
    classes: int = 2,
    epochs: int = EPOCHS,
    batch_size: int = BATCH,
    lr: float = LEARNING_RATE,
    seed: int = 42,
    keep_best: bool = True,
    key: Column | None = None,
    parts: int | None = None,
) -> NetworkModel:
    """Train on scaled rows; ``history`` of the model has every epoch.

    Unless told otherwise the last hidden layer is neither normalised nor thinned, the ones before it are.
    With ``val`` the state of the epoch with the lowest validation loss is kept (the first of equal ones), unless
    ``keep_best`` is off; without it the last.
    """
    spark = train.sparkSession
    inner = max(len(hidden) - 1, 0)
    normed = [k < inner for k in range(len(hidden))] if normed is None else normed
    dropped = [DROPPED[min(k, 1)] if k < inner else 0.0 for k in range(len(hidden))] if dropped is None else dropped
    shape = Shape((len(predictors), *hidden, classes), tuple(normed), tuple(dropped))
    rows = store_blocks(train, predictors, target, min(GHOST, batch_size), key, seed)
    blocks = rows.lanes(spark) if parts is None else rows.held(spark, parts)
    val_rows = None if val is None else store_blocks(val, predictors, target, BATCH, None, seed)
    held = None if val_rows is None else val_rows.held(spark)
    try:
        history = run_epochs(blocks, held, rows.rows, shape, epochs, batch_size, lr, seed, lanes=parts is None)
    finally:
        for used in (blocks, held):
            if used is not None:
                used.unpersist()
        for stored in (rows, val_rows):
            if stored is not None:
                stored.drop(spark)
    best = min(history, key=lambda e: e.val_loss) if val is not None and keep_best else history[-1]
    model = NetworkModel(shape, best.weights, best.moments)
    model.history = history
    return model


def history_rows(model: NetworkModel) -> list[tuple]:
    """(epoch, train_loss, val_loss, train_acc, val_acc)"""
    number = lambda v: None if v is None else float(v)
    return [(k, *map(number, (e.train_loss, e.val_loss, e.train_acc, e.val_acc))) for k, e in enumerate(model.history, 1)]
