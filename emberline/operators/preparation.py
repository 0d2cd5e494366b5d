"""A fitted scaler as a pipeline stage of its own, saved and loaded with the model behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class Scaler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """z-scores by stored moments, as new columns ``<name><suffix>``; a constant column is centred only."""

    names = Param(Params._dummy(), "names", "scaled columns", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "means", TypeConverters.toListFloat)
    spreads = Param(Params._dummy(), "spreads", "deviations", TypeConverters.toListFloat)
    suffix = Param(Params._dummy(), "suffix", "ending of the new columns' names", TypeConverters.toString)

    def __init__(self, names: Sequence[str] = (), means: Sequence[float] = (), spreads: Sequence[float] = (), suffix: str = "_scaled"):
        super().__init__()
        self._set(names=list(names), means=list(means), spreads=list(spreads), suffix=suffix)

    def outputs(self) -> list[str]:
        return [c + self.getOrDefault(self.suffix) for c in self.getOrDefault(self.names)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        moments = zip(*(self.getOrDefault(p) for p in (self.names, self.means, self.spreads)), strict=True)
        scaled = [(F.col(c).cast("double") - m) / (s if s > 0 else 1.0) for c, m, s in moments]
        return dataset.withColumns(dict(zip(self.outputs(), scaled, strict=True)))


def fit_scaler(train: DataFrame, predictors: Sequence[str]) -> Scaler:
    """Mean and population deviation of every predictor over all of ``train``; one row reaches the driver."""
    means = [F.avg(c).alias(f"m{k}") for k, c in enumerate(predictors)]
    spreads = [F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(predictors)]
    row = train.agg(*means, *spreads).first()
    found = [0.0 if v is None else float(v) for v in row]
    return Scaler(predictors, found[: len(predictors)], found[len(predictors) :])
