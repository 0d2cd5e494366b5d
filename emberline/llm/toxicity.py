"""Toxicity by non-negative positive-unlabelled learning.

The learner sees documents confirmed as toxic and unlabelled ones, never a confirmed harmless one. Its risk is
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: the harmless part of the unlabelled risk is corrected by
the class prior, and where the correction turns it negative the step goes against overfitting instead. The
model is linear over the presence of hashed lower-case words that the confirmed rows hold clearly more often than
the unlabelled ones; only the text is an input of a score.

Training rows are those whose crc32 of the id's text is not 0 modulo ``FOLDS``. At most ``POSITIVES`` confirmed
and ``UNLABELLED`` unlabelled rows are drawn, by hash of the id; both bounds are parameters. The prior is the
share of toxic rows among the labelled training rows. Everything else, above all the scoring, takes all rows
and whole texts.

Defined cases: null and empty texts have no words and get the model's bias; rows with a null id are held out;
without any toxic training row every score is 0; labels for unknown ids are ignored, of several labels of an id
the highest counts; repeated rows are scored each. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5
POSITIVES = 4_000
UNLABELLED = 12_000
WIDTH = 1 << 20
SEED = 7
# A word is a feature if the confirmed rows hold it so many times as often as the unlabelled ones, by so many
# standard errors.
LIFT = 2.0
ERRORS = 5.0
STEPS = 3000
RATE = 0.05
SHRINK = 1e-3

LETTERS = re.compile(r"[^\W\d_]+")


def word_places(text: str | None) -> np.ndarray:
    """Sorted places of the distinct words of a whole text among WIDTH."""
    if not isinstance(text, str):
        return np.empty(0, np.int32)
    return np.unique(
        np.array([zlib.crc32(w.encode()) % WIDTH for w in set(LETTERS.findall(text.lower()))], np.int32)
    )


@dataclass
class Model:
    places: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, z: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(z + self.bias, -30.0, 30.0)))


def sums(weights: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(d) for d in docs])
    edges = np.concatenate(([0], np.cumsum(sizes)))
    running = np.concatenate(([0.0], np.cumsum(weights[np.concatenate([*docs, np.empty(0, np.int64)]).astype(np.int64)])))
    return running[edges[1:]] - running[edges[:-1]]


def telling_places(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Places that are clearly more frequent among confirmed documents than among unlabelled ones."""
    in_p, in_u = (np.bincount(np.concatenate(d), minlength=WIDTH) / len(d) for d in (positive, unlabelled))
    both = (in_p * len(positive) + in_u * len(unlabelled)) / (len(positive) + len(unlabelled))
    error = np.sqrt(both * (1 - both) * (1 / len(positive) + 1 / len(unlabelled)))
    return np.nonzero((in_p >= LIFT * in_u) & (in_p - in_u > ERRORS * np.maximum(error, 1e-12)))[0]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = SEED) -> Model:
    """Non-negative risk with the sigmoid loss, full gradients, Adam steps; deterministic."""
    if not positive or not unlabelled or prior <= 0:
        return Model(np.empty(0, np.int64), np.empty(0), -30.0)
    prior = min(prior, 1 - 1e-6)
    places = telling_places(positive, unlabelled)
    at = np.full(WIDTH, -1, np.int64)
    at[places] = np.arange(len(places))

    def inner(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        cols = [at[d][at[d] >= 0] for d in docs]
        rows = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
        return rows, np.concatenate(cols)

    p_rows, p_cols = inner(positive)
    u_rows, u_cols = inner(unlabelled)
    n_p, n_u, k = len(positive), len(unlabelled), len(places)
    w, b = np.zeros(k), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        z_p = np.bincount(p_rows, w[p_cols], n_p) + b
        z_u = np.bincount(u_rows, w[u_cols], n_u) + b
        s_p, s_u = (1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (z_p, z_u))
        # The loss of a wrong sign is sigmoid(-sign * z); its slope is the same bell for either sign.
        bell_p, bell_u = s_p * (1 - s_p), s_u * (1 - s_u)
        negative = s_u.mean() - prior * s_p.mean()
        if negative >= 0:
            g_p, g_u = -prior * bell_p / n_p - prior * bell_p / n_p, bell_u / n_u
        else:
            g_p, g_u = prior * bell_p / n_p, -bell_u / n_u
        grad = np.bincount(p_cols, g_p[p_rows], k) + np.bincount(u_cols, g_u[u_rows], k) + SHRINK * w / max(k, 1)
        grad = np.append(grad, g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(places, w, float(b))


def held_out(id_column: str) -> Column:
    fold = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == 0, F.lit(True))


def drawn(ids: DataFrame, n: int) -> DataFrame:
    """At most ``n`` distinct ids, by hash. A limit on the hash leaves about twice as many to be ordered, at any size."""
    place = F.xxhash64("doc_id", F.lit(SEED))
    share = 2 * n / max(ids.count(), 1)
    some = ids.where(place / float(2**64) + 0.5 <= share) if share < 1 else ids
    return some.distinct().orderBy(place, "doc_id").limit(n)


def sampled_places(docs: DataFrame, ids: DataFrame) -> list[np.ndarray]:
    """Word places of the documents with these ids; at most as many ids as the sample's bound."""
    places = F.pandas_udf(lambda t: pd.Series([word_places(x).astype("<i4").tobytes() for x in t]), "binary")
    rows = docs.join(F.broadcast(ids), "doc_id").select("doc_id", places("text").alias("p"))
    # One row per id reaches the driver, however many rows have it.
    one = rows.groupBy("doc_id").agg(F.min("p").alias("p")).toPandas().sort_values("doc_id")
    return [np.frombuffer(p, "<i4") for p in one["p"]]


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    learn = labels.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = learn.agg(F.avg("toxic")).head()[0] or 0.0
    confirmed = drawn(learn.where("toxic = 1").select("doc_id"), positives)
    others = drawn(docs.where(~held_out("doc_id")).select("doc_id"), unlabelled)
    texts = docs.select("doc_id", "text")
    return train(sampled_places(texts, confirmed), sampled_places(texts, others), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def batch(texts: pd.Series) -> pd.Series:
        table = np.zeros(WIDTH)
        table[model.places] = model.weights
        return pd.Series(model.score(sums(table, [word_places(t) for t in texts])))

    rated = F.pandas_udf(batch, "double")("text")
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), rated.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
