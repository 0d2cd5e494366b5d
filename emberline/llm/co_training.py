"""Quality by co-training two views of a document.

One classifier sees the text's content only, the other the page's metadata only (language, source, length as
listed). Both start from the labelled rows. In every round each is calibrated, labels the unlabelled rows it is
confident of, and hands them to the other one, whose next fit counts them at half weight. Confident is relative to
what a view can know: its calibrated probability of a class must be at least one half and close ``SURE`` of the gap
between the class's share and certainty, so that a weak view has its say, too. In the end the calibrated views are
combined into one score for every document, none with a negative weight.

Labels are learnt only from rows whose crc32 of the id's text is not 0 modulo ``FOLDS``; at most ``LABELLED`` of
them, and at most ``POOL`` rows without a label, are drawn by hash of the id. Both bounds are parameters. Scoring
takes all rows and whole texts.

Defined cases: nulls of text or metadata have features of their own; rows with a null id are held out; without
labels of both classes every score is 0.5 and every document is kept; of several labels of an id the lowest
counts; repeated rows are scored each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from emberline.llm.pages import STOP_WORDS
from emberline.llm.toxicity import drawn, held_out

LABELLED = 8_000
POOL = 8_000
ROUNDS = 4
# Share of the gap to certainty that a pseudo-label closes, how many of each class at most in a round, their weight.
SURE = 0.5
HANDED = 500
WEIGHT = 0.5
RIDGE = 1.0
BINS = 10
SOURCES, LANGUAGES = 64, 16
SYMBOLS = str.maketrans("", "", "#*$%&|<>")


# ---- views ----------------------------------------------------------------------------------------


def content_features(text: str | None) -> list[float]:
    """Measures of a whole text, each a rate or a logarithm."""
    text = text if isinstance(text, str) else ""
    words = text.split()
    n = max(len(words), 1)
    letters = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(map(str.isupper, text))
    return [
        np.log1p(len(words)),
        letters / n,
        (len(text) - len(text.translate(SYMBOLS))) / n,
        upper / max(letters, 1),
        text.count("!") / n,
        len(set(words)) / n ** 0.8,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(w.lower().strip(".,") in STOP_WORDS for w in words) / n,
        (text.count(".") + text.count(",")) / n,
    ]


def bucket(value: object, n: int) -> int:
    return n if value is None or value != value else zlib.crc32(str(value).encode()) % n


def metadata_features(lang: object, source: object, n_chars: object) -> list[float]:
    size = -1.0 if n_chars is None or n_chars != n_chars else np.log1p(max(float(n_chars), 0.0))
    return [float(bucket(lang, LANGUAGES)), float(bucket(source, SOURCES)), size]


@dataclass
class View:
    """Features cut into bins (``edges``; None takes the number as a bin) under a linear model, then calibrated."""

    edges: list[np.ndarray | None]
    sizes: list[int]
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def places(self, x: np.ndarray) -> np.ndarray:
        """Per row the place of its bin of every feature in ``weights``, whose first entry is the constant."""
        start, out = 1, []
        for k, edges in enumerate(self.edges):
            own = x[:, k].astype(np.int64) if edges is None else np.searchsorted(edges, x[:, k], side="right")
            out.append(start + own)
            start += self.sizes[k]
        return np.stack(out, axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[0] + self.weights[self.places(x)].sum(1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


def empty_view(sample: np.ndarray, kinds: list[int]) -> View:
    """Bins by quantiles of the sample; ``kinds`` is 0 for such a feature, else its number of categories."""
    edges: list[np.ndarray | None] = []
    for k, kind in enumerate(kinds):
        edges.append(None if kind else np.unique(np.quantile(sample[:, k], np.linspace(0, 1, BINS + 1)[1:-1])))
    sizes = [kind or len(e) + 1 for kind, e in zip(kinds, edges, strict=True)]
    return View(edges, sizes, np.zeros(1 + sum(sizes)))


def share(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(design: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is not shrunk."""
    w = np.zeros(design.shape[1])
    shrink = np.full(len(w), ridge)
    shrink[0] = 1e-6
    for _ in range(12):
        p = share(design @ w)
        slope = design.T @ (weight * (p - y)) + shrink * w
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(shrink)
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def one_hot(view: View, x: np.ndarray) -> np.ndarray:
    design = np.zeros((len(x), len(view.weights)))
    design[:, 0] = 1
    np.put_along_axis(design, view.places(x), 1, axis=1)
    return design


def fit_view(view: View, x: np.ndarray, y: np.ndarray, weight: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    fitted = View(view.edges, view.sizes, logistic(one_hot(view, x), y, weight))
    raw = fitted.raw(held_x)
    # Calibration on labelled rows that the fit has not seen.
    shift, slope = logistic(np.stack([np.ones(len(raw)), raw], 1), held_y, np.ones(len(raw)), 1e-3)
    fitted.slope, fitted.shift = max(float(slope), 0.0), float(shift)
    return fitted


# ---- co-training ----------------------------------------------------------------------------------


@dataclass
class CoModel:
    content: View
    metadata: View
    mix: np.ndarray  # constant, content, metadata
    handed: list[tuple[int, int]]  # per round: rows given by content, by metadata

    def combine(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        return share(self.mix[0] + self.mix[1] * content + self.mix[2] * metadata)


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS) -> CoModel | None:
    """``labelled`` and ``pool`` hold the rows of the content view and of the metadata view."""
    check = np.arange(len(y)) % 4 == 0
    if len(set(y[check].tolist())) < 2 or len(set(y[~check].tolist())) < 2:
        return None
    kinds = ([0] * labelled[0].shape[1], [LANGUAGES + 1, SOURCES + 1, 0])
    blank = [empty_view(np.concatenate([labelled[v], pool[v]]), list(kinds[v])) for v in (0, 1)]
    # What a view learns from besides the labels: rows of the pool with the other view's label.
    given: list[dict[int, int]] = [{}, {}]
    handed = []

    def fit(v: int) -> View:
        rows = np.array(sorted(given[v]), np.int64)
        x = np.concatenate([labelled[v][~check], pool[v][rows]])
        target = np.concatenate([y[~check], np.array([given[v][r] for r in rows.tolist()], float)])
        weight = np.concatenate([np.ones((~check).sum()), np.full(len(rows), WEIGHT)])
        return fit_view(blank[v], x, target, weight, labelled[v][check], y[check])

    views = [fit(0), fit(1)]
    for _ in range(rounds):
        counts = []
        for v in (0, 1):
            p = share(views[v].logit(pool[v])) if len(pool[v]) else np.empty(0)
            new = 0
            for label, sure in ((1, p), (0, 1 - p)):
                usual = (y == label).mean()
                enough = max(0.5, usual + SURE * (1 - usual))
                best = [r for r in np.argsort(-sure, kind="stable").tolist() if sure[r] >= enough and r not in given[1 - v]][:HANDED]
                given[1 - v].update(dict.fromkeys(best, label))
                new += len(best)
            counts.append(new)
        handed.append((counts[0], counts[1]))
        views = [fit(0), fit(1)]
        if not any(counts):
            break
    both = np.stack([views[v].logit(labelled[v][check]) for v in (0, 1)], 1)
    return CoModel(views[0], views[1], mixed_views(both, y[check]), handed)


def mixed_views(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Constant and weights of the views' logits, none negative: a view that would get one is left out."""
    out, used = np.zeros(3), [0, 1]
    while True:
        design = np.concatenate((np.ones((len(y), 1)), logits[:, used]), 1)
        w = logistic(design, y, np.ones(len(y)), 1e-2)
        low = int(np.argmin(w[1:])) if used else 0
        if not used or w[1 + low] >= 0:
            out[[0, *[1 + v for v in used]]] = w
            return out
        del used[low]


# ---- operator -------------------------------------------------------------------------------------


def with_views(docs: DataFrame) -> DataFrame:
    content = F.pandas_udf(lambda t: pd.Series([content_features(x) for x in t]), "array<double>")
    metadata = F.pandas_udf(
        lambda a, b, c: pd.Series([metadata_features(*x) for x in zip(a, b, c, strict=True)]), "array<double>"
    )
    return docs.select(
        "doc_id", content("text").alias("content"), metadata("lang", "source", F.col("n_chars").cast("double")).alias("metadata")
    )


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> CoModel | None:
    marks = labels.where(~held_out("doc_id") & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("y"))
    chosen = marks.join(F.broadcast(drawn(marks.select("doc_id"), labelled)), "doc_id")
    others = drawn(docs.where(~held_out("doc_id")).select("doc_id").join(marks, "doc_id", "left_anti"), pool)
    # At most ``labelled`` and ``pool`` ids.
    ids = F.broadcast(chosen.unionByName(others.withColumn("y", F.lit(None).cast("int"))))
    rows = with_views(docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi"))
    # One row per id reaches the driver, however many rows have it.
    one = rows.groupBy("doc_id").agg(F.min(F.struct("content", "metadata")).alias("v")).select("doc_id", "v.*")
    got = one.join(ids, "doc_id").toPandas().sort_values("doc_id")
    if got.empty:
        return None
    stack = lambda part, width: np.array(part.tolist(), float).reshape(-1, width)
    known = got[got["y"].notna()]
    rest = got[got["y"].isna()]
    views = lambda part: [stack(part["content"], 10), stack(part["metadata"], 3)]
    return co_train(views(known), known["y"].to_numpy(float), views(rest))


def score(docs: DataFrame, model: CoModel | None) -> DataFrame:
    """One row per document: doc_id, held_out, content_score, metadata_score, score, predicted, kept."""

    def content(texts: pd.Series) -> pd.Series:
        return pd.Series(model.content.logit(np.array([content_features(t) for t in texts])) if model else np.zeros(len(texts)))

    def metadata(lang: pd.Series, source: pd.Series, size: pd.Series) -> pd.Series:
        x = np.array([metadata_features(*v) for v in zip(lang, source, size, strict=True)])
        return pd.Series(model.metadata.logit(x) if model else np.zeros(len(x)))

    def combined(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(model.combine(a.to_numpy(), b.to_numpy()) if model else np.full(len(a), 0.5))

    a = F.pandas_udf(content, "double")("text")
    b = F.pandas_udf(metadata, "double")("lang", "source", F.col("n_chars").cast("double"))
    seen = docs.select("doc_id", held_out("doc_id").alias("held_out"), a.alias("a"), b.alias("b"))
    scored = seen.withColumn("score", F.pandas_udf(combined, "double")("a", "b"))
    one = lambda z: 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col(z)))))
    return scored.select(
        "doc_id", "held_out", one("a").alias("content_score"), one("b").alias("metadata_score"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"),
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
