"""Language by hierarchical discrimination: the family first, then pairs of languages within it.

Texts are lower-cased and described by hashed byte 1-, 2- and 3-grams of the whole text, as square roots of their
shares. Languages are put into families by joining, again and again, the two groups whose mean descriptions are
most alike, until about the square root of their number is left. A softmax regression predicts the family. Within
a family every pair of languages has a linear support vector machine of its own (squared hinge loss); the language
with the most won pairs is predicted, ties by summed margins. The score is the family's probability times the
smallest calibrated probability with which the language wins one of its pairs.

The fit sees at most ``FIT_ROWS`` documents, as many of every language as there are, chosen by hash from all
distinct labelled texts; the models are fitted with numpy from those rows. Everything else runs over all rows.

Defined cases: a null text, and one without a letter, gives ``und`` with score 0; a null ``lang`` is never learned
from; a language with a single learned text is a language like others; with one language every text with a letter
gets it; without a learnable row every text gives ``und``. Repeated rows count once in the fit. An empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from emberline.llm.anchors import U, batches_of, mixed
from emberline.llm.spans import record

UNKNOWN = "und"
FOLDS = 3
HELD_OUT = 1
#: Bound of the documents that the fit sees, over all languages.
FIT_ROWS = 4_000
WIDTH = 2_048
STEPS = 300
PENALTY = 1e-4
# Bytes of text described at a time, or one text.
AT_ONCE = 4_000_000


# ---- descriptions ---------------------------------------------------------------------------------


def described(texts: list[str]) -> np.ndarray:
    """texts x WIDTH: square roots of the shares of hashed byte n-grams; grams never cross texts."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    bins = np.arange(3, dtype=np.uint64) + U(1)
    for row, text in zip(out, texts, strict=True):
        data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint64)
        counts = np.zeros(WIDTH)
        gram = np.zeros(len(data), np.uint64)
        for n in range(3):
            gram = (gram[: len(data) - n] << U(8)) | data[n:]
            counts += np.bincount((mixed(gram * U(4) + bins[n]) % U(WIDTH)).astype(np.int64), minlength=WIDTH)
        row[:] = np.sqrt(counts / counts.sum())
    return out


# ---- models ---------------------------------------------------------------------------------------


@dataclass
class Model:
    languages: list[str]
    family: np.ndarray  # of every language
    family_weights: np.ndarray  # WIDTH + 1 x families
    pairs: list[tuple[int, int]]
    pair_weights: np.ndarray  # WIDTH + 1 x pairs
    pair_slope: np.ndarray


def families(means: np.ndarray) -> np.ndarray:
    """Family numbers of languages: the most similar two groups are joined until the square root is left."""
    groups = [[k] for k in range(len(means))]
    unit = means / np.linalg.norm(means, axis=1, keepdims=True)
    alike = unit @ unit.T
    while len(groups) > max(1, round(len(means) ** 0.5)):
        joined = lambda ab: (-alike[np.ix_(groups[ab[0]], groups[ab[1]])].mean(), ab)
        a, b = min(combinations(range(len(groups)), 2), key=joined)
        groups[a] += groups.pop(b)
    out = np.zeros(len(means), np.int64)
    for number, members in enumerate(sorted(map(sorted, groups))):
        out[members] = number
    return out


def descended(gradient, start: np.ndarray, smooth: float) -> np.ndarray:
    """Nesterov's accelerated descent with steps of 1 / smooth."""
    w, ahead = start, start
    for t in range(STEPS):
        new = ahead - gradient(ahead) / smooth
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x, np.ones((len(x), 1), x.dtype)), 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def balanced(y: np.ndarray, kinds: int) -> np.ndarray:
    """Row weights under which every class weighs the same, one in total."""
    counts = np.bincount(y, minlength=kinds)
    return 1 / counts[y] / (counts > 0).sum()


def fit_softmax(x: np.ndarray, y: np.ndarray, kinds: int) -> np.ndarray:
    weight, truth = balanced(y, kinds)[:, None], np.eye(kinds)[y]
    gradient = lambda w: x.T @ (weight * (softmax(x @ w) - truth)) + PENALTY * w
    return descended(gradient, np.zeros((x.shape[1], kinds)), 1.0 + PENALTY)  # rows have length sqrt(2)


def fit_svm(x: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss; ``sign`` is 1 or -1."""
    weight = balanced((sign > 0).astype(np.int64), 2)
    gradient = lambda w: -2 * x.T @ (weight * sign * np.maximum(1 - sign * (x @ w), 0)) + PENALTY * w
    return descended(gradient, np.zeros(x.shape[1]), 4.0 + PENALTY)


def slope(margin: np.ndarray, sign: np.ndarray) -> float:
    """Steepness of the sigmoid that makes probabilities of margins, by Newton's method; held to 1 .. 20."""
    s, weight = 1.0, balanced((sign > 0).astype(np.int64), 2)
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(s * margin * sign, -30, 30)))
        first, second = (weight * margin * sign * (1 - p)).sum() - 1e-3 * s, (weight * margin**2 * p * (1 - p)).sum() + 1e-3
        s = float(np.clip(s + first / second, 1, 20))
    return s


def fit(texts: list[str], langs: list[str]) -> Model:
    names = sorted(set(langs))
    y = np.searchsorted(np.array(names, object), np.array(langs, object))
    x = described(texts).astype(np.float64)
    means = np.stack([x[y == k].mean(0) for k in range(len(names))])
    family = families(means)
    x = with_one(x)
    kinds = int(family.max()) + 1
    pairs = [(a, b) for a, b in combinations(range(len(names)), 2) if family[a] == family[b]]
    machines, slopes = [], []
    for a, b in pairs:
        rows = (y == a) | (y == b)
        sign = np.where(y[rows] == a, 1.0, -1.0)
        machines.append(fit_svm(x[rows], sign))
        slopes.append(slope(x[rows] @ machines[-1], sign))
    weights = np.stack(machines, 1) if machines else np.zeros((x.shape[1], 0))
    return Model(names, family, fit_softmax(x, family[y], kinds), pairs, weights, np.array(slopes))


def predicted(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Language numbers and scores."""
    x = with_one(described(texts).astype(np.float64))
    of_family = softmax(x @ model.family_weights)
    margins = x @ model.pair_weights
    wins, margin, sure = (np.full((len(texts), len(model.languages)), v) for v in (0.0, 0.0, 1.0))
    for k, (a, b) in enumerate(model.pairs):
        m = margins[:, k]
        p = 1 / (1 + np.exp(-np.clip(model.pair_slope[k] * m, -30, 30)))
        for language, s, q in ((a, m, p), (b, -m, 1 - p)):
            wins[:, language] += s > 0
            margin[:, language] += s
            sure[:, language] = np.minimum(sure[:, language], q)
    best_family = of_family.argmax(1)
    inside = model.family[None, :] == best_family[:, None]
    # Most wins; margins decide among equal ones (they are brought below 1).
    best = np.where(inside, wins + 0.5 * np.tanh(margin / 100) + 0.25, -1.0).argmax(1)
    every = np.arange(len(texts))
    return best, np.clip(of_family[every, best_family] * sure[every, best], 0, 1)


# ---- operator -------------------------------------------------------------------------------------


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo FOLDS; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit_rows(docs: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """(lang, text): about most / languages distinct texts of every language, chosen by hash; all of a rare one."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("h"))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    sizes = counts.select("*", F.lit(most).alias("most")).collect()
    if not sizes:
        return hashed.select("lang", "text").limit(0)
    each = max(1, most // len(sizes))
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, 1.2 * each / max(r["n"], 1)))])
    place = (F.col("h") / float(2**64)) + 0.5
    some = hashed.where(place <= share[F.col("lang")])
    one = some.groupBy("lang", "h").agg(F.min("text").alias("text"))
    return one.orderBy("h", "lang").limit(most).select("lang", "text")


def prediction_rows(model: Model | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, letter = batch.column("text").to_pylist(), batch.column("letter").to_pylist()
            some = [k for k, yes in enumerate(letter) if yes and model is not None]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for a, b in batches_of([len(texts[k]) + WIDTH for k in some], AT_ONCE):
                best, score = predicted(model, [texts[k] for k in some[a:b]])
                for k, language, s in zip(some[a:b], best.tolist(), score.tolist(), strict=True):
                    names[k], scores[k] = model.languages[language], s
            yield record(doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), lang_pred=names, score=scores)

    return rows


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = fit_rows(docs).collect()
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows]) if rows else None
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    table = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text", letter.alias("letter"))
    return table.mapInArrow(prediction_rows(model), "doc_id long, held_out boolean, lang_pred string, score double")
