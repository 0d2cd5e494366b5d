"""Mixing sources to target weights by subset sums.

Size of a document: its words. Every source gets a share of all words by weight, at most ``MOST_TIMES`` its
own words. A source repeats all its documents as often as fits whole; the rest of its budget is a subset
sum over its histogram of lengths: an even share of every length first, fractions rounded in a seeded order of
the lengths so that they cancel out, and the last words by bounded-knapsack dynamic programming over what
is left of each length, in that order too. So small and large sources are sampled alike. Which documents of a length
are taken is a seeded choice by hash.

Per source the programme sees the histogram only: as many rows as there are lengths, however many
documents. Rows are spread by (source, length, hash cell), so no source or length meets in one task.

Defined cases: a null text has size 0 and an empty one too; size 0 is taken as often as its length says,
which is no words; a null source is a source of its own, last in order; documents that share id, text and
source are distinct rows in any order; an empty table, or one without words, takes nothing. The table's
other columns are carried only by :func:`mixture`, packed into one struct.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from emberline.llm.ranking import with_place
from emberline.llm.text import WORD, filled, packed_rows, unpacked
from emberline.session import cut_lineage

WEIGHTS = (1.0, 2.0, 3.0)
MOST_TIMES = 3
SEED = 8


def fitted_targets(sizes: list[float], weights: list[float], most: int = MOST_TIMES) -> list[float]:
    """Shares of the total by weight, stopped at ``most`` times a size; the excess is shared anew by weight."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    open_ones = [k for k in range(len(sizes)) if sizes[k] > 0]
    left = total
    while open_ones:
        scale = left / sum(weights[k] for k in open_ones)
        full = [k for k in open_ones if weights[k] * scale > most * sizes[k]]
        for k in full or open_ones:
            targets[k] = float(most * sizes[k]) if full else weights[k] * scale
        left -= sum(targets[k] for k in full)
        open_ones = [k for k in open_ones if k not in full] if full else []
    return targets


def source_budgets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target): one row per source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))

    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [None if pd.isna(s) else s for s in pdf["source"]]
        order = sorted(range(len(names)), key=lambda k: (names[k] is None, names[k] or ""))
        pdf = pdf.iloc[order].reset_index(drop=True)
        weights = [WEIGHTS[k % len(WEIGHTS)] for k in range(len(pdf))]
        return pdf.assign(target=fitted_targets(pdf["source_size"].tolist(), weights))

    # One row per source meets here, no documents.
    return sums.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda pdf: share(pdf[["source", "source_size"]]), "source string, source_size long, target double"
    )


def last_words(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """How many to take of each length (at most ``left``) so that their sum comes nearest to ``budget``.

    Bounded knapsack, length by length in the given order, over sums up to one longest length above the budget; it
    ends with the length that reaches the budget. Of two sums equally near the lower one. A bit per sum and length is
    kept, by which the way back is found.
    """
    take = np.zeros(len(lengths), np.int64)
    usable = np.nonzero((lengths > 0) & (left > 0))[0]
    if not len(usable) or budget <= 0:
        return take
    top = budget + int(lengths[usable].max())
    reached, far = np.zeros(top + 1, bool), 0
    reached[0] = True
    steps: list[tuple[int, np.ndarray]] = []
    for i in usable:
        if reached[budget]:
            break
        length, copies = int(lengths[i]), np.full(top + 1, -1, np.int32)
        copies[reached] = 0
        far = min(top, far + length * int(left[i]))
        for s in range(length, far + 1, length):  # all residues of the length at once
            here = copies[s : s + length]
            before = copies[s - length : s][: len(here)]
            grow = (here < 0) & (before >= 0) & (before < left[i])
            here[grow] = before[grow] + 1
        steps.append((int(i), np.packbits(reached)))
        reached = copies >= 0
    sums = np.nonzero(reached)[0]
    s = int(sums[np.argmin(np.abs(sums - budget))])
    for i, before in reversed(steps):
        while not before[s >> 3] >> (7 - (s & 7)) & 1:
            take[i] += 1
            s -= int(lengths[i])
    return take


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget``."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    if 2 * budget > total:  # what is left out is the smaller sum
        return counts - fill_budget(lengths, counts, total - budget, seed)
    order = np.argsort([zlib.crc32(f"{seed}:{n}".encode()) for n in lengths.tolist()], kind="stable")
    # An even share of every length in whole numbers, but for about two documents that are left to be fitted; what
    # rounding leaves over of a document goes on to the next length.
    shared = max(0, budget - 2 * total // int(counts.sum()))
    taken, carried = np.zeros(len(lengths), np.int64), total // 2  # in parts of ``total``
    for i in order.tolist():
        carried += int(counts[i]) * shared
        taken[i] = min(int(counts[i]), carried // total)
        carried -= int(taken[i]) * total
    rest = budget - int((lengths * taken).sum())
    # Documents go back, in that order, until something is left to fit.
    for i in order.tolist():
        if rest > 0:
            break
        if lengths[i] and taken[i]:
            back = min(int(taken[i]), -rest // int(lengths[i]) + 1)
            taken[i] -= back
            rest += back * int(lengths[i])
    more = np.zeros(len(lengths), np.int64)
    more[order] = last_words(lengths[order], (counts - taken)[order], rest)
    return taken + more


def length_plan(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, size, source_size, target, times, extra): repeats of all documents, and how many get one more."""
    histogram = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    b = budgets.withColumnRenamed("source", "_source")
    joined = histogram.join(b, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size").reset_index(drop=True)
        words, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        times = min(int(target // words), MOST_TIMES) if words else 0
        extra = fill_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), round(target - times * words) if words else 0)
        return pdf.assign(times=times, extra=extra if times < MOST_TIMES else 0).drop(columns="n")

    schema = "source string, size long, source_size long, target double, times long, extra long"
    # The histogram of one source: one row per length.
    return joined.groupBy("source").applyInPandas(plan, schema)


def with_size(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("size", F.regexp_count(filled(text), F.lit(WORD)).cast("long"))


def choose(sized: DataFrame, order: list[str], seed: int = SEED) -> DataFrame:
    """Rows with source and size, and source_size, target and ``times``, how often a row is taken."""
    plan = length_plan(sized, source_budgets(sized)).select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target", "times", "extra"
    )
    placed = with_place(sized, ["source", "size"], [F.col(c) for c in order], seed)
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    more = F.when(F.col("place") < F.col("extra"), 1).otherwise(0)
    return joined.withColumn("times", F.col("times") + more).drop("_source", "_size", "place", "extra")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized = cut_lineage(with_size(docs.select("doc_id", "source", "text")).drop("text"))
    return choose(sized, ["doc_id"], seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``; a document taken twice is there twice."""
    rows = packed_rows(docs)
    key = [F.col("row.doc_id"), F.col("row.source"), F.col("row.text")]
    keyed = rows.select(
        "row", F.xxhash64(F.lit(1), *key).alias("a"), F.xxhash64(F.lit(2), *key).alias("b"), *key[:2],
        F.col("row.text").alias("text"),
    )
    slim = cut_lineage(with_size(keyed.select("a", "b", "doc_id", "source", "text")).drop("text"))
    # Equal rows are told apart by a number, so that each gets its own decision.
    nth = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.lit(0)))
    chosen = choose(slim, ["doc_id", "a", "b"], seed).withColumn("nth", F.row_number().over(
        Window.partitionBy("a", "b").orderBy("times")
    )).where("times > 0").select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("nth").alias("_nth"), "times")
    joined = keyed.select("row", "a", "b", nth.alias("nth")).join(
        chosen, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & (F.col("nth") == F.col("_nth"))
    )
    return unpacked(joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))), docs.columns)
