"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule;
policies are versioned masks over the bits, so a new policy or an ablation never reads a text again.

Defined cases: a null or empty text has no words, fails ``few_words`` and is rejected; null ids are kept as
they are; repeated rows get one ledger row each; an empty table gives an empty ledger. The table's other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from emberline.llm.text import filled, packed_rows, unpacked, words_of

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over the measurements, in whole numbers."""

    name: str
    fails: str


# The place of a rule in this list is its bit; append new rules, never reorder.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule("shouting", "10 * n_upper > 3 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
)
BASE = ("few_words", "repeated_windows")
POLICIES: Mapping[str, Sequence[str]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines", "shouting", "word_length"),
}


def mask_of(rules: Sequence[str]) -> int:
    place = {r.name: k for k, r in enumerate(RULES)}
    return sum(1 << place[name] for name in set(rules))


def neighbours(marks: Column) -> Column:
    """Of a sorted array of (k, i), the entries whose k equals that of an entry beside them."""
    return F.filter(
        marks, lambda x, j: (x["k"] == F.get(marks, j - 1)["k"]) | (x["k"] == F.get(marks, j + 1)["k"])
    )


def covered_words(marks: Column) -> Column:
    """Words covered by three-word windows that are equal to another one; ``marks`` are sorted (window, place)."""
    places = F.array_sort(F.transform(neighbours(marks), lambda x: x["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    total = F.aggregate(
        places,
        start,
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
    )
    return F.coalesce(total["n"], F.lit(0)).cast("long")


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements of its column ``text``; helper columns start with ``_``."""
    whole = filled(text)
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = df.withColumns({"_w": words_of(whole), "_lines": lines})
    n = F.size("_w")
    # Windows are sorted by hash first; only those with an equal hash are compared as texts.
    three = lambda i: (F.get("_w", i - 1), F.get("_w", i), F.get("_w", i + 1))
    hashed = F.transform(
        F.sequence(F.lit(1), n - 2), lambda i: F.struct(F.xxhash64(*three(i)).alias("k"), i.alias("i"))
    )
    sized = first.withColumns(
        {
            "_marks": F.sort_array(F.when(n >= 3, hashed)),
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_upper": F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).cast("long"),
        }
    )
    exact = F.transform(
        neighbours(F.col("_marks")), lambda x: F.struct(F.concat_ws(" ", *three(x["i"])).alias("k"), x["i"].alias("i"))
    )
    marked = sized.withColumn("_same", F.sort_array(exact))
    done = marked.withColumn("n_repeat_words", covered_words(F.col("_same")))
    # Filters on a generated column stay above it; else they would be evaluated inside the lambdas, per window.
    once = done.withColumn("_m", F.explode(F.array(F.struct(*MEASURES))))
    return once.select(*df.columns, "_m.*")


def with_bits(df: DataFrame) -> DataFrame:
    """Adds ``failed_bits``: bit k is set where rule k fails."""
    bit = [F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(RULES)]
    total = bit[0]
    for b in bit[1:]:
        total = total.bitwiseOR(b)
    return df.withColumn("failed_bits", total.cast("long"))


def build_ledger(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, measurements, failed bits. No shuffle."""
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("_text"))
    return with_bits(measured(slim, "_text")).select("doc_id", *MEASURES, "failed_bits")


def passes(policy: str = "v1", bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def apply_policy(ledger: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``."""
    return ledger.withColumns({"base_failed": ~passes("base"), "kept": passes("base") & passes(policy)})


def ablation(ledger: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and what is kept without it.

    Documents are first merged by their masked bits (at most 2^rules rows), the rest works on those.
    """
    mask = mask_of(POLICIES[policy])
    merged = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sums = []
    for k, rule in enumerate(RULES):
        if rule.name in POLICIES[policy]:
            one = F.lit(1 << k)
            sums.append(
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.sum(F.when(F.col("bits").bitwiseAND(one) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                    F.sum(F.when(F.col("bits") == one, F.col("n")).otherwise(0)).alias("n_only"),
                    F.sum(F.when(F.col("bits").bitwiseAND(F.lit(mask & ~(1 << k))) == 0, F.col("n")).otherwise(0)).alias(
                        "n_kept_without"
                    ),
                )
            )
    table = merged.agg(F.array(*sums).alias("rules"))
    return table.select(F.explode("rules").alias("r")).select(
        "r.rule", *[F.coalesce(F.col(f"r.{c}"), F.lit(0)).alias(c) for c in ("n_failed", "n_only", "n_kept_without")]
    )


def keep_good(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with the columns of ``docs``."""
    rows = packed_rows(docs).withColumn("_text", F.col("row.text"))
    judged = with_bits(measured(rows, "_text"))
    return unpacked(judged.where(passes("base") & passes(policy)), docs.columns)
