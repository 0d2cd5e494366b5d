"""Words, characters and row helpers that the operators of this folder share.

White space is the six ASCII characters space, tab, line feed, vertical tab, form feed and carriage
return; a word is a maximal run of other characters. A missing text has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def filled(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text that is not null, in order."""
    return F.array_remove(F.split(text, f"{SPACE_CLASS}+"), "")


def packed_rows(docs: DataFrame, name: str = "row") -> DataFrame:
    """Every row as one struct, so that an operator's own columns cannot clash with the table's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns])
