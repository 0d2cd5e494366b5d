"""Deterministic pseudo-random numbers that another engine can recompute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

HASH_SPAN = 2**32


def hash32(keys: Sequence[str], seed: int = 42) -> Column:
    """First 32 bits of md5 over the keys and the seed, as a number in [0, 2**32)."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    text = F.concat_ws("|", *parts, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def below(hashed: Column, frac: float) -> Column:
    """True for the given fraction of the hash range."""
    return hashed < F.lit(int(frac * HASH_SPAN))
