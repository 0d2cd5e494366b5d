"""Does a table have the columns, types and value ranges that are expected?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from emberline.schemas import CRITICAL_COLUMNS, TARGET

# The domain of each raw column.
DOMAINS = {
    "latitude": "latitude BETWEEN -90 AND 90",
    "longitude": "longitude BETWEEN -180 AND 180",
    "frp": "frp >= 0 AND NOT isnan(frp)",
    "acq_time": "acq_time BETWEEN 0 AND 2359 AND acq_time % 100 < 60",
    "confidence": "lower(confidence) IN ('l', 'n', 'h', 'low', 'nominal', 'high')",
    "daynight": "daynight IN ('D', 'N')",
}


def column_difference(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row: columns that are missing and columns that are not expected."""
    wanted = F.array(*[F.lit(f.name) for f in expected])
    found = F.array(*[F.lit(c) for c in df.columns])
    return df.sparkSession.range(1).select(
        F.array_except(wanted, found).alias("missing"), F.array_except(found, wanted).alias("extra")
    )


def target_column(df: DataFrame, target: str = TARGET) -> str:
    """The expected target, else the last column."""
    return target if target in df.columns else df.columns[-1]


def _status(expected: T.DataType | None, actual: T.DataType | None) -> str:
    if actual is None:
        return "missing"
    if expected is None:
        return "extra"
    return "ok" if expected == actual else "other_type"


def contract_report(df: DataFrame, expected: T.StructType, domains: dict[str, str] | None = None) -> DataFrame:
    """One row per expected or found column: status, types, and values outside the domain.

    Nulls count as outside. All columns are counted in one pass.
    """
    domains = DOMAINS if domains is None else domains
    wanted = {f.name: f.dataType for f in expected}
    found = {f.name: f.dataType for f in df.schema}
    names = [*wanted, *[c for c in found if c not in wanted]]

    def outside(c: str) -> Column:
        if c not in found or c not in domains:
            return F.lit(None).cast("bigint")
        inside = F.expr(domains[c])
        return F.count_if(~F.coalesce(inside, F.lit(False)))

    counts = df.agg(*[outside(c).alias(c) for c in names])
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(_status(wanted.get(c), found.get(c))).alias("status"),
            F.lit(c in CRITICAL_COLUMNS).alias("critical"),
            F.lit(wanted[c].simpleString() if c in wanted else None).cast("string").alias("expected_type"),
            F.lit(found[c].simpleString() if c in found else None).cast("string").alias("actual_type"),
            F.col(f"`{c}`").alias("outside_domain"),
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*entries)))
