"""Training rows as numeric blocks, for learners that run many small jobs over the same rows.

A block holds some rows as one matrix. Which block a row is in depends on a hash of its key alone, so blocks are
the same however files are cut and however many cores there are. Blocks are written to the shared folder and held
in the executors' memory or disks; a lost executor's blocks are read again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from emberline.session import scratch_path

#: Rows of a partition of blocks, on average.
PART_ROWS = 262_144
SCHEMA = "number long, key binary, x binary, y binary"
# Multipliers and shifts of the 64-bit mixing function.
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
STEP = 0x9E3779B97F4A7C15


def drawn(keys: np.ndarray, salt: int, width: int | None = None) -> np.ndarray:
    """Whole numbers below 2^53 that depend on a row's key, the salt and, with ``width``, on the column alone."""
    x = keys.astype(np.uint64) + np.uint64(salt * STEP & 0xFFFFFFFFFFFFFFFF)
    if width is not None:
        x = x[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(MIX[0][1])
    moved = np.empty_like(x)
    for _ in range(2):
        for shift, factor in MIX:
            np.right_shift(x, np.uint64(shift), out=moved)
            x ^= moved
            x *= np.uint64(factor)
    x >>= np.uint64(11)
    return x


def uniform(keys: np.ndarray, salt: int, width: int | None = None) -> np.ndarray:
    """The same as numbers in [0, 1)."""
    return drawn(keys, salt, width).astype(np.float64) / float(1 << 53)


def limit(share: float) -> np.uint64:
    """``drawn`` numbers from here on are those that ``uniform`` gives as ``share`` or more."""
    return np.uint64(math.ceil(share * (1 << 53)))


@dataclass
class Block:
    number: int
    key: np.ndarray
    x: np.ndarray
    y: np.ndarray


@dataclass(frozen=True)
class Blocks:
    """Stored blocks: where they are, how many rows and blocks there are, and the partitions to hold them in."""

    path: str
    rows: int
    blocks: int
    parts: int
    width: int

    def held(self, spark: SparkSession, parts: int | None = None) -> RDD:
        """The blocks, kept by the executors. Unpersist them when done."""
        return self.read(spark, parts).persist(StorageLevel.MEMORY_AND_DISK)

    def lanes(self, spark: SparkSession) -> RDD:
        """The blocks, kept by the executors, with all blocks of a number in one partition. Unpersist them when done."""
        return self.dealt(spark, self.parts).persist(StorageLevel.MEMORY_AND_DISK)

    def dealt(self, spark: SparkSession, parts: int) -> RDD:
        """The blocks in turn to so many partitions, by their numbers."""
        if parts == 1:
            return self.read(spark, 1)
        return self.read(spark).map(lambda b: (b.number, b)).partitionBy(parts, lambda number: number % parts).values()

    def drop(self, spark: SparkSession) -> None:
        """Deletes the stored blocks; nothing may read them any more."""
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, spark: SparkSession, parts: int | None = None) -> RDD:
        width, stored = self.width, spark.read.schema(SCHEMA).parquet(self.path)

        def block(r) -> Block:
            key = np.frombuffer(r.key, np.int64)
            return Block(r.number, key, np.frombuffer(r.x).reshape(len(key), width), np.frombuffer(r.y))

        return stored.rdd.map(block).coalesce(parts or self.parts)


@dataclass
class Binned:
    """Some rows with bins instead of values, a line for every predictor."""

    key: np.ndarray
    bins: np.ndarray
    y: np.ndarray


#: Rows of a quantile sketch's error: one in so many.
SKETCH = 10_000
BINNED = "key binary, bins binary, y binary"


def edges(train: DataFrame, predictors: Sequence[str], bins: int) -> list[np.ndarray]:
    """Distinct values that part the bins of every predictor, by one pass of a quantile sketch."""
    shares = [k / bins for k in range(1, bins)]
    found = train.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, SKETCH).alias(f"q{k}") for k, c in enumerate(predictors)]).first()
    return [np.unique(np.array(q or [], float)) for q in found]


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every value, a line for every predictor: how many edges are not above it."""
    return np.stack([np.searchsorted(c, x[:, k], side="right").astype(np.uint8) for k, c in enumerate(cuts)])


def hashed(rows: DataFrame, predictors: Sequence[str], target: str, key: Column | None) -> DataFrame:
    """Key, predictors (x0, x1, ...) and label (y) of rows; a null or NaN among the predictors is an error.

    ``key`` identifies a row; without it the row's content does.
    """
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    known = lambda c: F.coalesce(value(c), F.raise_error(F.lit(f"{c} has a null or NaN")).cast("double"))
    columns = [known(c).alias(f"x{k}") for k, c in enumerate(predictors)]
    return rows.select(
        (F.xxhash64(*predictors, target) if key is None else key.cast("long")).alias("key"), *columns, F.col(target).cast("double").alias("y")
    )


def binned_rows(
    df: DataFrame, predictors: Sequence[str], target: str, cuts: Sequence[np.ndarray], most: int, key: Column | None = None
) -> RDD:
    """Rows with a label, binned where they are read, at most ``most`` together (``Binned``)."""
    width, names = len(predictors), BINNED.replace(",", "").split()[::2]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def record() -> pa.RecordBatch:
            found = [np.concatenate(c, -1) for c in zip(*held, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in found], names=names)

        for batch in batches:
            for a in range(0, len(batch), most):
                some = batch.slice(a, most)
                if held and sum(len(k) for k, _, _ in held) + len(some) > most:
                    yield record()
                key, *x, y = (c.to_numpy(zero_copy_only=False) for c in some.columns)
                bins = np.stack([np.searchsorted(c, v, side="right").astype(np.uint8) for c, v in zip(cuts, x, strict=True)])
                held.append((key.astype(np.int64), bins, (y > 0).astype(np.int8)))
        if held:
            yield record()

    def rows(r) -> Binned:
        key = np.frombuffer(r.key, np.int64)
        return Binned(key, np.frombuffer(r.bins, np.uint8).reshape(width, len(key)), np.frombuffer(r.y, np.int8))

    return hashed(df.where(F.col(target).isNotNull()), predictors, target, key).mapInArrow(packed, BINNED).rdd.map(rows)


def dealt_evenly(rows: RDD, parts: int) -> RDD:
    """Packed rows in turn to so many partitions."""
    numbered = rows.mapPartitionsWithIndex(lambda k, some: ((k + j, b) for j, b in enumerate(some)))
    return numbered.partitionBy(parts, lambda number: number % parts).values()


def pack_rows(width: int, most: int):
    """Rows (number, key, x..., y) sorted by number, packed; at most ``most`` rows of one number go together."""

    def packed(number: int, table: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
        for a in range(0, len(keys), most):
            some = table[a : a + most]
            yield number, keys[a : a + most].tobytes(), some[:, :width].tobytes(), some[:, width].tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None
        names = SCHEMA.replace(",", "").split()[::2]

        def record(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            if not len(batch):
                continue
            numbers, keys = (batch.column(k).to_numpy() for k in (0, 1))
            table = np.stack([batch.column(k).to_numpy() for k in range(2, width + 3)], 1)
            cuts = np.concatenate(([0], np.nonzero(numbers[1:] != numbers[:-1])[0] + 1, [len(numbers)]))
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and last != numbers[a]:
                    out += packed(last, *(np.concatenate(c) for c in zip(*held, strict=True)))
                    held = []
                last = int(numbers[a])
                held.append((table[a:b], keys[a:b]))
                if sum(len(k) for _, k in held) >= 8 * most:  # equal keys: no block waits for all of them
                    out += packed(last, *(np.concatenate(c) for c in zip(*held, strict=True)))
                    held = []
            if out:
                yield record(out)
        if held:
            yield record(list(packed(last, *(np.concatenate(c) for c in zip(*held, strict=True)))))

    return rows


def store_blocks(
    df: DataFrame,
    predictors: Sequence[str],
    target: str,
    rows_per_block: int,
    key: Column | None = None,
    seed: int = 42,
    part_rows: int = PART_ROWS,
) -> Blocks:
    """Rows with a label as stored blocks of about ``rows_per_block`` rows.

    ``key`` identifies a row; without it the row's content does. A null or NaN among the predictors is an error.
    """
    spark = df.sparkSession
    rows = df.where(F.col(target).isNotNull())
    n = rows.count()
    blocks, parts = max(1, -(-n // rows_per_block)), max(1, -(-n // part_rows))
    named = hashed(rows, predictors, target, key).select(F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(blocks)).cast("long").alias("number"), "*")
    laid = named.repartition(parts, "number").sortWithinPartitions(*named.columns)
    path = scratch_path(spark, "blocks")
    laid.mapInArrow(pack_rows(len(predictors), 2 * rows_per_block), SCHEMA).write.parquet(path)
    return Blocks(path, n, blocks, parts, len(predictors))
