"""SimHash near duplicates with bit-sliced comparison.

A fingerprint has a bit for every position that is set in over half of the document's shingle hashes.
Fingerprints at ``RADIUS`` or fewer differing bits are linked, and links are closed transitively.

Equal fingerprints are merged first, so copies of a text are one node. The bits are cut into ``PIECES``
pieces; two fingerprints within the radius agree in at least PIECES - RADIUS of them, so every pair meets
in the bucket of some choice of agreeing pieces (15 choices of two pieces, about 21 bits). Buckets of one
are dropped. Within a bucket the fingerprints are stored as bit planes, 64 of them to a word; a comparison
runs over the planes and adds the differing bits into vertical carry-save counters, and gives a block up
once every counter has passed the radius. A bucket above ``BLOCK`` fingerprints is dealt out as pairs of
blocks, each pair its own task row, so nothing is capped and no task gathers a bucket. A task emits a
spanning forest of the links it has seen, not all pairs.

Defined cases: a null or empty text, or one of white space, has fingerprint zero and is linked like any
other; texts below four words have one shingle; null ids are kept but never chosen as a component's id
while it has another; repeated rows have equal fingerprints; an empty table gives no rows. Other columns
are not read by :func:`near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from emberline.llm.components import components
from emberline.llm.text import unpacked
from emberline.session import cut_lineage

SHINGLE = 4
SEED = 42
BITS = 64
RADIUS = 4
PIECES = 6
BLOCK = 2048
# Words hashed at a time, and fingerprints compared at a time.
WORDS_AT_ONCE = 100_000
TILE = 512


# ---- fingerprints ---------------------------------------------------------------------------------


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of every shingle of a text, in order, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six white space characters only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    cuts = zip(begins[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Fingerprints of documents with at least one hash each."""
    sizes = np.array([len(h) for h in hashes])
    joined = np.concatenate(hashes)
    starts = np.cumsum(sizes) - sizes
    bits = np.unpackbits(joined.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints_of(texts: list[str | None]) -> np.ndarray:
    """Fingerprints, as signed 64-bit numbers; the memory it takes follows the longest text."""
    out = np.zeros(len(texts), np.uint64)
    held: list[np.ndarray] = []
    places: list[int] = []

    def flush() -> None:
        if held:
            out[places] = majority(held)
            held.clear()
            places.clear()

    for k, text in enumerate(texts):
        h = shingle_hashes(text)
        if len(h) > WORDS_AT_ONCE:  # a very long text: add its bits up in parts
            counts = sum(
                np.unpackbits(p.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
                for p in np.array_split(h, len(h) // WORDS_AT_ONCE + 1)
            )
            out[k] = np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0]
        elif len(h):
            held.append(h)
            places.append(k)
            if sum(map(len, held)) > WORDS_AT_ONCE:
                flush()
    flush()
    return out.view(np.int64)


def fingerprint(text: Column) -> Column:
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints_of([t if isinstance(t, str) else None for t in texts]))

    return F.pandas_udf(batch, "long")(text)


# ---- comparison -----------------------------------------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): bit i of plane b is bit b of fingerprint i; filled up with zeros to whole words."""
    full = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    full[: len(prints)] = prints
    bits = np.unpackbits(full.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


# Planes after which finished blocks are dropped.
PLANES = 4


def within(queries: np.ndarray, block: np.ndarray, radius: int = RADIUS, allowed: np.ndarray | None = None) -> np.ndarray:
    """Boolean (queries, block): which are at ``radius`` or fewer differing bits, of the pairs that are ``allowed``.

    A block is a query with 64 fingerprints of ``block``, a bit of a word for each. A counter of k planes is kept per
    pair; pairs that pass 2^k - 1 set ``over``, as do from the start the pairs that are not allowed and what fills up
    the last word. A block whose pairs are all over is abandoned.
    """
    planes = bit_planes(block)
    words, full = planes.shape[1], np.uint64(2**64 - 1)
    out_of_it = np.ones((len(queries), words * 64), bool)
    out_of_it[:, : len(block)] = False if allowed is None else ~allowed
    over = np.packbits(out_of_it, axis=1, bitorder="little").view("<u8").ravel()
    query, word = (x.ravel() for x in np.indices((len(queries), words)))
    depth = (radius + 1).bit_length()
    counter = np.zeros((depth, len(over)), np.uint64)
    for b in range(BITS):
        if b % PLANES == 0:
            # Counters above the radius are over, too.
            going = (over | above(counter, radius)) != full
            if not going.all():
                query, word, over, counter = query[going], word[going], over[going], counter[:, going]
            if not len(over):
                break
        own = np.where((queries >> np.uint64(b)) & np.uint64(1) == 1, full, np.uint64(0))
        carry = planes[b][word] ^ own[query]
        for k in range(depth):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
    good = np.zeros((len(queries), words), np.uint64)
    good[query, word] = ~(over | above(counter, radius))
    bits = np.unpackbits(good.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return bits[:, : len(block)].astype(bool)


def above(counter: np.ndarray, radius: int) -> np.ndarray:
    """Which counters, as numbers of bit planes, are above the radius."""
    more, equal = np.zeros_like(counter[0]), np.full_like(counter[0], np.uint64(2**64 - 1))
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            more |= equal & counter[k]
            equal &= ~counter[k]
    return more


def forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of links between numbers, those that join parts not yet joined."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((a, b))
    return kept


def compare_buckets(key: np.ndarray, side: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
    """Links within buckets; rows come sorted by bucket. Side 0 is compared with all, side 1 only with side 0."""
    links: list[tuple[int, int]] = []
    for a in range(0, len(key), TILE):
        rows = slice(a, a + TILE)
        stop = np.searchsorted(key, key[rows][-1], side="right")
        for c in range(a, stop, TILE):
            cols = slice(c, min(c + TILE, stop))
            allowed = (key[rows][:, None] == key[cols][None, :]) & (side[rows][:, None] + side[cols][None, :] < 2)
            if a == c:
                allowed = np.triu(allowed, 1)
            i, j = np.nonzero(within(prints[rows], prints[cols], allowed=allowed))
            new = prints[rows][i] < prints[cols][j]
            links += forest(*(x.view(np.int64) for x in (prints[rows][i[new]], prints[cols][j[new]])))
            new = prints[rows][i] > prints[cols][j]
            links += forest(*(x.view(np.int64) for x in (prints[cols][j[new]], prints[rows][i[new]])))
    return links


def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition that is sorted by bucket; the last bucket of a batch waits for the next batch."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 3

    def answer(rows: list[np.ndarray]) -> pa.RecordBatch:
        links = compare_buckets(rows[0], rows[1], rows[2].view(np.uint64)) if len(rows[0]) else []
        u, v = zip(*links, strict=True) if links else ((), ())
        return pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    for batch in batches:
        new = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("bucket", "side", "print")]
        held = [np.concatenate(pair) for pair in zip(held, new, strict=True)]
        if len(held[0]):
            cut = np.searchsorted(held[0], held[0][-1], side="left")
            if cut:
                yield answer([x[:cut] for x in held])
                held = [x[cut:] for x in held]
    yield answer(held)


def piece_columns() -> list:
    """Per choice of agreeing pieces: the bits that must agree, with the number of the choice."""
    bounds = [round(k * BITS / PIECES) for k in range(PIECES + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    out = []
    for k, chosen in enumerate(combinations(masks, PIECES - RADIUS)):
        mask = sum(chosen)
        out.append(F.xxhash64(F.lit(k), F.col("print").bitwiseAND(F.lit(mask - (mask >> 63 << 64)).cast("long"))))
    return out


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (column ``print``) within the radius."""
    rows = prints.select("print", F.explode(F.array(*piece_columns())).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    shared = rows.join(sizes, "bucket").select("bucket", "print", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    # Block i meets every block j: as side 0 where i < j or alone, as side 1 where i > j.
    dealt = shared.withColumn("own", own).select(
        "bucket", "print", "blocks", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    cells = dealt.select(
        F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(F.xxhash64("bucket", low, high)).alias("bucket"),
        (F.col("own") > F.col("other")).cast("long").alias("side"),
        "print",
    )
    return cells.repartition("bucket").sortWithinPartitions("bucket", "side").mapInArrow(link_rows, "u long, v long")


def classes(prints: DataFrame) -> DataFrame:
    """(print, component_id, root) for rows of (doc_id, print); component_id is the smallest doc_id reachable."""
    nodes = cut_lineage(prints.groupBy("print").agg(F.min("doc_id").alias("first_id")))
    reached = components(fingerprint_links(nodes))
    rooted = nodes.join(reached, nodes["print"] == reached["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("print", "component_id", "root")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (hexadecimal), component_id."""
    prints = cut_lineage(docs.select(F.col(id_column).alias("doc_id"), fingerprint(F.col(text)).alias("print")))
    return prints.join(classes(prints), "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: of its smallest id, nulls last, and among equal ids by hashes of the text."""
    key = {"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(1), "doc_id", "text")}
    slim = cut_lineage(docs.select("doc_id", *[c.alias(k) for k, c in key.items()], fingerprint(F.col("text")).alias("print")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("first")
    chosen = slim.join(classes(slim), "print").groupBy("root").agg(first).select("first.k1", "first.k2")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in key.items()])
    # Rows that agree in id and text are one more choice, by a hash of the whole row.
    kept = rows.join(chosen, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return unpacked(kept, docs.columns)
