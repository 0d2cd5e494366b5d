"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

A vector's components become integers floor(``SCALE`` * x) and the vector is cut into ``PARTS`` equal parts. Every
part has a codebook of ``ENTRIES`` entries, fitted by ``ROUNDS`` rounds of assignment and integer means.

Orchard's search keeps for every entry the list of all entries sorted by distance from it. A search stands at an
entry and walks its list; an entry that lies nearer to the vector is jumped to, and its list is walked from the
start. Entries looked at are marked and not looked at again. The search is over when the next entry of the list
is farther from the standing entry than twice the distance of the vector: by the triangle inequality nothing
behind it can be nearer. Distances are integers, so equal ones are seen as such and the lower index wins. All
vectors of a block are searched at once, one step of every search at a time.

Every round is one pass over the table: tasks add up the parts of their own vectors by entry, and one row per
part and entry and task is shuffled. Codebooks are at most PARTS * ENTRIES rows; they are all the driver holds.

Defined cases: rows whose vector is null or has a null, NaN or infinite component are left out. A shorter vector
than the longest is filled up with zeros, to a multiple of PARTS. Integers are held to +-2^26, so that squared
distances fit a long. With fewer kept rows than ENTRIES there are as many entries as rows; a null vec_id comes
last in the order of ids, and equal ids are ordered by their vectors. Repeated rows count each on its own; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from emberline.llm.spans import record, stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LARGEST = 1 << 26
# Vectors searched at once.
BLOCK = 8_192


# ---- search ---------------------------------------------------------------------------------------


class Orchard:
    """Neighbour lists over the entries of one codebook (entries x components, integers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        n = len(entries)
        self.apart = np.stack([((self.entries - e) ** 2).sum(1) for e in self.entries])
        self.apart[np.arange(n), np.arange(n)] = -1  # itself first, before equal entries
        self.lists = np.argsort(self.apart, axis=1, kind="stable")
        self.apart = np.maximum(np.take_along_axis(self.apart, self.lists, 1), 0)
        # Where all searches begin: the entry nearest to the mean.
        self.first = int(((self.entries - self.entries.mean(0)) ** 2).sum(1).argmin())

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every vector (the lower index of equally near ones) and the squared distance."""
        kind = self.exact(vectors)
        entries, vectors = self.entries.astype(kind), vectors.astype(kind)
        n = len(vectors)
        at = np.full(n, self.first)
        near = squared(vectors - entries[at])
        marked = np.zeros((n, len(entries)), bool)
        marked[np.arange(n), at] = True
        place = np.ones(n, np.int64)
        going = np.arange(n) if len(entries) > 1 else np.empty(0, np.int64)
        while len(going):
            stand, p = at[going], place[going]
            inside = self.apart[stand, p] <= 4 * near[going]
            going, stand, p = going[inside], stand[inside], p[inside]
            entry = self.lists[stand, p]
            new = ~marked[going, entry]
            look, there = going[new], entry[new]
            marked[look, there] = True
            far = squared(vectors[look] - entries[there])
            better = (far < near[look]) | ((far == near[look]) & (there < at[look]))
            place[going] += 1
            jump = look[better]
            at[jump], near[jump], place[jump] = there[better], far[better], 1
            going = going[place[going] < len(entries)]
        return at, near.astype(np.int64)

    def exact(self, vectors: np.ndarray) -> type:
        """Floating point where it holds all sums of squares exactly, whole numbers elsewhere."""
        top = max(int(np.abs(vectors).max(initial=0)), int(np.abs(self.entries).max(initial=0)), 1)
        return np.float64 if 4 * top * top * vectors.shape[1] < 1 << 53 else np.int64


def squared(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


# ---- passes ---------------------------------------------------------------------------------------


@dataclass
class Codebooks:
    """Entries by part: parts x entries x components."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def assigned(batch: pa.RecordBatch, orchards: list[Orchard]):
    """(from, vectors, entries by part, distances by part) of the blocks of a batch."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    table = flat.reshape(len(batch), -1)
    width = table.shape[1] // len(orchards)
    for a in range(0, len(table), BLOCK):
        some = table[a : a + BLOCK]
        found = [o.search(some[:, k * width : (k + 1) * width]) for k, o in enumerate(orchards)]
        yield a, some, np.stack([f[0] for f in found]), np.stack([f[1] for f in found])


def sum_rows(entries: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchards = [Orchard(e) for e in entries]
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(entries.shape[:2], np.int64)
        width = entries.shape[2]
        for batch in batches:
            for _, some, at, _ in assigned(batch, orchards):
                for k, entry in enumerate(at):
                    np.add.at(sums[k], entry, some[:, k * width : (k + 1) * width])
                    counts[k] += np.bincount(entry, minlength=len(counts[k]))
        part, entry = np.nonzero(counts)
        if len(part):
            yield record(
                part=part, entry=entry, n=counts[part, entry],
                sums=pa.FixedSizeListArray.from_arrays(pa.array(sums[part, entry].ravel()), width).cast(pa.list_(pa.int64())),
            )

    return rows


def code_rows(entries: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchards = [Orchard(e) for e in entries]
        for batch in batches:
            for a, some, at, far in assigned(batch, orchards):
                digits = at.T.astype(np.uint8).tobytes().hex()
                size = 2 * len(entries)
                yield record(
                    vec_id=batch.column("vec_id")[a : a + len(some)], label=batch.column("label")[a : a + len(some)],
                    code=[digits[i : i + size] for i in range(0, len(digits), size)], error=far.sum(0),
                )

    return rows


def whole_vectors(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, v): kept rows with their integer components, all of one length."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    kept = vectors.select("vec_id", "label", x.alias("x")).where(
        F.col("x").isNotNull() & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    longest = kept.agg(F.max(F.size("x"))).head()[0] or 0
    length = -(-max(longest, 1) // parts) * parts
    held = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST))))
    whole = F.transform("x", held)
    return kept.select("vec_id", "label", F.concat(whole, F.array_repeat(F.lit(0).cast("long"), length - F.size("x"))).alias("v"))


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; a fixed number of rows."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not rows:
        return None
    table = np.array([r[0] for r in rows], np.int64)
    return Codebooks(table.reshape(len(table), parts, -1).transpose(1, 0, 2).copy())


def next_codebooks(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floor of the mean of its parts; unused entries stay."""
    width = books.entries.shape[2]
    sums = vectors.mapInArrow(sum_rows(books.entries), "part long, entry long, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    entries = books.entries.copy()
    for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
        entries[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return Codebooks(entries)


def fit(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> Codebooks | None:
    books = first_codebooks(vectors, entries=entries)
    for _ in range(rounds if books else 0):
        books = next_codebooks(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of prepared vectors."""
    kinds = dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return vectors.mapInArrow(code_rows(books.entries), schema)


def compress(table: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    vectors = whole_vectors(table)
    books = fit(vectors)
    if books is None:
        empty = vectors.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")])
        return empty.withColumn("codebooks_sha256", F.lit("")).where("false")
    codes = stored(encode(vectors, books), "codes")
    key = F.struct("label").alias("key")  # a struct of null equals itself
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).select(key, "label_error")
    out = codes.select("vec_id", "code", "error", key).join(by_label, "key")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
