"""Packing documents into sequences by patterns fitted with non-negative least squares.

A document is its token ids and a final id 0. Documents above ``ROOM`` tokens are cut into full pieces, the
remainder first. The histogram of piece lengths has at most ROOM rows however many documents there are; the
plan is made from it alone:

1. all patterns of one, two or three lengths that fill a sequence exactly are enumerated;
2. their repeat counts are fitted to the histogram by non-negative least squares: coordinate descent over the
   patterns whose gradient still calls for a step, until none does by more than the tolerance;
3. the counts are rounded and held to what the histogram has;
4. the residual lengths are packed best-fit, longest first, equal lengths in bulk.

Pieces are then numbered within their length (spread over hash cells, so a hot length is no single task) and
the number says in which sequence and at which offset a piece lies.

Defined cases: a null or empty text is the single id 0; repeated rows are packed each on its own; null ids
stay null; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from emberline.llm.ranking import with_place
from emberline.llm.wordwise import Split, byte_encoder
from emberline.session import cut_lineage

ROOM = 2048
END = 0
SEED = 6
# The fit ends when no repeat count calls for a step of more than this, or than this share of the largest count.
TOLERANCE, SHARE = 0.1, 1e-5
# Characters encoded at a time.
CHARACTERS = 6_000_000


# ---- pieces ---------------------------------------------------------------------------------------


def cut(n: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    if n <= room:
        return [(0, n)]
    first = n % room or room
    return [(0, first)] + [(s, room) for s in range(first, n, room)]


def piece_rows(path: str | None, room: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            a = 0
            while a < len(texts):
                b, held = a, 0
                while b < len(texts) and (b == a or held + len(texts[b]) <= CHARACTERS):
                    held += len(texts[b])
                    b += 1
                at, out = [], []
                found = byte_encoder(path).encode(Split(texts[a:b]))
                cuts, every = found.at.tolist(), memoryview(found.ids.astype("<u4").tobytes())
                for k, x, y in zip(range(a, b), cuts, cuts[1:], strict=False):
                    data = bytes(every[4 * x : 4 * y]) + end
                    for piece, (s, n) in enumerate(cut(len(data) // 4, room)):
                        at.append(k)
                        out.append((piece, s, n, zlib.crc32(data[4 * s : 4 * (s + n)])))
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(next(columns), pa.int32()), *[pa.array(c, pa.int64()) for c in columns]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
                a = b

    return rows


def pieces(docs: DataFrame, path: str | None = None, room: int = ROOM) -> DataFrame:
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(piece_rows(path, room), schema)


# ---- plan -----------------------------------------------------------------------------------------


def patterns(present: np.ndarray, room: int) -> np.ndarray:
    """Lengths that fill a sequence together: rows of three, longest first, 0 where a pattern has fewer.

    ``present`` are the lengths of the histogram; there are at most room ** 2 / 12 patterns of three.
    """
    there = np.zeros(room + 1, bool)
    there[present] = True
    out = [np.array([[room, 0, 0]])] if there[room] else []
    for a in present[::-1].tolist():
        rest = room - a
        if rest <= 0:
            continue
        if rest <= a and there[rest]:
            out.append(np.array([[a, rest, 0]]))
        second = present[(present <= min(a, rest - 1)) & (2 * present >= rest)][::-1]
        second = second[there[rest - second]]
        out.append(np.stack((np.full(len(second), a), second, rest - second), 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit_repeats(shapes: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that bring sum(x * pattern) near the histogram, in least squares, by coordinates."""
    x, left = np.zeros(len(shapes)), histogram.astype(float)
    left[0] = 0
    enough = max(TOLERANCE, SHARE * histogram.max(initial=0))
    # How often a pattern has each of its lengths: equal ones stand together.
    norms = np.zeros(len(shapes))
    for k in range(3):
        norms += (shapes == shapes[:, k : k + 1]).sum(1) * (shapes[:, k] > 0)
    while len(shapes):
        wanted = np.where(shapes > 0, left[shapes], 0).sum(1) / norms
        open_ = np.nonzero((wanted > enough) | ((wanted < -enough) & (x > 0)))[0]
        if not len(open_):
            break
        have, now = left.tolist(), x[open_].tolist()
        for k, (j, (a, b, c)) in enumerate(zip(open_.tolist(), shapes[open_].tolist(), strict=True)):
            step = (have[a] + (have[b] if b else 0) + (have[c] if c else 0)) / norms[j]
            step = max(-now[k], step)
            now[k] += step
            have[a] -= step
            if b:
                have[b] -= step
            if c:
                have[c] -= step
        x[open_], left = now, np.array(have)
    return x


def best_fit(histogram: np.ndarray, room: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: (lengths of a sequence, how many such sequences)."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = {room: []}
    done: list[tuple[tuple[int, ...], int]] = []

    def put(shape: tuple[int, ...], n: int, space: int) -> None:
        if n and space:
            free.setdefault(space, []).append((shape, n))
        elif n:
            done.append((shape, n))

    for length in np.nonzero(histogram)[0][::-1].tolist():
        count = int(histogram[length])
        for space in sorted(s for s in free if s >= length):
            fits = space // length
            while count and free[space]:
                shape, n = free[space].pop()
                full = min(n, count // fits)
                rest = min(count - full * fits, fits - 1) if full < n else 0
                put(shape + (length,) * fits, full, space - fits * length)
                put(shape + (length,) * rest, 1 if rest else 0, space - rest * length)
                untouched = n - full - (1 if rest else 0)
                count -= full * fits + rest
                if untouched:
                    free[space].append((shape, untouched))
            if not count:
                break
        if count:
            fits = room // length
            put((length,) * fits, count // fits, room - fits * length)
            put((length,) * (count % fits), 1 if count % fits else 0, room - (count % fits) * length)
    for space in sorted(free):
        done += free[space]
    return done


def make_plan(histogram: np.ndarray, room: int = ROOM) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence in order, how many such sequences) that use up the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    shapes = patterns(np.nonzero(left)[0], room)
    x = fit_repeats(shapes, left)
    plan = []
    for j in np.argsort(-x, kind="stable").tolist():
        want = int(x[j] + 0.5)
        if want <= 0:
            break
        shape = tuple(n for n in shapes[j].tolist() if n)
        want = min([want, *[int(left[n]) // shape.count(n) for n in set(shape)]])
        if want:
            plan.append((shape, want))
            for n in shape:
                left[n] -= want
    return plan + best_fit(left, room)


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per slot of the plan, sorted by (length, first place): where the places of a length go."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for shape, repeats in plan:
        offset = 0
        for length in shape:
            first = used.get(length, 0)
            rows.append((length, first, base, offset))
            used[length] = first + repeats
            offset += length
        base += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "base", "offset"), table.T.copy(), strict=True))


# ---- packing --------------------------------------------------------------------------------------


def pack(docs: DataFrame, path: str | None = None, room: int = ROOM, seed: int = SEED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cuts = cut_lineage(pieces(docs, path, room))
    histogram = np.zeros(room + 1, np.int64)
    for length, n in cuts.groupBy("length").count().collect():  # at most ``room`` rows
        histogram[length] = n
    table = slots(make_plan(histogram, room))  # at most a few slots per pattern, patterns bounded by room
    span = np.int64(2**44)
    keys = table["length"] * span + table["first"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, place = (batch.column(c).to_numpy() for c in ("length", "place"))
            slot = np.searchsorted(keys, length * span + place, side="right") - 1
            more = {
                "sequence_id": table["base"][slot] + place - table["first"][slot],
                "offset": table["offset"][slot],
            }
            kept = batch.select([c for c in batch.schema.names if c != "place"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *map(pa.array, more.values())], names=[*kept.schema.names, *more]
            )

    placed = with_place(cuts, ["length"], [F.col(c) for c in ("doc_id", "piece", "ids_crc32")], seed)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place").mapInArrow(
        settle,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
