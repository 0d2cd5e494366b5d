"""Cross-tokenizer alignment by lockstep merging.

Every text is encoded by two vocabularies: A, byte-level, and B, of sentence pieces. Byte offsets where tokens of
both end cut the two sequences into groups. One state vector holds, for all documents of a batch at once, a
pointer into A's tokens and one into B's. A step compares the ends under the two pointers of every document,
emits a cut where they are equal, together with the token ranges it closes (all links of the group), moves the
pointer that is behind, or both, and compacts the vector to the documents that are not finished. A long
document runs as several lanes, cut where words end, so that one text does not hold up its batch.

Links are counted over the corpus: an id pair's count is the number of documents that hold it linked. A batch
keeps its distinct pairs once, as a dictionary, and its documents as indexes into it; only dictionaries are
shuffled by pair and come back with counts. Texts of a batch are aligned a slice at a time, so that a worker holds the
tokens of one slice. No row of a pair or of a batch grows with the corpus but the counts.

Defined cases: a null or empty text, and a text whose tokens of A or of B do not spell a space and the text
byte for byte, has no tokens: all counts are zero and ``groups_sha256`` is ''. Repeated rows are documents of
their own; null ids stay null; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from emberline.llm.anchors import batches_of
from emberline.llm.spans import stored
from emberline.llm.wordwise import Split, byte_encoder, piece_encoder

#: Characters of text that are one batch, or one text.
CHARACTERS = 3_000_000
#: Characters of a batch that are encoded and aligned at a time, or one text.
SLICE = 400_000
#: Parts of texts that a worker remembers for each vocabulary.
MEMO = 150_000
#: Tokens of A after which a long document goes on in another lane.
LANE = 512
#: Links expanded at a time.
LINKS = 1_000_000
#: A group with more links than this is expanded by its distinct ids.
WIDE = 4_096
PAIR_BITS = 40
B_BITS = 20


# ---- lockstep -------------------------------------------------------------------------------------


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, from_a: np.ndarray, to_a: np.ndarray, from_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of all groups, in A and in B, in text order.

    A lane runs over A's tokens [from_a, to_a) and over B's from from_b on; both end at the same byte.
    """
    a, b, last = (x[to_a > from_a].copy() for x in (from_a, from_b, to_a))
    open_a, open_b = a.copy(), b.copy()
    starts_a, starts_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    while len(a):
        x, y = ends_a[a], ends_b[b]
        cut = x == y
        starts_a[open_a[cut]] = True
        starts_b[open_b[cut]] = True
        a += x <= y
        b += y <= x
        open_a, open_b = np.where(cut, a, open_a), np.where(cut, b, open_b)
        going = a < last
        if not going.all():
            a, b, last, open_a, open_b = a[going], b[going], last[going], open_a[going], open_b[going]
    return np.nonzero(starts_a)[0], np.nonzero(starts_b)[0]


def lanes(at: np.ndarray, words: np.ndarray, size: int = LANE) -> np.ndarray:
    """Which of ``words`` (token numbers at which words begin) begin a lane of documents that begin at ``at``."""
    doc = np.searchsorted(at, words, side="right") - 1
    part = (words - at[doc]) // size
    return np.concatenate(([True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])))


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... for all i, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


class Aligned:
    """Groups of a batch: first tokens in A and B (with the end as last entry), and where each document's begin."""

    def __init__(self, ids_a, at_a, ends_a, ids_b, at_b, ends_b, words_a, words_b):
        self.ids_a, self.ids_b, self.at_a, self.at_b = ids_a, ids_b, at_a, at_b
        first = lanes(at_a, words_a) if len(words_a) else np.empty(0, bool)
        from_a, from_b = words_a[first], words_b[first]
        to_a = np.append(from_a[1:], len(ids_a))
        groups_a, groups_b = lockstep(ends_a, ends_b, from_a, to_a, from_b)
        self.groups_a, self.groups_b = np.append(groups_a, len(ids_a)), np.append(groups_b, len(ids_b))
        self.at = np.searchsorted(groups_a, at_a)
        self.size_a, self.size_b = np.diff(self.groups_a), np.diff(self.groups_b)
        self.links = self.size_a * self.size_b

    def written(self) -> list[str]:
        """Per document its groups as text: ids of A, a bar, ids of B, groups parted by semicolons."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        closed_a, closed_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        closed_a[self.groups_a[1:] - 1] = 1
        closed_b[self.groups_b[1:] - 1] = 1
        code = np.empty(n_a + n_b, np.int64)
        code[np.arange(n_a) + np.repeat(self.groups_b[:-1], self.size_a)] = 4 * self.ids_a + closed_a
        code[np.arange(n_b) + np.repeat(self.groups_a[1:], self.size_b)] = 4 * self.ids_b + 2 + closed_b
        table = texts_of(int(max(self.ids_a.max(initial=0), self.ids_b.max(initial=0))) + 1)
        at = (self.at_a + self.at_b).tolist()
        code = code.tolist()
        return ["".join(map(table.__getitem__, code[x:y]))[:-1] for x, y in zip(at, at[1:], strict=False)]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document << PAIR_BITS | pair), ascending, and how often each is linked."""
        keys, times = np.empty(0, np.int64), np.empty(0, np.int64)
        doc = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        wide = self.links > WIDE
        plain = np.nonzero(~wide)[0]
        cuts = np.searchsorted(np.cumsum(self.links[plain]), np.arange(0, self.links[plain].sum() + LINKS, LINKS), side="right")
        for x, y in zip(cuts, cuts[1:], strict=False):
            g = plain[x:y]
            a = ranges(self.groups_a[g], self.size_a[g])
            of_a = np.repeat(g, self.size_a[g])
            pair = (np.repeat(self.ids_a[a], self.size_b[of_a]) << B_BITS) | self.ids_b[ranges(self.groups_b[of_a], self.size_b[of_a])]
            found = np.unique((np.repeat(doc[of_a], self.size_b[of_a]) << PAIR_BITS) | pair, return_counts=True)
            keys, times = summed(np.concatenate((keys, found[0])), np.concatenate((times, found[1])))
        for g in np.nonzero(wide)[0].tolist():
            a, n = np.unique(self.ids_a[self.groups_a[g] : self.groups_a[g + 1]], return_counts=True)
            b, m = np.unique(self.ids_b[self.groups_b[g] : self.groups_b[g + 1]], return_counts=True)
            pair = ((a[:, None] << B_BITS) | b).ravel() | (doc[g] << PAIR_BITS)
            keys, times = summed(np.concatenate((keys, pair)), np.concatenate((times, (n[:, None] * m).ravel())))
        return keys, times


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) < 2 or (keys[1:] > keys[:-1]).all():
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    return keys[first], np.add.reduceat(times, first)


_TEXTS: list[str] = []


def texts_of(n: int) -> list[str]:
    """For id i at 4 i and on: the id before a comma, before a bar, and again before a comma, before a semicolon."""
    for i in range(len(_TEXTS) // 4, n):
        _TEXTS.extend((f"{i},", f"{i}|", f"{i},", f"{i};"))
    return _TEXTS


def aligned(texts: list[str], path_a: str | None, path_b: str | None) -> Aligned:
    """Groups of texts; a text that the tokens of A or B do not spell has no tokens."""
    one, two = byte_encoder(path_a, True), piece_encoder(path_b)
    one.memo = two.memo = MEMO
    split = Split(texts, " ")
    a, b = one.encode(split), two.encode(split)
    if not (a.same & b.same).all():
        texts = [t if yes else "" for t, yes in zip(texts, (a.same & b.same).tolist(), strict=True)]
        split = Split(texts, " ")
        a, b = one.encode(split), two.encode(split)
    ends_a, ends_b = np.cumsum(one.width[a.ids]), np.cumsum(two.width[b.ids])
    # Words begin at the same bytes in both. A text that A encodes whole counts as one word.
    bytes_a, bytes_b = np.concatenate(([0], ends_a)), np.concatenate(([0], ends_b))
    words_a = a.words[np.diff(np.append(a.words, len(a.ids))) > 0]
    words_b = np.searchsorted(bytes_b, bytes_a[words_a])
    ids_a, ids_b = a.ids.astype(np.int64), b.ids.astype(np.int64)
    return Aligned(ids_a, a.at, ends_a, ids_b, b.at, ends_b, words_a, words_b)


# ---- operator -------------------------------------------------------------------------------------

BATCH_SCHEMA = "batch string, pairs array<long>, held array<int>, docs array<struct<{}>>".format(
    "doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string, at: int, of: int"
) + ", index binary, times binary"


def batch_rows(path_a: str | None, path_b: str | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for x, y in batches_of([len(t) for t in texts], CHARACTERS):
                yield one_batch(ids[x:y], texts[x:y], path_a, path_b)

    return rows


def one_slice(texts: list[str], path_a: str | None, path_b: str | None) -> tuple[dict, np.ndarray, np.ndarray]:
    """Columns of the documents, and their distinct (document << PAIR_BITS | pair) with times."""
    found = aligned(texts, path_a, path_b)
    links = np.concatenate(([0], np.cumsum(found.links)))[found.at]
    digest = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.written()]
    columns = {
        "n_a": np.diff(found.at_a), "n_b": np.diff(found.at_b), "n_groups": np.diff(found.at), "n_links": np.diff(links),
        "groups_sha256": np.array(digest, object),
    }
    return columns, *found.counted()


def one_batch(ids: pa.Array, texts: list[str], path_a: str | None, path_b: str | None) -> pa.RecordBatch:
    slices = []
    for x, y in batches_of([len(t) for t in texts], SLICE):
        columns, keys, times = one_slice(texts[x:y], path_a, path_b)
        slices.append((columns, keys + (x << PAIR_BITS), times))
    keys, times = (np.concatenate([s[k] for s in slices]) for k in (1, 2))
    pairs, index, held = np.unique(keys & ((1 << PAIR_BITS) - 1), return_inverse=True, return_counts=True)
    at = np.searchsorted(keys >> PAIR_BITS, np.arange(len(texts) + 1))
    columns = {name: np.concatenate([s[0][name] for s in slices]) for name in slices[0][0]}
    columns = {"doc_id": ids, **columns, "at": at[:-1].astype(np.int32), "of": at[1:].astype(np.int32)}
    docs = pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))
    row = {
        "batch": pa.array([uuid.uuid4().hex]),
        "pairs": pa.ListArray.from_arrays([0, len(pairs)], pa.array(pairs)),
        "held": pa.ListArray.from_arrays([0, len(pairs)], pa.array(held.astype(np.int32))),
        "docs": pa.ListArray.from_arrays([0, len(docs)], docs),
        "index": pa.array([index.astype(np.int32).tobytes()]),
        "times": pa.array([times.astype(np.int64).tobytes()]),
    }
    return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def answer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the counts of their links, from a batch and what its pairs count in the corpus."""
    for part in batches:
        for k in range(len(part)):
            docs = part.column("docs")[k].values
            index = np.frombuffer(part.column("index")[k].as_py(), np.int32)
            times = np.frombuffer(part.column("times")[k].as_py(), np.int64)
            counts = part.column("counts")[k].values
            place, n, best = ([] if counts is None else counts.field(f).to_numpy(zero_copy_only=False) for f in ("place", "n", "best"))
            count, top = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            if len(place):
                count[place], top[place] = n, best
            at, of = (docs.field(f).to_numpy() for f in ("at", "of"))
            sums = [np.concatenate(([0], np.cumsum(times * x[index]))) for x in (top, count)]
            columns = {f: docs.field(f) for f in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            columns |= {name: pa.array(s[of] - s[at]) for name, s in zip(("n_best", "count_sum"), sums, strict=True)}
            columns["groups_sha256"] = docs.field("groups_sha256")
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def pair_counts(batches: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked; 1 if no pair of its A id has more."""
    pairs = batches.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.pairs", "p.held")
    counts = pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n"))
    # At most as many rows of one A id as B has ids.
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counts.withColumn("best", (F.col("n") == F.max("n").over(of_a)).cast("long"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    batches = stored(texts.mapInArrow(batch_rows(path_a, path_b), BATCH_SCHEMA), "aligned")
    wanted = batches.select("batch", F.posexplode("pairs").alias("place", "pair"))
    known = wanted.join(pair_counts(batches), "pair")
    answers = known.groupBy("batch").agg(F.collect_list(F.struct("place", "n", "best")).alias("counts"))
    both = batches.select("batch", "docs", "index", "times").join(answers, "batch", "left")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return both.select("docs", "index", "times", "counts").mapInArrow(answer_rows, schema)


def links(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The corpus-wide table of links: id_a, id_b, n (documents that hold the pair linked), best."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    counts = pair_counts(stored(texts.mapInArrow(batch_rows(path_a, path_b), BATCH_SCHEMA), "aligned"))
    id_b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    return counts.select(F.shiftright("pair", B_BITS).alias("id_a"), id_b.alias("id_b"), "n", (F.col("best") == 1).alias("best"))
