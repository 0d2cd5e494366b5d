"""Substring duplicates by relative Lempel-Ziv parsing against the documents before.

A document is read as factors: runs of words that also stand, in this order, at one place of a reference document
with a smaller id. A factor of at least ``LENGTH`` words is a duplicate span. The references of a document are not
a few chosen ones but every block of every document with a smaller id, through an index:

1. Every window of LENGTH words has an anchor (:mod:`emberline.llm.anchors`); equal windows have equal anchors.
   The blocks of the index are the spans of the anchors. Anchors of one document only are dropped.
2. Where all spans of an anchor are equal, the block as a whole is found in the first document that has it.
3. Other blocks are looked up window by window: per window the first place that has it (smallest id, then text, then
   place), by partial minima, so a window that a third of all documents share is one row of the index and no task
   gathers its documents.
4. The parse goes through a document greedily: a factor starts at the first window that has a reference and goes
   on while the next window follows in the same text at the next place; then the next factor starts, one window on.
   So a factor stands in its reference word by word, from ``place`` on. It is as long as the first holder of its
   windows goes on, which need not be the longest match of all. Windows across the border of two factors have been
   looked up like all others, so no border hides a duplicate.

A word is 128 bits of a cryptographic hash of its bytes; windows are compared by two 64-bit hashes over the two halves.

Defined cases: a null text has no words; texts below LENGTH words stay whole; rows with the same id are not
references of each other; rows with a null id are references of all others (smallest of all) and come out with a
null id; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from emberline.llm import anchors as A
from emberline.llm.spans import AT_ONCE, KEY, column, each_text, keyed, lists, original_id, record, sampled, stored, with_facts

LENGTH = 13
GRAM = 5
# The white space bytes.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every word of all texts in order, and where each text's words begin (with the end as last entry)."""
    data, starts = A.joined_bytes([t + b" " for t in texts])
    gap = SPACE[data]
    before = np.concatenate(([True], gap[:-1])) if len(gap) else gap
    begin = np.nonzero(~gap & before)[0]
    # Words and the gaps behind them in turns; every distinct word is hashed once.
    cuts = np.append(np.stack((begin, np.nonzero(gap & ~before)[0]), 1).ravel(), len(data)).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_binary(), 2 * len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    coded = runs.take(pa.array(np.arange(0, 2 * len(begin), 2))).dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    digests = b"".join([hashlib.blake2b(w, digest_size=16).digest() for w in distinct])
    both = np.frombuffer(digests, np.uint64).reshape(-1, 2)[coded.indices.to_numpy(zero_copy_only=False)]
    return both[:, 0].copy(), both[:, 1].copy(), np.searchsorted(begin, starts)


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        did, th, tw = (column(batch, k) for k in KEY)
        texts = batch.column("data").to_pylist()
        for a, b in A.batches_of([len(t) for t in texts], AT_ONCE):
            words, more, starts = word_hashes(texts[a:b])
            one, two = A.Prefixes(words), A.Prefixes(more, A.BASES[1])
            found = A.find(A.gram_hashes(one, len(words), GRAM), starts, LENGTH, GRAM)
            if not len(found.doc):
                continue
            block = two.ranges(found.first, found.last + LENGTH) + (found.place - found.first).astype(np.uint64)
            yield record(
                h=one.ranges(found.place, found.place + GRAM).view(np.int64),
                c=A.mixed(block).view(np.int64),
                did=did[a:b][found.doc],
                th=th[a:b][found.doc],
                tw=tw[a:b][found.doc],
                at=(found.first - starts[found.doc]).astype(np.int32),
                n=(found.last - found.first).astype(np.int32),
            )


def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of a text's open blocks, by their two hashes."""
    for batch in batches:
        texts, (did, th, tw) = batch.column("data").to_pylist(), (column(batch, k) for k in KEY)
        at, cut = lists(batch, "at")
        n, _ = lists(batch, "n")
        for a, b in A.batches_of([len(t) for t in texts], AT_ONCE):
            words, more, starts = word_hashes(texts[a:b])
            own = slice(cut[a], cut[b])
            doc = np.repeat(np.arange(b - a), np.diff(cut[a : b + 1]))
            count = n[own].astype(np.int64) + 1
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            doc, place = np.repeat(doc, count), np.repeat(at[own].astype(np.int64), count) + inner
            begin = starts[doc] + place
            yield record(
                w1=A.Prefixes(words).ranges(begin, begin + LENGTH).view(np.int64),
                w2=A.Prefixes(more, A.BASES[1]).ranges(begin, begin + LENGTH).view(np.int64),
                did=did[a:b][doc],
                th=th[a:b][doc],
                tw=tw[a:b][doc],
                at=place.astype(np.int32),
            )


def parse(at: np.ndarray, n: np.ndarray, ref: np.ndarray, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Factors (begin, end, reference, place) in words, from where windows at .. at + n stand.

    That is in document ``ref``, in its text with hash ``text``, from word ``place`` on.
    """
    count = n.astype(np.int64) + 1
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    window, there = np.repeat(at.astype(np.int64), count) + inner, np.repeat(place.astype(np.int64), count) + inner
    ref, text = np.repeat(ref, count), np.repeat(text, count)
    order = np.lexsort((there, text, ref, window))
    window, there, ref, text = window[order], there[order], ref[order], text[order]
    once = np.concatenate(([True], window[1:] != window[:-1])) if len(window) else np.empty(0, bool)
    window, there, ref, text = window[once], there[once], ref[once], text[once]
    if not len(window):
        return window, window, ref, there
    follows = (window[1:] == window[:-1] + 1) & (there[1:] == there[:-1] + 1) & (ref[1:] == ref[:-1]) & (text[1:] == text[:-1])
    first = np.nonzero(np.concatenate(([True], ~follows)))[0]
    last = np.concatenate((first[1:], [len(window)])) - 1
    return window[first], window[last] + LENGTH, ref[first], there[first]


REFERENCE = ["ref", "rt", "rp"]


def references(texts: DataFrame) -> DataFrame:
    """(did, th, tw, at, n, ref, rt, rp): windows at .. at + n of a text stand in the smaller document ref, in its text
    with hash rt, from word rp on."""
    schema = "h long, c long, did long, th long, tw long, at int, n int"
    anchors, some = (t.mapInArrow(anchor_rows, schema) for t in (texts, sampled(texts)))
    first = F.min(F.struct("did", "th", "at"))
    facts = {"first": first, "last": F.max("did"), "c0": F.min("c"), "c1": F.max("c")}
    shared = with_facts(anchors, some, ["h"], facts).where("first.did < last")
    held = [F.col("first.did").alias("ref"), F.col("first.th").alias("rt"), F.col("first.at").alias("rp")]
    known = stored(shared.select(*KEY, "at", "n", *held, (F.col("c0") != F.col("c1")).alias("open")), "anchors")
    same = known.where("NOT open AND did > ref").select(*KEY, "at", "n", *REFERENCE)
    wanted = known.where("open").groupBy(*KEY).agg(F.collect_set(F.struct("at", "n")).alias("s"))
    wanted = wanted.select(*KEY, F.col("s.at").alias("at"), F.col("s.n").alias("n"))
    windows, some = (
        t.join(wanted, KEY).mapInArrow(window_rows, "w1 long, w2 long, did long, th long, tw long, at int") for t in (texts, sampled(texts))
    )
    found = with_facts(windows, some, ["w1", "w2"], {"first": first}).where("did > first.did")
    return same.unionByName(found.select(*KEY, "at", F.lit(0).alias("n"), *held))


def factor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ["at", "n", *REFERENCE]
        cut = lists(batch, "at")[1]
        values = [lists(batch, name)[0] for name in names]
        out = [parse(*[v[x:y] for v in values]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
        sizes = [len(o[0]) for o in out]
        b, e, r, p = (np.concatenate([o[k] for o in out] + [np.empty(0, np.int64)]).astype(np.int64) for k in range(4))
        yield record(
            **{k: np.repeat(column(batch, k), sizes) for k in KEY},
            b=b.astype(np.int32), e=e.astype(np.int32), ref=r, place=p.astype(np.int32),
        )


def factors(texts: DataFrame) -> DataFrame:
    """(did, th, tw, b, e, ref, place): the factors of LENGTH words or more of every text, in words.

    Words b .. e of the text are words place .. of document ``ref``.
    """
    found = references(texts).groupBy(*KEY).agg(F.collect_set(F.struct("at", "n", *REFERENCE)).alias("s"))
    listed = found.select(*KEY, *[F.col(f"s.{c}").alias(c) for c in ("at", "n", *REFERENCE)])
    return listed.mapInArrow(factor_rows, "did long, th long, tw long, b int, e int, ref long, place int")


def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts, begins, ends in each_text(batches):
        total, removed, digest = [], [], []
        for text, b, e in zip(texts, begins, ends, strict=True):
            words = text.split()  # bytes: the six white space characters only
            b, e = A.merged(b, e)
            kept, last = [], 0
            for x, y in zip(b.tolist(), e.tolist(), strict=True):
                kept += words[last:x]
                last = y
            kept += words[last:]
            total.append(len(words))
            removed.append(len(words) - len(kept))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield record(
            did=batch.column("did"), n_words=pa.array(total, pa.int64()), n_removed=pa.array(removed, pa.int64()),
            kept_sha256=pa.array(digest, pa.string()),
        )


def remove_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    texts = keyed(docs)
    found = factors(texts).groupBy(*KEY).agg(F.collect_list(F.struct("b", "e")).alias("s"))
    spans = found.select(*KEY, F.col("s.b").alias("b"), F.col("s.e").alias("e"))
    both = texts.join(spans, KEY, "left").select("did", "data", "b", "e")
    out = both.mapInArrow(clean_rows, "did long, n_words long, n_removed long, kept_sha256 string")
    return out.select(original_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256")
