"""Repeated byte strings through the interval tree of an enhanced suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else as well. All such strings lie in
maximal repeats of at least that length: strings with several occurrences that differ both in what precedes and
in what follows them. They are the left-diverse nodes of the common-prefix interval tree.

A suffix array of the whole corpus would be one sorted table of all its bytes. It is built sparse instead:

1. Every string of LENGTH bytes has an anchor (:mod:`emberline.llm.anchors`), about one per 80 bytes of text, and
   equal strings have equal anchors at the same distance. Anchors that occur once are dropped; nothing else is.
2. Where all occurrences of an anchor have one and the same span, every string in it repeats.
3. Otherwise equal spans of the anchor are merged with their count, by a hash, before any text is read. The
   distinct ones meet in a task. It sorts the suffixes that may repeat, scans their common prefixes with a stack,
   tests the nodes for left diversity, and reports every node with all its occurrences. The answer of a span is
   handed back to all places that have it.
4. The distinct spans of a very frequent anchor are first cut into overlapping blocks: the strings that have the
   anchor at one of ``WIDTHS[0]`` neighbouring distances. Strings of a block can be equal only if what all strings of
   the block have in common is, so blocks meet by that context. Equal blocks are merged, and a context that still has
   more than ``GROUP`` distinct ones is cut finer, down to single strings. Every block goes through step 3.

Texts are compared as bytes in step 3; spans are taken for equal by two 64-bit hashes, blocks by 64 bits within their
context's 64.

Defined cases: a null text is empty; texts below LENGTH bytes stay whole; a repeated row makes both rows' strings
repeats; rows with null ids count like others and come out with a null id; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from emberline.llm import anchors as A
from emberline.llm.spans import KEY, cleaned, column, each_text, keyed, lists, original_id, record, sampled, stored, with_facts

LENGTH = 200
GRAM = 40
#: Distinct spans (or occurrences of an anchor) that meet in one task; more are cut into finer blocks.
GROUP = 400
WIDTHS = (40, 8, 1)
#: Bytes of text whose anchors are looked for at a time, or one text; some 150 bytes of memory each.
AT_ONCE = 250_000
# Spans gathered before a task sorts them, and suffixes sorted at a time (whole groups).
SPAN_BYTES = 1_000_000
SUFFIXES = 20_000
#: Rows that ``group_rows`` takes over from a batch at a time.
SPAN_ROWS = 1_000


# ---- anchors --------------------------------------------------------------------------------------


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        did, th, tw = (column(batch, k) for k in KEY)
        texts = batch.column("data").to_pylist()
        for a, b in A.batches_of([len(t) for t in texts], AT_ONCE):
            data, starts = A.joined_bytes(texts[a:b])
            values = data.astype(np.uint64)
            one, two = A.Prefixes(values), A.Prefixes(values, A.BASES[1])
            found = A.find(A.gram_hashes(one, len(data), GRAM), starts, LENGTH, GRAM)
            if not len(found.doc):
                continue
            end = np.minimum(found.place + GRAM, len(data))
            span = two.ranges(found.first, found.last + LENGTH) + (found.place - found.first).astype(np.uint64)
            yield record(
                h=one.ranges(found.place, end).view(np.int64),
                c=A.mixed(span).view(np.int64),
                did=did[a:b][found.doc],
                th=th[a:b][found.doc],
                tw=tw[a:b][found.doc],
                at=(found.first - starts[found.doc]).astype(np.int32),
                n=(found.last - found.first).astype(np.int16),
                p=(found.place - found.first).astype(np.int16),
            )


def span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct spans that a text is asked for: its strings have their anchor ``lo`` to ``hi`` bytes in."""
    for batch in batches:
        texts = batch.column("data").to_pylist()
        wanted = {name: lists(batch, name) for name in ("at", "n", "p", "h", "c", "m")}
        cut = wanted["at"][1]
        for k, text in enumerate(texts):
            at, n, p, h, c, m = (values[cut[k] : cut[k + 1]] for values, _ in wanted.values())
            spans = [text[a : a + size + LENGTH] for a, size in zip(at.tolist(), n.tolist(), strict=True)]
            yield record(h=h, c=c, m=m, lo=(p - n).astype(np.int32), hi=p.astype(np.int32), span=pa.array(spans, pa.binary()))


def number(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)


def block_rows(width: int):
    """Blocks of spans (h, c, m, lo, hi, span): (bh, bc) name a block's context and content, ``base`` is its place."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("h", "c", "m", "lo", "hi", "span")]
            for h, c, m, lo, hi, span in zip(*columns, strict=True):
                named = h.to_bytes(8, "little", signed=True)
                for block in range(lo // width, hi // width + 1):
                    low, high = max(lo, width * block), min(hi, width * block + width - 1)
                    piece = span[hi - high : hi - low + LENGTH]
                    shared = hi - width * block
                    context = span[shared : shared + LENGTH - width + 1]
                    bh = number(named, width.to_bytes(2, "little"), block.to_bytes(2, "little"), context)
                    out.append((h, c, hi - high, bh, number(high.to_bytes(2, "little"), piece), m, low, high, piece))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                names = ["h", "c", "base", "bh", "bc", "m", "lo", "hi", "span"]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return rows


# ---- interval tree --------------------------------------------------------------------------------


def intervals(common: list[int], before: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the left-diverse nodes with length >= least of a sorted suffix list.

    ``common[i]`` is the common prefix of suffixes i - 1 and i, ``before[i]`` what precedes suffix i; -1 differs
    from everything. A stack holds the open nodes: length, first suffix, and the one byte that precedes all
    their suffixes, or None once two differ.
    """
    stack: list[list] = []
    for i in range(1, len(common) + 1):
        now = common[i] if i < len(common) and common[i] >= least else 0
        first, left = i - 1, (before[i - 1] if before[i - 1] >= 0 else None)
        while stack and stack[-1][0] > now:
            length, first, byte = stack.pop()
            left = byte if byte == left else None
            if left is None:
                yield length, first, i - 1
        if now and (not stack or stack[-1][0] < now):
            stack.append([now, first, left])
        elif stack:
            stack[-1][2] = stack[-1][2] if stack[-1][2] == left else None


def sorted_suffixes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, group: np.ndarray):
    """Order of the suffixes [begin, end) by group and bytes, and the common prefix of each with the one before."""
    width = int((end - begin).max())
    low = int(begin.min())
    part = np.concatenate((data[low : int(end.max())], np.zeros(width, np.uint8)))
    table = np.empty((len(begin), width + 4), np.uint8)
    table[:, :4] = group.astype(">u4").view(np.uint8).reshape(-1, 4)
    table[:, 4:] = np.lib.stride_tricks.sliding_window_view(part, width)[begin - low]
    table[:, 4:] *= np.arange(width) < (end - begin)[:, None]
    order = np.argsort(table.view(f"S{width + 4}").ravel(), kind="stable")
    table, size = table[order], (end - begin)[order]
    common = np.zeros(len(order), np.int64)
    differ = table[1:] != table[:-1]
    first = np.where(differ.any(1), differ.argmax(1), width + 4) - 4
    del table, differ
    common[1:] = np.clip(np.minimum(first, np.minimum(size[1:], size[:-1])), 0, None)
    return order, common


def repeated_ranges(spans: list[bytes], group: np.ndarray, least: int = LENGTH):
    """Of spans sorted by group number: (span, begin, end) of what maximal repeats within a group cover."""
    data, starts = A.joined_bytes(spans)
    sizes = np.diff(starts)
    windows = np.maximum(sizes - least + 1, 0)
    owner = np.repeat(np.arange(len(spans)), windows)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[owner]
    # Only suffixes whose first bytes hash alike within their group can repeat.
    hashed = A.mixed(A.Prefixes(data.astype(np.uint64)).ranges(begin, begin + least) + group[owner].astype(np.uint64))
    _, inverse, counts = np.unique(hashed, return_inverse=True, return_counts=True)
    may = np.nonzero(counts[inverse] > 1)[0]
    out_span, out_begin, out_end = [], [], []
    cuts = np.searchsorted(group[owner[may]], np.unique(group[owner[may]]), side="right")
    a = 0
    while a < len(may):
        within = cuts[(cuts > a) & (cuts <= a + SUFFIXES)]
        b = int(within[-1] if len(within) else cuts[cuts > a][0])
        own = owner[may[a:b]]
        p = begin[may[a:b]]
        order, common = sorted_suffixes(data, p, starts[own + 1], group[own])
        before = np.where(p > starts[own], data[np.maximum(p - 1, 0)].astype(np.int64), -1)[order]
        reach = np.zeros(len(p), np.int64)
        nodes = sorted(intervals(common.tolist(), before.tolist(), least))
        for length, i, j in nodes:
            reach[i : j + 1] = length
        hit = np.nonzero(reach)[0]
        out_span.append(own[order[hit]])
        out_begin.append(p[order[hit]] - starts[own[order[hit]]])
        out_end.append(out_begin[-1] + reach[hit])
        a = b
    join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return join(out_span), join(out_begin), join(out_end)


def maximal_repeats(texts: list[bytes], least: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """All maximal repeats of some texts with all occurrences (text, place), for inspection of one group."""
    data, starts = A.joined_bytes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    begin = np.arange(len(data))
    if not len(data):
        return []
    order, common = sorted_suffixes(data, begin, starts[owner + 1], np.zeros(len(data), np.int64))
    before = np.where(begin > starts[owner], data[np.maximum(begin - 1, 0)].astype(np.int64), -1)[order]
    found = []
    for length, i, j in intervals(common.tolist(), before.tolist(), least):
        places = sorted((int(owner[p]), int(p - starts[owner[p]])) for p in order[i : j + 1])
        t, p = places[0]
        found.append((texts[t][p : p + length], places))
    return sorted(found)


def group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges that repeat, per distinct span; the rows come sorted by (h, c), the last group waits for the next batch."""
    held: list[list] = [[], [], [], []]

    def answer(h: list, c: list, m: list, spans: list) -> pa.RecordBatch:
        # A text that is there more than once gives its spans as often: equal neighbours are one.
        one = [k for k in range(len(h)) if not k or (h[k], c[k]) != (h[k - 1], c[k - 1])]
        h, c, m, spans = ([x[k] for k in one] for x in (h, c, m, spans))
        many = np.array(m, np.int64) > 1
        group = np.unique(np.array(h, np.int64), return_inverse=True)[1]
        crowd = np.nonzero(np.bincount(group, minlength=1)[group] > 1)[0]
        span, begin, end = repeated_ranges([spans[i] for i in crowd], group[crowd]) if len(crowd) else [np.empty(0, np.int64)] * 3
        span = crowd[span]
        single = ~many[span]
        whole = np.nonzero(many)[0]
        b_out, who = [np.zeros(len(whole), np.int64)], [whole]
        e_out = [np.array([max(len(spans[i]), LENGTH) for i in whole], np.int64)]
        span, begin, end = span[single], begin[single], end[single]
        order = np.argsort(span, kind="stable")
        cuts = np.nonzero(np.diff(span[order], prepend=-1))[0].tolist() + [len(span)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            b, e = A.merged(begin[order[x:y]], end[order[x:y]])
            b_out.append(b), e_out.append(e), who.append(np.full(len(b), span[order[x]]))
        who = np.concatenate(who).astype(np.int64)
        pick = lambda values: np.array(values, np.int64)[who]
        return record(h=pick(h), c=pick(c), b=np.concatenate(b_out).astype(np.int32), e=np.concatenate(e_out).astype(np.int32))

    for batch in (b.slice(at, SPAN_ROWS) for b in batches for at in range(0, len(b), SPAN_ROWS)):
        for have, name in zip(held, ("h", "c", "m", "span"), strict=True):
            have.extend(batch.column(name).to_pylist())
        if sum(map(len, held[3])) > SPAN_BYTES:
            cut = held[0].index(held[0][-1])
            if cut:
                yield answer(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
    if held[0]:
        yield answer(*held)


# ---- operator -------------------------------------------------------------------------------------

ANSWERS = "h long, c long, b int, e int"


def answered(spans: DataFrame) -> DataFrame:
    """(h, c, b, e): what repeats within distinct spans (h, c, m, span) of one h."""
    return spans.select("h", "c", "m", "span").repartition("h").sortWithinPartitions("h", "c").mapInArrow(group_rows, ANSWERS)


BLOCKS = "h long, c long, base int, bh long, bc long, m long, lo int, hi int, span binary"
SPANS = "h long, c long, m long, lo int, hi int, span binary"


def asked(texts: DataFrame, spans: DataFrame, width: int = 0) -> DataFrame:
    """(h, c, m, lo, hi, span): the spans (h, c, m, did, th, tw, at, n, p) with their bytes, read from their texts.

    With ``width`` they are cut into blocks by the same worker.
    """
    lists_of = spans.groupBy(*KEY).agg(F.collect_list(F.struct("at", "n", "p", "h", "c", "m")).alias("s"))
    wanted = lists_of.select(*KEY, *[F.col(f"s.{c}").alias(c) for c in ("at", "n", "p", "h", "c", "m")])
    cut = (lambda batches: block_rows(width)(span_rows(batches))) if width else span_rows
    return texts.join(wanted, KEY).mapInArrow(cut, BLOCKS if width else SPANS)


def blocks_answered(blocks: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """Answers (h, c, b, e) of the spans that stored ``blocks`` were cut from; crowded contexts are cut finer."""
    distinct = blocks.groupBy("bh", "bc").agg(F.sum("m").alias("m"), *[F.min(x).alias(x) for x in ("lo", "hi", "span")])
    sizes = distinct.groupBy("bh").agg(F.count(F.lit(1)).alias("k"), F.sum("m").alias("total")).where("total > 1")
    as_spans = lambda df: df.withColumnsRenamed({"bh": "h", "bc": "c"})
    if widths:
        sized = stored(distinct.join(sizes, "bh"), "blocks")
        answers = answered(as_spans(sized.where(F.col("k") <= GROUP)))
        crowded = as_spans(sized.where(F.col("k") > GROUP))
        if not crowded.isEmpty():
            finer = stored(crowded.mapInArrow(block_rows(widths[0]), BLOCKS), "finer")
            answers = answers.unionByName(blocks_answered(finer, widths[1:]))
    else:  # single strings: a context has one
        answers = answered(as_spans(distinct.join(sizes.select("bh"), "bh")))
    named = answers.select(F.col("h").alias("bh"), F.col("c").alias("bc"), "b", "e")
    found = blocks.select("h", "c", "base", "bh", "bc").join(named, ["bh", "bc"])
    return found.select("h", "c", (F.col("base") + F.col("b")).alias("b"), (F.col("base") + F.col("e")).alias("e"))


def span_answers(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(h, c, s): ranges that repeat within the spans of open anchors, one row per distinct span."""
    first = known.where("open AND first")
    few = first.where("NOT hot").select("h", "c", "m", *KEY, "at", "n", "p")
    rest = first.where("hot").groupBy("h", "c").agg(F.sum("m").alias("m"), F.min(F.struct(*KEY, "at", "n", "p")).alias("r"))
    many = asked(texts, rest.select("h", "c", "m", "r.*"), WIDTHS[0])
    # Both in one job, so that the texts are shuffled once: answers of the few, blocks of the many.
    empty = {f.name: F.lit(None).cast(f.dataType) for f in many.schema if f.name not in ("h", "c")}
    both = answered(asked(texts, few)).withColumns(empty).unionByName(many, allowMissingColumns=True)
    found = stored(both.withColumn("block", F.col("bh").isNotNull()), "answers")
    answers = found.where("NOT block").select("h", "c", "b", "e")
    blocks = found.where("block").select("h", "c", "base", "bh", "bc", "m", "lo", "hi", "span")
    if not blocks.isEmpty():
        answers = answers.unionByName(blocks_answered(blocks, WIDTHS[1:]))
    # A span has at most as many ranges as strings.
    return answers.groupBy("h", "c").agg(F.collect_list(F.struct("b", "e")).alias("s"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(did, th, tw, b, e): byte ranges of texts (did, th, tw, data) that repeated strings cover."""
    schema = "h long, c long, did long, th long, tw long, at int, n short, p short"
    anchors, some = (t.mapInArrow(anchor_rows, schema) for t in (texts, sampled(texts)))
    facts = {"k": F.count(F.lit(1)), "c0": F.min("c"), "c1": F.max("c")}
    shared = with_facts(anchors, some, ["h"], facts, "c", [*KEY, "at"]).where("k > 1")
    different = (F.col("c0") != F.col("c1")).alias("open")
    known = stored(
        shared.select(*KEY, "at", "n", "p", "h", "c", "m", "first", different, (F.col("k") > GROUP).alias("hot")), "anchors"
    )
    same = known.where("NOT open").select(*KEY, F.col("at").alias("b"), (F.col("at") + F.col("n") + LENGTH).alias("e"))
    answers = span_answers(texts, known)
    found = known.where("open").select(*KEY, "at", "h", "c").join(answers, ["h", "c"])
    ranges = found.select(*KEY, "at", F.explode("s").alias("r"))
    return same.unionByName(
        ranges.select(*KEY, (F.col("at") + F.col("r.b")).alias("b"), (F.col("at") + F.col("r.e")).alias("e"))
    )


def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts, begins, ends in each_text(batches):
        size, removed, runs, digest = [], [], [], []
        for text, b, e in zip(texts, begins, ends, strict=True):
            b, e = A.merged(b, e)
            kept, last = [], 0
            for x, y in zip(b.tolist(), e.tolist(), strict=True):
                kept.append(text[last:x])
                last = y
            kept.append(text[last:])
            size.append(len(text))
            removed.append(int((e - b).sum()))
            runs.append(len(b))
            digest.append(hashlib.sha256(b"".join(kept)).hexdigest())
        yield record(
            did=batch.column("did"), n_bytes=pa.array(size, pa.int64()), n_removed=pa.array(removed, pa.int64()),
            n_spans=pa.array(runs, pa.int64()), kept_sha256=pa.array(digest, pa.string()),
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = keyed(docs)
    schema = "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = cleaned(texts, repeated_spans(texts), clean_rows, schema)
    return out.select(original_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
