import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from emberline.llm import anchors, factors, repeats, spans
from emberline.llm.spans import NO_ID


def clean_words(rows, n=13):
    texts = [(NO_ID if r[0] is None else r[0], (r[1] or "").encode().split()) for r in rows]
    first = {}
    for i, w in texts:
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in texts:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = True
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((str(None if i == NO_ID else i), len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def clean_bytes(rows, n=200):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    count = {}
    for _, t in texts:
        for k in range(len(t) - n + 1):
            count[t[k : k + n]] = count.get(t[k : k + n], 0) + 1
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if count[t[k : k + n]] > 1:
                gone[k : k + n] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((str(i), len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_words(df):
    return sorted((str(g.doc_id), g.n_words, g.n_removed, g.kept_sha256) for g in factors.remove_duplicates(df).collect())


def got_bytes(df):
    return sorted(
        (str(g.doc_id), g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in repeats.remove_repeats(df).collect()
    )


@pytest.mark.parametrize("unit", [60, 1_000_000])
@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh"])
def test_every_window_has_its_smallest_rightmost_gram(unit, alphabet, monkeypatch):
    monkeypatch.setattr(anchors, "UNITS", unit)
    r = random.Random(unit)
    texts = [bytes(r.choice(alphabet) for _ in range(r.choice([0, 3, 30, 31, 200]))) for _ in range(20)] + [b"a" * 80]
    data, starts = anchors.joined_bytes(texts)
    grams = anchors.gram_hashes(anchors.Prefixes(data.astype(np.uint64)), len(data), 8)
    found, seen = anchors.find(grams, starts, 30, 8), set()
    for doc, place, first, last in zip(found.doc, found.place, found.first, found.last, strict=True):
        for w in range(first, last + 1):
            assert starts[doc] <= w and w + 30 <= starts[doc + 1] and (doc, w) not in seen
            seen.add((doc, w))
            keys = [int(x) >> anchors.PLACE_BITS for x in grams[w : w + 23]]
            assert place == w + max(i for i, x in enumerate(keys) if x == min(keys))
    assert len(seen) == sum(max(0, len(t) - 29) for t in texts)


def test_range_hashes_depend_on_content_only():
    data = np.frombuffer(b"xxabcabcabc\0\0\0", np.uint8).astype(np.uint64)
    h = anchors.Prefixes(data)
    at = lambda a, b: int(h.ranges(np.array([a]), np.array([b]))[0])
    assert at(2, 5) == at(5, 8) == at(8, 11) and at(2, 5) != at(3, 6)
    assert at(11, 12) != at(11, 13) != at(11, 14)


def test_word_factors(docs, rows, no_docs):
    assert got_words(docs) == clean_words(rows)
    assert got_words(no_docs) == []


@pytest.mark.parametrize("group", [0, 1, 3, 2000])
def test_byte_repeats(docs, rows, no_docs, group, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", group)
    assert got_bytes(docs) == clean_bytes(rows)
    assert got_bytes(no_docs) == []


@pytest.mark.parametrize(("seed", "group"), [(0, 1000), (1, 1000), (2, 1000), (0, 2), (1, 5), (2, 0)])
def test_random_texts_with_shared_passages(spark, seed, group, monkeypatch):
    """Shared passages at random cuts, within and across texts, periodic texts and bytes of zero; blocks of all widths."""
    monkeypatch.setattr(repeats, "GROUP", group)
    r = random.Random(seed)
    letters = [" ", "a", "b", "é", "\0", "c d", "\n"]
    some = lambda n: "".join(r.choice(letters) for _ in range(n))
    pool = [some(500) for _ in range(3)] + ["ab " * 150, "\0" * 400]
    rows = []
    for k in range(30):
        text = some(r.randrange(80))
        for _ in range(r.randrange(3)):
            p = r.choice(pool)
            a = r.randrange(len(p))
            text += p[a : a + r.choice([90, 190, 199, 200, 201, 320])] + some(r.randrange(60))
        rows.append((k, text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_bytes(df) == clean_bytes(rows)
    assert got_words(df) == clean_words(rows)


def brute_maximal(texts, least):
    places = {}
    for t, s in enumerate(texts):
        for a in range(len(s)):
            for b in range(a + least, len(s) + 1):
                places.setdefault(s[a:b], []).append((t, a))
    out = []
    for s, at in places.items():
        before = {texts[t][a - 1] if a else (t, "start") for t, a in at}
        after = {texts[t][a + len(s)] if a + len(s) < len(texts[t]) else (t, "end") for t, a in at}
        if len(at) > 1 and len(before) > 1 and len(after) > 1:
            out.append((s, sorted(at)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(15))
def test_maximal_repeats_with_all_occurrences(seed):
    r = random.Random(seed)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randrange(25))) for _ in range(5)]
    assert repeats.maximal_repeats(texts, 3) == brute_maximal(texts, 3)


def test_factors_are_greedy_runs(spark):
    words = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(words[:40])), (2, " ".join(words[30:])), (3, "x " + " ".join(words) + " y")]
    texts = spans.keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((f.did, f.b, f.e, f.ref, f.place) for f in factors.factors(texts).collect())
    # Words 0-39 are in document 1, words 30-79 in document 2; windows from 28 on are only in the second.
    assert got == [(3, 1, 41, 1, 0), (3, 31, 81, 2, 0)]


def test_every_factor_stands_in_its_reference(spark, rows):
    """Also where a reference has the two halves of a run at different places, or in two texts of one id."""
    w = [f"p{k}" for k in range(40)]
    halves = " ".join(w[:13]) + " x " + " ".join(w[1:14])
    more = [(2000, halves), (2001, " ".join(w[:14])), (2002, " ".join(w[5:30])), (2002, " ".join(w[15:40])), (2003, " ".join(w * 2))]
    some = [(r[0], r[1]) for r in rows] + more
    texts = spans.keyed(spark.createDataFrame(some, "doc_id long, text string"))
    found = factors.factors(texts).collect()
    words = {}
    for r in texts.collect():
        words.setdefault(r.did, {})[r.th] = bytes(r.data).split()
    assert len(found) > 10 and all(f.e - f.b >= 13 and f.ref < f.did for f in found)
    for f in found:
        own = words[f.did][f.th][f.b : f.e]
        assert any(t[f.place : f.place + len(own)] == own for t in words[f.ref].values())
    assert sorted((f.b, f.e, f.ref, f.place) for f in found if f.did == 2001) == [(0, 13, 2000, 0), (1, 14, 2000, 14)]


def test_long_words_that_polynomials_mix_up(spark):
    """Two words of 1,024 letters that are equal under any polynomial hash modulo 2^64 (Thue and Morse)."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    same = [f"w{k}" for k in range(12)]
    rows = [(1, " ".join([*same, one])), (2, " ".join([*same, two])), (3, " ".join([*same, one]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_words(df) == clean_words(rows)
    assert {r.doc_id: r.n_removed for r in factors.remove_duplicates(df).collect()} == {1: 0, 2: 0, 3: 13}


def test_facts_of_hot_anchors(spark):
    """A value with a third of the rows is dealt over tasks and still gets the facts of all its rows."""
    from pyspark.sql import functions as F

    rows = [(7 if k % 3 == 0 else k, k, k % 5, k % 11) for k in range(6000)]
    df = spark.createDataFrame(rows, "h long, did long, th int, c int")
    facts = {"k": F.count(F.lit(1)), "low": F.min("c")}
    got = spans.with_facts(df, df.where("did % 4 = 0"), ["h"], facts)
    by_h = {}
    for h, *_, c in rows:
        by_h.setdefault(h, []).append(c)
    out = got.withColumn("task", F.spark_partition_id()).collect()
    assert len(out) == len(rows) and all((r.k, r.low) == (len(by_h[r.h]), min(by_h[r.h])) for r in out)


@pytest.fixture
def one_id_rows():
    """Many texts with one id, half of them with a passage that repeats: a short hash would mix them up."""
    r = random.Random(11)
    some = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.randrange(10**9)}" for _ in range(n))
    passage = some(24)
    texts = [some(3) + " " + passage + " " + some(4) if k % 2 else some(30) for k in range(3000)]
    return texts, passage


def test_many_rows_with_one_id(spark, one_id_rows):
    texts, passage = one_id_rows
    rows = [(5, t) for t in texts] + [(1, "x " + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_words(df) == clean_words(rows)


def test_many_rows_without_an_id(spark, one_id_rows):
    texts, _ = one_id_rows
    rows = [(None, t) for t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_bytes(df) == clean_bytes(rows)


def test_equal_rows_do_not_multiply(spark):
    """Equal rows share a key; what is gathered under it does not grow with their number."""
    words = [f"word{k}" for k in range(60)]
    rows = [(7, " ".join(words))] * 40 + [(3, "y " + " ".join(words[5:50]) + " z")]
    texts = spans.keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    for found in (spans.per_text(repeats.repeated_spans(texts)), spans.per_text(factors.factors(texts))):
        sizes = {r.did: (len(r.b), len(set(zip(r.b, r.e, strict=True)))) for r in found.collect()}
        assert sizes and all(n == distinct for n, distinct in sizes.values())
    assert got_words(spark.createDataFrame(rows, "doc_id long, text string")) == clean_words(rows)


def test_workers_hold_few_bytes_at_a_time(monkeypatch):
    """Of a large batch of spans only some are gathered, and only some text is turned into arrays; the answers stay."""
    r = random.Random(4)
    spans_of = [(k // 2, k, 1, bytes(r.choices(b"ab", k=20)) * 12) for k in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*spans_of, strict=True)], names=["h", "c", "m", "span"])
    texts = [bytes(r.choices(b"abc", k=n)) for n in (0, 900, 250, 5000, 199, 700)]
    keys = pa.array(range(len(texts)), pa.int64())
    docs = pa.RecordBatch.from_arrays([keys, keys, keys, pa.array(texts, pa.binary())], names=["did", "th", "tw", "data"])
    met, real, joined = [], repeats.repeated_ranges, anchors.joined_bytes
    monkeypatch.setattr(repeats, "repeated_ranges", lambda some, *a: (met.append(sum(map(len, some))), real(some, *a))[1])
    answers = lambda: pa.Table.from_batches(list(repeats.group_rows(iter([batch])))).to_pylist()
    found = lambda: pa.Table.from_batches(list(repeats.anchor_rows(iter([docs])))).to_pylist()
    want, places = answers(), found()
    monkeypatch.setattr(repeats, "SPAN_BYTES", 10_000)
    monkeypatch.setattr(repeats, "SPAN_ROWS", 20)
    monkeypatch.setattr(repeats, "AT_ONCE", 1000)
    met.clear()
    assert answers() == want and want and max(met) <= 10_000 + 20 * 240
    monkeypatch.setattr(anchors, "joined_bytes", lambda some: (met.append(sum(map(len, some))), joined(some))[1])
    met.clear()
    assert found() == places and max(met) == 5000 and len(met) > 2
