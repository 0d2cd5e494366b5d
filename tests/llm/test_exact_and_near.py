import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from emberline.llm import components, content_sort, simhash


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check_groups(docs, rows):
    got = content_sort.grouped(docs, "doc_id", "text", F.col("doc_id")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(normal(r[1]), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    want = sorted(
        (str(member[3]), str(min(g)[3]), len(g), hashlib.sha256(n.encode()).hexdigest())
        for n, g in groups.items() for member in g
    )
    assert sorted((str(g.doc_id), str(g.keep_id), g.group_size, g.text_sha256) for g in got) == want
    assert sum(g.kept for g in got) == len(groups)
    assert all(g.doc_id == g.keep_id for g in got if g.kept)


def test_content_sort(docs, rows):
    check_groups(docs, rows)


@pytest.mark.parametrize("own", [None, 7])
def test_a_hot_group_without_ids_is_dealt_out(spark, own, monkeypatch):
    """A third of the rows have one text and no id, or one id: they get many salts, and one of them stays."""
    rows = [(own if k % 3 == 0 else k, "hot text" if k % 3 == 0 else f"text {k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes = []

    def seen(df):
        sizes.append([r["count"] for r in df.where("_salt > 0").groupBy("_salt").count().collect()])
        return cut_lineage(df)

    cut_lineage = content_sort.cut_lineage
    monkeypatch.setattr(content_sort, "cut_lineage", seen)
    check_groups(docs, rows)
    assert sum(sizes[0]) == 300 and len(sizes[0]) > 6 and max(sizes[0]) < 100


def test_content_sort_splits_a_hot_group(spark):
    rows = [(k, "hot text " + " " * (k % 3), None, None, None, None, None, None) for k in range(300)]
    rows += [(1000 + k, f"cold {k % 40}", None, None, None, None, None, None) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, b int, c int, d int, e int, f int")
    assert content_sort.hot_digests(docs, "text", 8).select("_salts").head()[0] > 8
    check_groups(docs, rows)


def test_content_sort_stage(docs, no_docs, rows):
    kept = content_sort.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len({normal(r[1]) for r in rows})
    assert content_sort.keep_first(no_docs).count() == 0


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(rows, monkeypatch):
    want = [brute_print(r[1]) for r in rows]
    assert [int(x) % 2**64 for x in simhash.fingerprints_of([r[1] for r in rows])] == want
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", 50)  # the way of very long texts
    assert [int(x) % 2**64 for x in simhash.fingerprints_of([r[1] for r in rows])] == want


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_bit_planes_count_like_popcount(radius):
    r = np.random.default_rng(radius)
    a = r.integers(0, 2**64, 130, dtype=np.uint64)
    b = np.concatenate([a[:50] ^ np.uint64(0b1111), a[50:90] ^ np.uint64(2**63 + 1), a[:20] ^ np.uint64(0xFF)])
    assert (simhash.within(a, b, radius) == (np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)).all()


def reach(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_links(prints):
    p = sorted(set(prints))
    return [(a, b) for i, a in enumerate(p) for b in p[:i] if bin((a ^ b) % 2**64).count("1") <= 4]


def test_near_duplicates(docs, rows):
    got = simhash.near_duplicates(docs).collect()
    prints = [brute_print(r[1]) for r in rows]
    roots = reach(near_links(prints), set(prints))
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[roots[p]] = min(least.get(roots[p], r[0]), r[0])
    want = sorted((str(r[0]), f"{p:016x}", least.get(roots[p])) for r, p in zip(rows, prints, strict=True))
    assert sorted((str(g.doc_id), g.fingerprint, g.component_id) for g in got) == want


@pytest.mark.parametrize("block", [2048, 8])
def test_links_of_a_crowded_bucket(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "TILE", 16)
    r = random.Random(1)
    centre = r.getrandbits(63)
    prints = [centre ^ sum(1 << b for b in r.sample(range(40, 60), r.randrange(7))) for _ in range(150)] + [
        r.getrandbits(63) for _ in range(50)
    ]
    df = spark.createDataFrame([(p,) for p in set(prints)], "print long")
    got = [(x.u, x.v) for x in simhash.fingerprint_links(df).collect()]
    assert all(bin((a ^ b) % 2**64).count("1") <= 4 for a, b in got)
    assert reach(got, set(prints)) == reach(near_links(prints), set(prints))


def test_near_stage(docs, no_docs):
    kept = simhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 6 in ids and 11 not in ids
    assert simhash.keep_one(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_near_stage_keeps_one_row_of_each_component(spark):
    """Null ids, an id in two components, and equal rows."""
    one, two, three = (" ".join(f"{x}{k}" for k in range(80)) for x in ("a", "b", "c"))
    rows = [(None, one), (None, one), (4, two), (None, two), (4, three), (9, three), (4, three), (None, None), (None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(str, kept)) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in [(None, one), (4, two), (4, three), (None, None)])


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(149, 7), (300, 300), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == reach([x for x in links if x[0] != x[1]], nodes)


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_blocks_are_abandoned_and_masked_pairs_are_never_near(radius, monkeypatch):
    r = np.random.default_rng(radius)
    a = r.integers(0, 2**64, 64, dtype=np.uint64)
    b = np.concatenate((a, r.integers(0, 2**64, 77, dtype=np.uint64)))
    for k in range(20):  # some close ones
        b[64 + k] = a[k] ^ np.uint64(sum(1 << int(x) for x in r.choice(64, k % 8, replace=False)))
    allowed = r.random((64, len(b))) < 0.5
    allowed[np.arange(64), np.arange(64)] = False
    want = (np.bitwise_count(a[:, None] ^ b[None, :]) <= radius) & allowed
    assert (simhash.within(a, b, radius, allowed) == want).all()
    # Random fingerprints that meet themselves: without their own pairs they are soon given up.
    seen = []
    real = simhash.above
    monkeypatch.setattr(simhash, "above", lambda counter, k: (seen.append(counter.shape[1]), real(counter, k))[1])
    off = ~np.eye(64, dtype=bool)
    assert not simhash.within(a, a, radius, off).any()
    assert seen[0] == 64 and min(seen) == 0 and len(seen) < 16 and sum(seen) < 0.7 * 64 * 16
