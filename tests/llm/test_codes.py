"""Product codes against plain loops, and Orchard's search against looking at every entry."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from emberline.llm import orchard

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def plain(rows, entries=256, rounds=4):
    """The whole definition, one vector after another."""
    kept = [(i, [math.floor(1024 * np.float32(x).item()) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, None
    width = -(-max(max(len(v) for _, v, _ in kept), 1) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), c) for i, v, c in kept]
    parts = lambda v: [tuple(v[k * width : (k + 1) * width]) for k in range(4)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[parts(v)[k] for _, v, _ in first] for k in range(4)]
    nearest = lambda p, book: min((sum((a - b) ** 2 for a, b in zip(p, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        new = []
        for k in range(4):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(parts(v)[k], books[k])[1]].append(parts(v)[k])
            new.append([tuple(sum(c) // len(members[j]) for c in zip(*members[j])) if j in members else e for j, e in enumerate(books[k])])
        books = new
    out = []
    for i, v, c in kept:
        found = [nearest(p, book) for p, book in zip(parts(v), books)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), c))
    by_label = Counter()
    for _, _, e, c in out:
        by_label[c] += e
    text = ",".join(str(x) for book in books for e in book for x in e)
    return Counter((i, code, e, by_label[c]) for i, code, e, c in out), hashlib.sha256(text.encode()).hexdigest()


def vectors():
    r = np.random.default_rng(3)
    rows = [(int(k), [float(x) for x in r.normal(0, 0.2, 8).astype(np.float32)], int(k) % 3) for k in r.permutation(400)]
    rows += [rows[5], rows[5], (1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, 2), (1003, [float("inf")] + [0.0] * 7, 2)]
    rows += [(None, [0.1] * 8, None), (None, [-0.1] * 8, None), (1004, [0.5] * 6, None), (1005, [], 0), (1, [0.25] * 8, 0), (1006, [0.0] * 8, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def test_codes_equal_the_plain_definition(spark):
    want, digest = plain(vectors())
    got = orchard.compress(frame(spark, vectors())).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_fewer_rows_than_entries_and_none(spark):
    some = vectors()[:7]
    want, digest = plain(some)
    got = orchard.compress(frame(spark, some)).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want and got[0].codebooks_sha256 == digest
    for rows in ([], [(1, None, 1)]):
        out = orchard.compress(frame(spark, rows))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0


@pytest.mark.parametrize("scale", [3, 1000, 1 << 26])
def test_search_finds_the_nearest_and_the_lower_of_ties(scale):
    r = np.random.default_rng(scale)
    entries = r.integers(-scale, scale + 1, (64, 4))
    entries[40] = entries[7]
    points = np.concatenate((r.integers(-scale, scale + 1, (500, 4)), entries))
    at, far = orchard.Orchard(entries).search(points)
    apart = ((points[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert at.tolist() == [min(range(64), key=lambda j: (row[j], j)) for row in apart]
    assert far.tolist() == [min(row) for row in apart]


def test_search_looks_at_few_entries_of_clusters():
    """The lists end early: near a cluster's entry hardly any other entry is looked at."""
    r = np.random.default_rng(1)
    centres = r.normal(0, 10_000, (200, 4)).astype(np.int64)
    points = np.repeat(centres, 5, 0) + r.integers(-20, 20, (1000, 4))
    searched = orchard.Orchard(centres)
    looked = []
    real = orchard.squared
    orchard.squared = lambda x: (looked.append(len(x)), real(x))[1]
    try:
        at, _ = searched.search(points)
    finally:
        orchard.squared = real
    assert at.tolist() == np.repeat(np.arange(200), 5).tolist()
    assert sum(looked) < 0.5 * len(points) * len(centres)


def test_large_components_are_held(spark):
    got = orchard.compress(frame(spark, [(1, [3e38] * 4, 0), (2, [-3e38] * 4, 0), (3, [0.0] * 4, None)])).collect()
    assert len(got) == 3 and all(r.error == 0 for r in got)
    assert isinstance(orchard.whole_vectors(frame(spark, vectors())).schema["v"].dataType, T.ArrayType)
