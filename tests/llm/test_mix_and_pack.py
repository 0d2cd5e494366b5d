import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from emberline.llm import mixing, packing, ranking, wordwise


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights):
    fixed, left = {}, set(range(len(sizes)))
    while True:
        rest = sum(sizes) - sum(fixed.values())
        share = {k: rest * weights[k] / sum(weights[j] for j in left) for k in left}
        over = [k for k in left if share[k] > 3 * sizes[k]]
        if not over:
            return [fixed.get(k, share.get(k)) for k in range(len(sizes))]
        for k in over:
            fixed[k] = 3 * sizes[k]
            left.discard(k)


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    r = random.Random(seed)
    sizes = [r.choice([1, 5, 100, 4000]) * r.randrange(1, 9) for _ in range(r.randrange(1, 9))]
    weights = [(1.0, 2.0, 3.0)[k % 3] for k in range(len(sizes))]
    assert mixing.fitted_targets(sizes, weights) == pytest.approx(brute_targets(sizes, weights))
    assert sum(mixing.fitted_targets(sizes, weights)) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("seed", range(5))
def test_small_sources_are_sampled_like_large_ones(seed):
    """Five hundred lengths once each, a third of the words: short and long documents alike, others with another seed."""
    lengths, counts = np.arange(50, 550), np.ones(500, np.int64)
    budget = int(lengths.sum()) // 3
    take = mixing.fill_budget(lengths, counts, budget, seed)
    assert abs(int((lengths * take).sum()) - budget) <= 1 and take.max() == 1
    mean = (lengths * take).sum() / take.sum()
    assert 270 < mean < 330 and take[:100].sum() > 20 and take[-100:].sum() > 20
    assert (take != mixing.fill_budget(lengths, counts, budget, seed + 100)).sum() > 100


def test_one_very_long_text_among_many_lengths():
    lengths, counts = np.append(np.arange(1, 1001), 400_000), np.append(np.full(1000, 3), 1)
    for budget in (700, 500_000, int((lengths * counts).sum()) - 5):
        take = mixing.fill_budget(lengths, counts, budget)
        assert (take <= counts).all() and abs(int((lengths * take).sum()) - budget) <= 1


@pytest.mark.parametrize("seed", range(30))
def test_last_words_are_the_best_subset(seed):
    r = random.Random(seed)
    lengths = np.array(sorted(r.sample(range(1, 30), 4)))
    left = np.array([r.randrange(0, 4) for _ in lengths])
    budget = r.randrange(0, 90)
    sums = {0}
    for n, c in zip(lengths.tolist(), left.tolist(), strict=True):
        sums = {s + n * k for s in sums for k in range(c + 1)}
    take = mixing.last_words(lengths, left, budget)
    assert (take <= left).all() and abs((take * lengths).sum() - budget) == min(abs(s - budget) for s in sums)


@pytest.mark.parametrize("seed", range(10))
def test_budget_is_met(seed):
    r = random.Random(seed)
    lengths = np.arange(1, 200)
    counts = np.array([r.randrange(0, 50) for _ in lengths])
    total = int((lengths * counts).sum())
    for budget in (0, 1, total // 7, total - 1, total, total + 5):
        take = mixing.fill_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all() and (take * lengths).sum() == min(budget, total)


def test_mix(docs, rows, no_docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and mixing.mix(no_docs).count() == 0
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda g: (str(g.doc_id), g.size, g.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, brute_targets([sizes[s] for s in order], [(1.0, 2.0, 3.0)[k % 3] for k in range(len(order))]), strict=True))
    source_of = {r[0]: r[3] for r in rows}
    taken = dict.fromkeys(order, 0)
    for g in got:
        s = source_of[g.doc_id]
        assert g.source_size == sizes[s] and g.target == pytest.approx(targets[s])
        assert g.taken % max(g.size, 1) == 0 and g.taken <= 3 * g.size
        taken[s] += g.taken
    # The longest document is over half of its source; other sources come within some words.
    longest = {s: max(words(r[1]) for r in rows if r[3] == s) for s in order}
    assert all(abs(taken[s] - targets[s]) <= max(20, longest[s] // 2) for s in order)


def test_mixture_repeats_rows(docs, no_docs):
    got = mixing.mixture(docs)
    assert got.columns == docs.columns and mixing.mixture(no_docs).count() == 0
    total = sum(words(r.text) for r in got.collect())
    assert total == pytest.approx(sum(g.taken for g in mixing.mix(docs).collect()), rel=0.02)


def test_places_are_a_permutation(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id < 2500 THEN 'hot' WHEN id < 2990 THEN 'b' END AS g")
    for cells in (1, 8, 1024):
        placed = ranking.with_place(df, ["g"], [df.id], 3, cells).collect()
        for g in ("hot", "b", None):
            own = [r.place for r in placed if r.g == g]
            assert sorted(own) == list(range(len(own)))


def test_packs_are_the_librarys_ids():
    """Special tokens count as such here; test_alignment covers texts of all kinds."""
    e = wordwise.byte_encoder()
    texts = ["a <|endoftext|> b", "<|endoftext|>", "  x\n\ny", "it'll do", "日本 😀", ""]
    found = e.encode(wordwise.Split(texts))
    ids = [found.ids[a:b].tolist() for a, b in zip(found.at, found.at[1:], strict=False)]
    assert ids == [e.vocabulary.tokenizer.encode(t, add_special_tokens=False).ids for t in texts] and ids[1] == [50256]


def test_memory_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(wordwise, "MEMO", 20)
    e = wordwise.Wordwise(wordwise.byte_encoder().vocabulary)
    r = random.Random(1)
    for _ in range(30):
        texts = [" ".join(str(r.randrange(60)) for _ in range(9)) for _ in range(4)]
        found = e.encode(wordwise.Split(texts))
        assert [found.ids[a:b].tolist() for a, b in zip(found.at, found.at[1:], strict=False)] == [e.vocabulary.whole(t) for t in texts]
        assert len(e.known) <= 40


@pytest.mark.parametrize("seed", range(6))
def test_all_patterns_and_their_least_squares_fit(seed):
    """Every way to fill a sequence with up to three lengths; no repeat count calls for a further step."""
    r = np.random.default_rng(seed)
    room = 40
    histogram = np.append(0, r.integers(0, 60, room) * (r.random(room) < 0.5))
    present = np.nonzero(histogram)[0]
    shapes = packing.patterns(present, room)
    there = set(present.tolist())
    every = {(a, b, room - a - b) for a in there for b in there | {0} if b <= a and 0 <= room - a - b <= b and (room - a - b in there or room == a + b)}
    assert {tuple(s) for s in shapes.tolist()} == every and len(shapes) == len(every)
    x = packing.fit_repeats(shapes, histogram)
    made = np.zeros((len(shapes), room + 1))
    for j, shape in enumerate(shapes.tolist()):
        for n in shape:
            made[j, n] += n > 0
    want = (made @ (histogram - made.T @ x)) / np.maximum((made**2).sum(1), 1)
    enough = packing.TOLERANCE + 1e-9
    assert (x >= 0).all() and (want <= enough).all() and (want[x > 0] >= -enough).all()



@pytest.mark.parametrize("seed", range(12))
def test_plan_uses_the_histogram_up(seed):
    r, room = random.Random(seed), 64
    histogram = np.zeros(room + 1, np.int64)
    for n in r.sample(range(1, room + 1), r.randrange(1, room)):
        histogram[n] = r.choice([1, 2, 30, 500])
    used = np.zeros_like(histogram)
    total = 0
    for shape, n in packing.make_plan(histogram, room):
        assert sum(shape) <= room and n > 0
        total += n
        for length in shape:
            used[length] += n
    assert (used == histogram).all()
    need = -(-int((histogram * np.arange(room + 1)).sum()) // room)
    assert need <= total <= 1.05 * sum(n for _, n in packing.best_fit(histogram, room)) + 2


@pytest.mark.parametrize("room", [2048, 64])
def test_pack(docs, rows, no_docs, room):
    got = packing.pack(docs, room=room).collect()
    assert packing.pack(no_docs, room=room).count() == 0
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in rows:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        cut = len(ids) % room or room if len(ids) > room else len(ids)
        starts = [0, *range(cut, len(ids), room)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((str(r[0]), k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted((str(g.doc_id), g.piece, g.start, g.length, g.ids_crc32) for g in got) == sorted(want)
    by_sequence = {}
    for g in got:
        by_sequence.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    assert len(by_sequence) <= -(-sum(g.length for g in got) // room) * 1.2 + 1
