"""Alignment of two vocabularies against plain loops over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from emberline.llm import alignment, wordwise

SCHEMA = "doc_id long, text string, lang string, n_a long, pair long, batch string, index string"


@pytest.fixture(scope="module")
def vocabularies():
    return wordwise.byte_encoder(None, True).vocabulary, wordwise.piece_encoder().vocabulary


def awkward_texts(n=250):
    r = random.Random(9)
    some = ["a", "b", " ", ".", ",", "'s", "the", " the", "1", "23", "\n", "\t", "\r", "\x0b", "É", "ß", "日本", "▁", "\x00", "\x1c", "\xa0", "é"]
    some += ["<|endoftext|>", "<s>", "</s>", "<0x41>", "\n\n", " \n", "  ", "ﬁ", "🙂", "Hello", " tokens", " ", "naïve", "ооо", "كتاب"]
    texts = ["".join(r.choice(some) for _ in range(r.randrange(0, 40))) for _ in range(n)]
    words = ["alpha", "Beta", "gamma's", "delta,", "12345", "naïve", "日本語"]
    texts += [" ".join(r.choice(words) for _ in range(r.randrange(1, 300))) for _ in range(40)]
    return [*texts, None, "", " ", "\n", "x" * 3000, "=" * 700, "one", " ".join(words * 900)]


def plain_tokens(vocabularies, text):
    """Ids and bytes of both token sequences; nothing where they do not spell a space and the text."""
    a, b = vocabularies
    if not text:
        return [], []
    one = a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    two = b.model.encode(text)
    for ids, v in ((one, a), (two, b)):
        if b"".join(v.bytes[i] for i in ids) != (" " + text).encode():
            return [], []
    return one, two


def plain_groups(vocabularies, text):
    one, two = plain_tokens(vocabularies, text)
    ends = lambda ids, v: np.cumsum([len(v.bytes[i]) for i in ids]).tolist()
    x, y = ends(one, vocabularies[0]), ends(two, vocabularies[1])
    groups, i, j = [], 0, 0
    for cut in sorted(set(x) & set(y)):
        p, q = x.index(cut, i) + 1, y.index(cut, j) + 1
        groups.append((one[i:p], two[j:q]))
        i, j = p, q
    return groups


def plain(vocabularies, rows):
    groups = [plain_groups(vocabularies, t) for _, t in rows]
    links = [Counter((a, b) for g in some for a in g[0] for b in g[1]) for some in groups]
    count = Counter(p for found in links for p in found)
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (i, _), some, found in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in some)
        out.append(
            (
                i, sum(len(a) for a, _ in some), sum(len(b) for _, b in some), len(some), sum(found.values()),
                sum(n for p, n in found.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in found.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return Counter(out), count


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, 7, 7, "b", "i") for i, t in rows], SCHEMA).repartition(3)


def test_encoders_equal_the_libraries(vocabularies):
    texts = [t for t in awkward_texts() if t]
    split = wordwise.Split(texts, " ")
    a, b = wordwise.byte_encoder(None, True).encode(split), wordwise.piece_encoder().encode(split)
    for k, t in enumerate(texts):
        assert a.ids[a.at[k] : a.at[k + 1]].tolist() == vocabularies[0].tokenizer.encode(" " + t, add_special_tokens=False).ids, repr(t)
        if "▁" not in t:  # such a text has no tokens anyway
            assert b.ids[b.at[k] : b.at[k + 1]].tolist() == vocabularies[1].model.encode(t), repr(t)
    marked = wordwise.byte_encoder()
    found = marked.encode(wordwise.Split(texts))
    for k, t in enumerate(texts):
        assert found.ids[found.at[k] : found.at[k + 1]].tolist() == marked.vocabulary.whole(t), repr(t)


def test_rows_equal_the_plain_definition(spark, vocabularies):
    rows = list(enumerate(awkward_texts()))
    rows += [(7, rows[7][1]), (None, "naïve text"), (None, None), rows[280], rows[280]]
    want, count = plain(vocabularies, rows)
    got = alignment.align(frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == want
    table = {(r.id_a, r.id_b): r.n for r in alignment.links(frame(spark, rows)).collect()}
    assert table == dict(count)


def test_small_batches_and_lanes_give_the_same(spark, vocabularies, monkeypatch):
    rows = [(k, t) for k, t in enumerate(awkward_texts(60))]
    want, _ = plain(vocabularies, rows)
    texts = [t or "" for _, t in rows]
    whole = alignment.aligned(texts, None, None)
    for lane, links, wide in ((3, 5, 2), (1, 10**6, 10**6)):
        monkeypatch.setattr(alignment, "LINKS", links)
        monkeypatch.setattr(alignment, "WIDE", wide)
        monkeypatch.setattr(alignment.lanes, "__defaults__", (lane,))
        some = alignment.aligned(texts, None, None)
        assert some.groups_a.tolist() == whole.groups_a.tolist() and some.groups_b.tolist() == whole.groups_b.tolist()
        assert [x.tolist() for x in some.counted()] == [x.tolist() for x in whole.counted()]
    assert Counter(whole.written()) == Counter(
        ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain_groups(vocabularies, t)) for t in texts
    )


def test_a_batch_is_aligned_a_slice_at_a_time(vocabularies, monkeypatch):
    texts = [t or "" for t in awkward_texts(60)]
    ids, real, met = pa.array(range(len(texts)), pa.int64()), alignment.aligned, []
    monkeypatch.setattr(alignment, "aligned", lambda some, *a: (met.append(sum(map(len, some))), real(some, *a))[1])
    columns = ["pairs", "held", "docs", "index", "times"]
    answers = []
    for size in (10**9, 200, 1):
        monkeypatch.setattr(alignment, "SLICE", size)
        batch = alignment.one_batch(ids, texts, None, None)
        answers.append([batch.column(c).to_pylist() for c in columns])
    assert answers[0] == answers[1] == answers[2]
    assert len(met) > len(texts) and sorted(met)[-2] <= max(200, *map(len, texts))  # one whole batch, then slices


def test_lockstep_on_given_ends():
    """A: 2 4 | 3 6, B: 4 | 1 3 6, as byte ends from the start of all texts."""
    a, b = np.array([2, 4, 7, 10]), np.array([4, 5, 7, 10])
    one = alignment.lockstep(a, b, np.array([0, 2]), np.array([2, 4]), np.array([0, 1]))
    assert [x.tolist() for x in one] == [[0, 2, 3], [0, 1, 3]]
    none = alignment.lockstep(a[:0], b[:0], *[np.empty(0, np.int64)] * 3)
    assert [x.tolist() for x in none] == [[], []]


def test_empty_table(spark):
    out = alignment.align(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns[0] == "doc_id" and out.columns[-1] == "groups_sha256"
