"""Language identification: held-out accuracy, the hierarchy, and what may be learned from."""

import random
import zlib

import numpy as np
import pytest

from emberline.llm import language

SCHEMA = "doc_id long, text string, lang string, source string, score string, h long, letter int"
PARTS = {
    "en": ["the", "and", "ing", "tion", "th", "er", "ou", "of"],
    "de": ["der", "und", "sch", "ung", "keit", "ei", "ch", "über"],
    "fr": ["les", "eau", "ment", "ai", "é", "que", "eux", "ou"],
    "es": ["los", "ción", "ado", "ñ", "que", "as", "ll", "ía"],
    "pt": ["os", "ção", "ado", "nh", "que", "as", "lh", "ão"],
}


def text(r, lang, n):
    return " ".join("".join(r.choice(PARTS[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def rows(n=600):
    r = random.Random(4)
    langs = [r.choice(list(PARTS)) for _ in range(n)]
    return [(k, text(r, lang, r.randrange(3, 120)), lang) for k, lang in enumerate(langs)]


def frame(spark, some):
    return spark.createDataFrame([(i, t, c, "s", "x", 1, 2) for i, t, c in some], SCHEMA).repartition(3)


def out_of_fit(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_rows(spark):
    some = rows()
    got = {r.doc_id: r for r in language.identify(frame(spark, some)).collect()}
    assert len(got) == len(some)
    held = [(got[i], c) for i, _, c in some if out_of_fit(i)]
    assert len(held) > 100 and all(r.held_out for r, _ in held)
    assert sum(r.lang_pred == c for r, c in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([r.score for r, _ in held]) > 0.8


def test_families_hold_related_languages():
    r = random.Random(2)
    texts = [(text(r, lang, 60), lang) for lang in PARTS for _ in range(30)]
    model = language.fit(*map(list, zip(*texts)))
    assert model.languages == sorted(PARTS)
    family = dict(zip(model.languages, model.family.tolist()))
    assert family["es"] == family["pt"] and len(set(family.values())) == 2
    assert (family["es"] == family["pt"]) and all(model.family[a] == model.family[b] for a, b in model.pairs)


def test_nothing_is_learned_from_held_out_rows(spark):
    some = rows(300)
    wrong = [(i, t, "xx" if out_of_fit(i) else c) for i, t, c in some]
    read = lambda x: sorted(tuple(r) for r in language.identify(frame(spark, x)).collect())
    assert read(some) == read(wrong)
    other = [(i, t, c) for i, t, c in some]
    assert sorted(r.lang for r in language.fit_rows(frame(spark, other)).collect()) == sorted(c for i, _, c in some if not out_of_fit(i))


def test_defined_cases(spark):
    some = [*rows(80), (1000, None, "en"), (1001, "", "en"), (1002, "12 !? \n", "en"), (None, "the anding", None), (None, None, None)]
    some += [some[3], some[3], (1003, "der " * 30_000, "de"), (1004, "日本", "ja")]
    got = language.identify(frame(spark, some)).collect()
    assert len(got) == len(some)
    by = {r.doc_id: r for r in got}
    assert all((by[k].lang_pred, by[k].score) == ("und", 0.0) for k in (1000, 1001, 1002))
    assert by[1003].lang_pred == "de" and not [r for r in got if r.doc_id is None and r.held_out]
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == some[3][0]}) == 1
    one = language.identify(frame(spark, [(0, "the", "en"), (1, "und der", None), (2, "9", "de")])).collect()
    assert {r.doc_id: r.lang_pred for r in one} == {0: "en", 1: "en", 2: "und"}
    none = language.identify(frame(spark, [(0, "the", None)])).collect()
    assert none[0].lang_pred == "und"
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_copies_do_not_widen_the_fit(spark):
    some = rows(200) + [(5000 + k, "the and of the and", "en") for k in range(3000)]
    found = language.fit_rows(frame(spark, some), 100).collect()
    assert len(found) <= 100 and len({(r.lang, r.text) for r in found}) == len(found)
    assert {r.lang for r in found} == set(PARTS)


@pytest.mark.parametrize("margin", [0.0, 3.0])
def test_pairs_win_by_margin(margin):
    r = np.random.default_rng(0)
    x = language.with_one(r.normal(size=(200, 3)))
    sign = np.where(x[:, 0] > 0, 1.0, -1.0)
    x[:, 0] += margin * sign
    w = language.fit_svm(x / np.linalg.norm(x, axis=1, keepdims=True), sign)
    assert ((x @ w > 0) == (sign > 0)).mean() > 0.9
