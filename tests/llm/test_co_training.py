import random
import zlib

import numpy as np
import pytest

from emberline.llm import co_training


def toy(n, seed):
    """Content and metadata both tell quality, each with its own errors."""
    r = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        good = r.random() < 0.7
        words = [r.choice(["the", "of", "alpha", "beta", "gamma", "delta"]) for _ in range(r.randrange(30, 90))]
        text = " ".join(words) + "." if good else " ".join(w + "###" for w in words)
        source = r.choice(["press", "books"]) if good == (r.random() < 0.9) else r.choice(["mill", "farm"])
        rows.append((k, text, "en", source, len(text), int(good), 0.5))
        if r.random() < 0.5:
            labels.append((k, int(good), 0))
    return rows, labels


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = toy(900, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int, score double")
    return rows, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_held_out_accuracy_and_exchange(data):
    rows, docs, labels, _ = data
    model = co_training.fit(docs, labels)
    assert sum(a + b for a, b in model.handed) > 0 and any(a for a, _ in model.handed)
    got = co_training.score(docs, model).collect()
    truth = {r[0]: r[5] for r in rows}
    held = [g for g in got if g.held_out]
    assert len(got) == len(rows) and np.mean([g.predicted == truth[g.doc_id] for g in held]) > 0.97
    assert np.mean([(g.metadata_score >= 0.5) == truth[g.doc_id] for g in held]) > 0.8
    assert all(0 <= g.score <= 1 and g.kept == (g.score >= 0.5) for g in got)


def test_held_out_labels_are_not_read(data, spark):
    _, docs, labels, marks = data
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in marks]
    key = lambda df: sorted((g.doc_id, g.score) for g in df.collect())
    other = spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")
    assert key(co_training.quality(docs, labels)) == key(co_training.quality(docs, other))


def test_calibration_is_monotone_and_logistic_fits():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 1))
    y = (r.random(4000) < co_training.share(2 * x[:, 0] - 1)).astype(float)
    w = co_training.logistic(np.column_stack([np.ones(4000), x]), y, np.ones(4000), 1e-6)
    assert w == pytest.approx([-1, 2], abs=0.2)


def test_awkward_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(6, 1, 0), (7, None, 1), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    got = co_training.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(g.score == 0.5 and g.kept for g in got)
    many = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    assert len(co_training.quality(docs, many).collect()) == len(rows)
    assert co_training.quality(no_docs, labels).count() == 0


def test_a_weak_view_hands_over_too_and_no_weight_is_negative():
    """Six in seven documents are good; the metadata tell some of the bad ones, and never more than that."""
    r = np.random.default_rng(5)
    y = (r.random(6000) < 0.86).astype(float)
    content = np.concatenate((y[:, None] + 0.3 * r.normal(size=(6000, 1)), r.normal(size=(6000, 9))), 1)
    source = np.where(y == 1, r.integers(0, 30, 6000), np.where(r.random(6000) < 0.3, 40, r.integers(0, 30, 6000)))
    metadata = np.stack((r.integers(0, 4, 6000), source, r.normal(size=6000)), 1).astype(float)
    views = lambda rows: [content[rows], metadata[rows]]
    model = co_training.co_train(views(slice(0, 2000)), y[:2000], views(slice(2000, 6000)))
    assert sum(a for a, _ in model.handed) > 0 and sum(b for _, b in model.handed) > 0
    assert (model.mix[1:] >= 0).all() and model.mix[1] > 0
    bad = co_training.mixed_views(np.stack((2 * y - 1, 1 - 2 * y + r.normal(size=6000)), 1), y)
    assert bad[2] >= 0 and bad[1] > 0
    none = co_training.mixed_views(np.stack((1 - 2 * y, 1 - 2 * y), 1), y)
    assert none[1:].tolist() == [0, 0] and none[0] == pytest.approx(np.log(y.mean() / (1 - y.mean())), abs=0.01)
