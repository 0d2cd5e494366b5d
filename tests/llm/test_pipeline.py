"""Every stage of the pipeline against a brute-force version, each on what the stage before has kept."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_exact_and_near import brute_print, near_links, normal, reach
from test_mix_and_pack import brute_targets, words
from test_rules import brute
from tokenizers import Tokenizer

import corpus_pipeline


def keeps(text):
    n, chars, symbols, dup, repeat = brute(text)
    if n >= 800:  # beyond the quadratic count: these texts have hardly a repeated window
        repeat = 0
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    upper = sum(c.isupper() for c in text or "")
    return not (
        n < 50 or 100 * repeat > 50 * n or 10 * symbols > n or 10 * dup > 4 * len(lines) or 10 * upper > 3 * chars
        or chars < 2 * n or chars > 12 * n
    )


@pytest.fixture(scope="module")
def stages(spark, rows, schema, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, schema).select("doc_id", "text", "lang", "source", "n_chars").repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    out = {"": docs.collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, now, folder).write.parquet(path)
        now = spark.read.parquet(path)
        out[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    return folder, out


def test_rules_stage(stages):
    _, out = stages
    assert Counter(out["quality_rules"]) == Counter(r for r in out[""] if keeps(r.text))


def test_exact_stage(stages):
    _, out = stages
    groups = {}
    for r in out["quality_rules"]:
        groups.setdefault(normal(r.text), []).append((-len(r.text), r.doc_id is None, r.doc_id or 0, r))
    want = Counter((min(g, key=lambda x: x[:3])[3].doc_id, n) for n, g in groups.items())
    assert Counter((r.doc_id, normal(r.text)) for r in out["exact_dedup"]) == want


def test_near_stage(stages):
    _, out = stages
    docs = out["exact_dedup"]
    prints = {r.doc_id: brute_print(r.text) for r in docs}
    roots = reach(near_links(prints.values()), set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(least.get(roots[p], i), i)
    assert sorted(r.doc_id for r in out["simhash_near_dedup"]) == sorted(least.values())


def test_mixing_stage(stages):
    _, out = stages
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in out["simhash_near_dedup"]:
        sizes[r.source] += words(r.text)
        longest[r.source] = max(longest[r.source], words(r.text))
    for r in out["mixing"]:
        taken[r.source] += words(r.text)
    assert set(out["mixing"]) <= set(out["simhash_near_dedup"]) and max(Counter(out["mixing"]).values()) <= 3
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = brute_targets([sizes[s] for s in order], [(1.0, 2.0, 3.0)[k % 3] for k in range(len(order))])
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 for s, t in zip(order, targets, strict=True))


def test_packing_stage(stages):
    _, out = stages
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = Counter()
    for r in out["mixing"]:
        total[r.doc_id] += len(t.encode(r.text, add_special_tokens=False).ids) + 1
    packed, by_sequence = Counter(), {}
    for p in out["packing"]:
        packed[p.doc_id] += p.length
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert packed == total
    for own in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert ends[-1] <= 2048 and [o for o, _ in sorted(own)] == [0, *ends[:-1].tolist()]


def test_run_is_the_stages(stages, spark):
    folder, out = stages
    got = corpus_pipeline.run(spark, folder)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, got.collect())) == Counter(map(key, out["packing"]))
    assert got.count() == len(out["packing"]) > 0
