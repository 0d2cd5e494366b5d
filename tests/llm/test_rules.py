import re

from emberline.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + s for i, w in enumerate(windows) if windows.count(w) > 1 for s in range(3)} if len(words) < 800 else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered) if covered is not None else None,
    )


def test_ledger_equals_brute_force(docs, rows):
    got = rules.apply_policy(rules.build_ledger(docs)).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r[1] for r in rows if r[0] is not None}
    for g in got:
        if g.doc_id is None:
            continue
        want = brute(by_id[g.doc_id])
        have = (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words)
        assert have[:4] == want[:4] and (want[4] is None or have[4] == want[4])
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert not (g.base_failed and g.kept)


def test_junk_goes_and_clean_stays(docs, rows):
    kept = {r.doc_id for r in rules.keep_good(docs).collect()}
    by_text = {r[0]: r[1] or "" for r in rows}
    for k, text in by_text.items():
        if text.startswith(("same line", "word word", "Hi###", "SHOUT")):
            assert k not in kept
    assert {6, 7, 15, 20} <= kept


def test_stage_keeps_the_columns(docs, no_docs):
    assert rules.keep_good(docs).columns == docs.columns
    assert rules.keep_good(no_docs).count() == 0 and rules.build_ledger(no_docs).count() == 0


def test_ablation_equals_counting(docs):
    ledger = rules.build_ledger(docs).cache()
    bits = [r.failed_bits for r in ledger.collect()]
    mask = rules.mask_of(rules.POLICIES["v1"])
    for r in rules.ablation(ledger).collect():
        one = rules.mask_of([r.rule])
        assert r.n_failed == sum(b & one > 0 for b in bits)
        assert r.n_only == sum(b & mask == one for b in bits)
        assert r.n_kept_without == sum(b & mask & ~one == 0 for b in bits)
    assert rules.ablation(ledger.limit(0)).count() == len(rules.POLICIES["v1"])
