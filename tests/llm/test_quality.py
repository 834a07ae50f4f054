"""Quality rules."""

import random

import numpy as np
import pytest

from llm_fixtures import documents  # noqa: F401
from wardlens.llm import quality as q

RNG = random.Random(4)
COMMON, RARE = ["the", "of", "and", "to", "in"], [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]


def _prose(n):
    return " ".join(RNG.choice(COMMON) if RNG.random() < 0.4 else RNG.choice(RARE) for _ in range(n))


def _rows():
    rows = [(i, _prose(80), "en") for i in range(30)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "a b c", None), (103, "same words here again now " * 20, "en"),
             (104, "x\nx\n \n\nx\ny", "en"), (None, _prose(50), "en"), (105, "ÜBER größe naïve " * 4000, "de"), (106, rows[0][1], "en"),
             (106, rows[0][1], "en"), (107, " ".join(f"{w}###" for w in RARE[:80]), "en"), (108, "$%& *** |||| " * 12 + _prose(12), "en")]
    return rows


def _brute(t):
    t = t or ""
    space = " \t\n\x0b\x0c\r"
    words, cur = [], ""
    for c in t + " ":
        if c in space:
            words, cur = words + [cur] * bool(cur), ""
        else:
            cur += c
    seen, dup = set(), 0
    for line in t.split("\n"):
        if any(c not in space for c in line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {g for g in set(grams) if grams.count(g) > 1} if len(grams) < 2000 else {g for g in set(grams)}
    hit = {i + j for i, g in enumerate(grams) if g in twice for j in range(5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed


def test_base_counts_equal_brute_force(documents):
    rows = _rows()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in q.quality_rules(documents(rows)).collect())
    assert got == sorted((str(d), *_brute(t)) for d, t, _ in rows)


def test_verdict_keeps_prose_and_rejects_divergent_text(documents):
    rows = {str(r.doc_id): r for r in q.quality_rules(documents(_rows())).collect()}
    assert all(rows[str(i)].kept for i in range(30)) and rows["None"].kept
    assert not any(rows[str(i)].kept for i in (100, 101, 102, 103, 107, 108))
    assert not rows["107"].base_failed and rows["107"].word_distance > q.MAX_WORD_DISTANCE


def test_filter_agrees_with_the_verdict(documents):
    frame = documents(_rows())
    kept = q.quality_filter(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in q.quality_rules(frame).collect() if r.kept)


def test_distance():
    assert q.js_distance(np.array([1., 0]), np.array([0, 5.])) == pytest.approx(1)
    assert q.js_distance(np.array([2., 4]), np.array([1., 2])) == pytest.approx(0)
    assert q.js_distance(np.zeros(2), np.ones(2)) == 0
    p, r = np.array([.3, .7]), np.array([.6, .4])
    m = (p + r) / 2
    assert q.js_distance(p * 10, r) == pytest.approx(np.sqrt(((p * np.log2(p / m)).sum() + (r * np.log2(r / m)).sum()) / 2))


def test_short_texts_and_small_languages_are_not_judged(documents):
    rows = [(i, _prose(80), "en") for i in range(30)] + [(50, " ".join(f"{w}ää" for w in RARE[:12]), "en")]
    assert {r.doc_id: r for r in q.quality_rules(documents(rows)).collect()}[50].kept
    assert q.divergences(b"text " * 100, [b"text"] * 100, None) == (None, None)


def test_a_small_language_is_judged_whatever_the_rest_holds(documents, monkeypatch):
    """With a share that only the large language reaches, the others (null among them) have joined references."""
    monkeypatch.setattr(q, "LANGUAGE_SHARE", 0.5)
    monkeypatch.setitem(globals(), "RNG", random.Random(4))  # the same prose whatever ran before
    rows = [(i, _prose(80), "en") for i in range(90)]
    rows += [(1000 + i, _prose(80), lang) for i, lang in enumerate(["xx"] * 20 + [None] * 20)]
    rows += [(2000 + i, " ".join(f"{w}###" for w in RARE[:80]), lang) for i, lang in enumerate(["en", "xx", None, "few"])]
    frame = documents(rows)
    got = {r.doc_id: r for r in q.quality_rules(frame).collect()}
    assert len(got) == len(rows)
    assert [r for d, r in got.items() if d < 2000 and not r.kept] == []
    assert not any(got[d].kept for d in (2000, 2001, 2002)) and got[2003].kept
    kept = q.quality_filter(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in got.items() if r.kept)


def test_empty_table(documents):
    assert q.quality_rules(documents([])).count() == 0
    assert q.quality_filter(documents([])).count() == 0
