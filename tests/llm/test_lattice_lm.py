"""Word model and lattice model."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import documents, vocabulary  # noqa: F401
from wardlens.llm import lattice_lm as lm

TEXTS = ["The cat sat on the mat", "the CAT sat again", "a mat\tand\na\x0bcat", None, "", "unseen zyx wörter 日本 \x01", "the the the " * 2000,
         "cat", "cat", "mat sat", "on on on", "again and again", "z" * 3000]


def _rows():
    return [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, "the null id", "en"), (3, "repeated id", "en"), (3, "repeated id", "en")]


def _words(t):
    out, cur = [], ""
    for c in t or "":
        if c in " \t\n\x0b\x0c\r":
            out, cur = out + [cur] * bool(cur), ""
        else:
            cur += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out + [cur] * bool(cur)


def _base(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _, _ in rows]
    count = Counter()
    for (_, t, _), h in zip(rows, held):
        if not h:
            count.update([*_words(t), ("end",)])
    n, v = sum(count.values()), len(count)
    out = []
    for (d, t, _), h in zip(rows, held):
        tokens = [*_words(t), ("end",)]
        out.append((str(d), h, len(tokens), sum(count[x] > 0 for x in tokens), n,
                    sum(math.log10((count[x] + 1) / (n + v + 1)) for x in tokens)))
    return sorted(out)


@pytest.mark.parametrize("share", [1e-6, 0.05])
def test_base_scores_equal_brute_force(documents, vocabulary, monkeypatch, share):
    monkeypatch.setattr(lm, "HEAD_SHARE", share)
    monkeypatch.setattr(lm, "FLUSH", 5)
    got = sorted(tuple(r) for r in lm.lattice_scores(documents(_rows()), vocabulary("piece_bpe_32k.model")).selectExpr(
        "coalesce(string(doc_id), 'None')", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect())
    want = _base(_rows())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)


def test_score_is_the_sum_over_segmentations():
    pieces = {lm.MARK: -1.0, lm.MARK + "a": -1.5, "a": -2.0, "b": -2.5, "ab": -3.0, lm.MARK + "ab": -4.0, "ba": -3.5}
    lattice = lm.Lattice(pieces, None)
    for word in ("a", "ab", "abab", "baab"):
        text, total = lm.MARK + word, 0.0
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            at, parts = 0, []
            for i, c in enumerate(cuts, 1):
                if c:
                    parts, at = [*parts, text[at:i]], i
            parts.append(text[at:])
            if all(p in pieces for p in parts):
                total += math.exp(sum(pieces[p] for p in parts))
        assert lattice.word_log(word) == pytest.approx(math.log(total))
    assert lattice.word_log("q") == -math.inf


def test_piece_shares_are_a_distribution(vocabulary):
    model = lm.load_pieces(vocabulary("piece_bpe_32k.model"))
    logs = lm.prior_logs(model)
    assert np.exp(logs[np.isfinite(logs)]).sum() == pytest.approx(1)
    lattice = lm.build_lattice(model, logs)
    assert lattice.byte_logs is not None and math.isfinite(lattice.word_log("\x01日"))


def test_training_helps_held_out_text(documents, vocabulary):
    text = "quorble snarfle quorble snarfle"
    held = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    train = [(i, text * 40, "en") for i in range(20) if zlib.crc32(str(i).encode()) % 7 != 2]
    score = lambda rows: lm.lattice_scores(documents(rows), vocabulary("piece_bpe_32k.model")).where(f"doc_id = {held}").first().score
    other = [(d, "wholly different material " * 40, "en") for d, _, _ in train]
    assert score([*train, (held, text, "en")]) > score([*other, (held, text, "en")])


def test_empty_table(documents, vocabulary):
    assert lm.lattice_scores(documents([]), vocabulary("piece_bpe_32k.model")).count() == 0
