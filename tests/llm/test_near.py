"""Components, near links, ProbMinHash and paragraph clusters."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import documents  # noqa: F401
from wardlens.llm import minhash, near_links, paragraphs
from wardlens.llm.components import connected_components
from wardlens.llm.shingles import pack_set, shingle_hashes, shingle_words, word_hashes


def _union(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "odd"])
def test_components(spark, kind):
    rng = random.Random(1)
    links = {"random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)], "chain": [(i, i + 1) for i in range(70)],
             "star": [(500, i) for i in range(80)], "odd": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (5, None)]}[kind]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == _union({x for e in real for x in e}, real)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _sets(spark, groups):
    rows = []
    for uid, (items, reps) in groups.items():
        order = np.argsort(items)
        rows.append((uid, np.array(items, "<u4")[order].tobytes(), b"" if reps is None else np.array(reps, "<u4")[order].tobytes()))
    return spark.createDataFrame(rows, "uid long, items binary, reps binary")


def test_every_link_in_one_bucket_is_found(spark):
    """All items share one band; components must equal those of all pairs."""
    rng = random.Random(9)
    groups = {}
    for g in range(5):
        base = [1000 * g + i for i in range(40)]
        for k in range(14):
            drop = set(rng.sample(range(40), rng.choice([0, 2, 4, 7, 9, 12])))
            items = [x for i, x in enumerate(base) if i not in drop] + [10_000 + 1000 * g + 50 * k + i for i in range(len(drop) * (k % 2))]
            groups[100 * g + k] = (items, None if k % 3 else [1 + (x % 2) for x in items])
    arrays = {u: (np.sort(np.array(i)), None if w is None else np.array(w)[np.argsort(i)]) for u, (i, w) in groups.items()}
    links = [(a, b) for a in groups for b in groups if a < b and near_links.similarity(*arrays[a], *arrays[b]) >= 0.8]
    keyed = spark.createDataFrame([(u, [7]) for u in groups], "uid long, keys array<long>")
    got = {r.node: r.root for r in near_links.near_components(keyed, _sets(spark, groups), 0.8).collect()}
    want = _union(groups, links)
    parts = lambda m: {frozenset(k for k, v in m.items() if v == r) for r in set(m.values())}
    assert parts({u: got.get(u, u) for u in groups}) == parts(want)


def test_probability_jaccard_equals_its_definition():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 12, rng.integers(1, 12))) for _ in range(2))
        wa, wb = rng.integers(1, 6, len(a)), rng.integers(1, 6, len(b))
        x, y = np.zeros(12), np.zeros(12)
        x[a], y[b] = wa / wa.sum(), wb / wb.sum()
        want = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(12)) for i in range(12) if x[i] and y[i])
        assert near_links.probability_jaccard(a, wa, b, wb) == pytest.approx(want)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(8)
    m, agree, want = 400, [], []
    for n in (6, 60, 900):
        elements = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = elements[:int(1.5 * n)], elements[int(0.5 * n):]
        wa, wb = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
        agree.append((minhash.probminhash(a, wa, m) == minhash.probminhash(b, wb, m)).mean())
        oa, ob = np.argsort(a), np.argsort(b)
        want.append(near_links.probability_jaccard(a[oa], wa[oa], b[ob], wb[ob]))
    assert agree == pytest.approx(want, abs=0.09)
    assert len(minhash.probminhash(np.zeros(0, np.uint64), np.zeros(0))) == 0


def test_early_end_gives_the_same_signature_as_no_early_end():
    rng = np.random.default_rng(2)
    elements, weights, m = rng.integers(0, 2**63, 30).astype(np.uint64), rng.integers(1, 5, 30), 20
    t, c = minhash._arrivals(elements, weights.astype(float), np.zeros(30), 0, 400, m)
    want = [elements[np.unravel_index(np.where(c == k, t, np.inf).argmin(), t.shape)[0]] for k in range(m)]
    assert list(minhash.probminhash(elements, weights, m)) == want


def _text_sets(text):
    items, reps = pack_set(shingle_hashes(word_hashes(shingle_words(text.encode()))))
    return np.frombuffer(items, "<u4"), np.frombuffer(reps, "<u4") if reps else None


def _corpus():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows, k = [], 0
    for _ in range(6):
        base = text(120)
        for change in (0, 0, 1, 2, 3, 6, 12, 25):
            copy = list(base)
            for i in rng.sample(range(120), change):
                copy[i] = f"new{rng.randrange(10**6)}"
            rows.append((k, " ".join(copy), "en"))
            k += 1
    rows += [(300 + i, " ".join(text(60)), "en") for i in range(20)]
    rows += [(400, None, "en"), (401, "", None), (402, "two words", "en"), (403, "Two, words!", "en"), (None, "no id at all", "en"),
             (404, " ".join(text(30_000)), "en"), (405, "loop " * 500, "en"), (406, "loop " * 900, "en"), (407, rows[0][1], "en"), (407, rows[0][1], "en")]
    return rows


def _classes(rows):
    texts = sorted({t or "" for _, t, _ in rows})
    sets = {t: _text_sets(t) for t in texts}
    links = [(a, b) for i, a in enumerate(texts) for b in texts[:i] if near_links.similarity(*sets[a], *sets[b]) >= 0.8]
    root = _union(texts, links)
    return {t: root[t] for t in texts}


def test_near_duplicate_classes_equal_brute_force(documents):
    rows = _corpus()
    root = _classes(rows)
    ids = defaultdict(list)
    for d, t, _ in rows:
        ids[root[t or ""]].append(d)
    least = {r: min(v, key=lambda d: (d is not None, d or 0)) for r, v in ids.items()}
    got = minhash.duplicate_classes(documents(rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in got) == sorted(
        (str(d), str(least[root[t or ""]]), len(ids[root[t or ""]])) for d, t, _ in rows)
    assert len({(r.class_id) for r in got if r.kept}) == len(ids)
    frame = documents(rows)
    kept = minhash.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(str(d) for d in least.values())


def test_repeated_rows_leave_one(documents):
    assert minhash.keep_one_of_each(documents([(1, "same row", "en")] * 5)).count() == 1
    assert minhash.keep_one_of_each(documents([])).count() == 0
    assert minhash.duplicate_classes(documents([])).count() == 0


def test_a_pasted_line_does_not_hide_a_near_copy(documents):
    rng = random.Random(21)
    rows = []
    for k in range(8):
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(204))
        line = " ".join(f"x{rng.randrange(10**6)}" for _ in range(10))
        rows += [(2 * k, base, "en"), (2 * k + 1, "\n".join([base, *[line] * 50]), "en")]
    assert sorted((r.doc_id, r.class_id) for r in minhash.duplicate_classes(documents(rows)).collect()) == [
        (i, i - i % 2) for i in range(16)]


def test_bands_are_tuned_for_recall():
    for threshold, recall in ((0.8, 0.998), (0.5, 0.99), (0.9, 0.9999)):
        bands, rows = paragraphs.tune_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall
        assert 1 - (1 - threshold ** (rows + 1)) ** bands < recall


def test_paragraphs_cover_the_text():
    text = "Short. A sentence of more than eight words starts here now. Ok! Another one that has at least eight words in it?\n\nlast line"
    parts = [text[a:b] for a, b in paragraphs.split_paragraphs(text)]
    assert "".join(parts) == text.replace("\n", "")
    assert parts[0] == "Short. " and parts[1].startswith("A sentence") and parts[1].endswith("Ok! ")


def _sentence(rng, n):
    return " ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) + str(rng.randrange(900)) for _ in range(n)).capitalize() + "."


def test_repeated_paragraphs_equal_brute_force(documents):
    rng = random.Random(13)
    shared = [_sentence(rng, 60), _sentence(rng, 15), _sentence(rng, 40)]
    near = shared[2].split()
    near[20] = "changed"
    rows = []
    for i in range(24):
        body = [_sentence(rng, rng.choice([4, 9, 20, 30])) for _ in range(6)]
        if i % 3 == 0:
            body.insert(rng.randrange(6), shared[i // 3 % 2])
        if i in (5, 11):
            body.insert(2, shared[2] if i == 5 else " ".join(near))
        rows.append((i, rng.choice([" ", "\n"]).join(body), "en"))
    inner = _sentence(rng, 30)
    rows += [(40, f"{inner}\n{inner}", "en"), (41, None, None), (42, "", "en"), (None, shared[1], "en"), (43, rows[0][1], "en"), (43, rows[0][1], "en")]
    units = []
    for d, t, _ in set(rows):
        for k, (a, b) in enumerate(paragraphs.split_paragraphs(t or "")):
            words = shingle_words((t or "")[a:b].encode())
            if len(words) >= paragraphs.MIN_WORDS:
                units.append((d, k, a, b, t, frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)), tuple(words)))
    links = [(i, j) for i, x in enumerate(units) for j, y in enumerate(units[:i]) if len(x[5] & y[5]) / len(x[5] | y[5]) >= 0.8]
    root, members = _union(range(len(units)), links), defaultdict(list)
    for i, r in root.items():
        members[r].append(units[i])
    want = {(str(u[0]), u[1], u[2], u[3]) for m in members.values() if len({(u[0], u[4]) for u in m}) > 1 for u in m}
    frame = documents(rows)
    found = paragraphs.repeated_paragraphs(frame)
    got = found.collect()
    assert {(str(r.doc_id), r.paragraph, r.start, r.end) for r in got} == want
    kept = Counter(r.cluster for r in got if not r.removed)
    assert set(kept) == {r.cluster for r in got} and all(v >= 1 for v in kept.values())
    cut = paragraphs.without_removed(frame, found)
    assert cut.columns == frame.columns
    texts = {str(r.doc_id): r.text for r in cut.collect()}
    assert texts["41"] is None and texts["40"] == rows[24][1]
    gone = {(str(r.doc_id), r.start, r.end) for r in got if r.removed}
    for d, t, _ in rows:
        spans = [(a, b) for e, a, b in gone if e == str(d)]
        assert texts[str(d)] == (None if t is None else "".join(c for i, c in enumerate(t) if not any(a <= i < b for a, b in spans)))


def test_no_paragraphs(documents):
    assert paragraphs.repeated_paragraphs(documents([])).count() == 0
    assert paragraphs.repeated_paragraphs(documents([(1, None, "en"), (2, "short", "en")])).count() == 0


def test_one_bucket_gives_the_components_of_all_pairs(spark):
    """All sets share one band key: the rounds over rare items must find every component, exact thresholds included."""
    rnd = random.Random(5)
    common = list(range(1000, 1030))
    sets = [[1, 2, 3, 4, 5], [1, 2, 3, 4], [6, 7, 8, 9], [6, 7, 8, 9, 10], []]
    for group in range(12):
        base = common + rnd.sample(range(2000, 9000), 30)
        for _ in range(4):
            sets.append([x for x in base if rnd.random() > 0.08] + rnd.sample(range(10_000, 20_000), rnd.choice((0, 2, 6))))
    rows, facts = [], []
    for uid, items in enumerate(sets):
        x = np.unique(np.array(items, "<u4"))
        w = np.array([rnd.choice((1, 1, 1, 4)) for _ in x], "<u4") if uid % 3 == 0 else None
        facts.append((x, w))
        rows.append((uid, bytearray(x.tobytes()), bytearray(b"" if w is None else w.tobytes())))
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if near_links.similarity(*facts[a], *facts[b]) >= 0.8:
                lo, hi = sorted((root[a], root[b]))
                root = [lo if r == hi else r for r in root]
    table = spark.createDataFrame(rows, "uid long, items binary, reps binary")
    keyed = spark.createDataFrame([(uid, [7]) for uid in range(len(sets))], "uid long, keys array<long>")
    found = {r["node"]: r["root"] for r in near_links.near_components(keyed, table, 0.8).collect()}
    assert [found.get(uid, uid) for uid in range(len(sets))] == root
    assert len(set(root)) < len(sets) and root[0] == root[1] and root[2] == root[3]


def test_paragraphs_of_many_texts_are_sketched_as_those_of_each():
    from wardlens.llm.shingles import mix

    seeds, rnd = mix(np.arange(1, 7, dtype=np.uint64)), random.Random(4)
    texts = ["", " ".join(rnd.choices("abcdefgh", k=40)) + ".", "too short", "\n".join(" ".join(rnd.choices("vwxyz", k=13)) for _ in range(3))]
    spans, pair, low, items = paragraphs.paragraph_sketches(texts, seeds)
    assert [s[:2] for s in spans] == [(1, 0), (3, 0), (3, 1), (3, 2)]
    alone = [paragraphs.paragraph_sketches([t], seeds) for t in texts]
    assert [s[1:] for s in spans] == [s[1:] for a in alone for s in a[0]]
    assert (pair == np.concatenate([a[1] for a in alone])).all() and (low == np.concatenate([a[2] for a in alone])).all()
    assert items == [x for a in alone for x in a[3]]
