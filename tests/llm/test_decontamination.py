"""Benchmark decontamination against every window compared with every place."""

import hashlib
import random
import re

import pytest

from llm_fixtures import SF_SMALL, documents  # noqa: F401
from wardlens.llm import decontamination as dc

_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items):
    out = []
    for d, t, _ in docs:
        w, hit, ids = _words(t), set(), set()
        for item, text in items:
            iw = _words(text)
            k = min(10, len(iw))
            for s in range(len(iw) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == iw[s:s + k]:
                        hit.update(range(p, p + k))
                        ids.add(item)
        out.append((str(d), len(w), len(hit), sorted(map(str, ids))))
    return sorted(out)


def _case():
    rng = random.Random(2)
    vocab = ["the", "of", "a", "Straße", "x9", "é", "zeta", "B"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, line(rng.choice([0, 3, 9, 10, 14, 40]))) for i in range(12)]
    items += [(3, items[5][1]), (None, items[4][1]), (50, None), (51, "..."), (52, "once once")]
    docs = [(i, f"{line(30)}! {items[i][1].upper()}", "en") for i in range(5)]
    for i, (_, t) in enumerate(items):
        docs.append((100 + i, f"{line(5)}; {(t or '').replace(' ', ', ')} {line(4)}", "en"))
    docs += [(7, None, None), (8, "", "en"), (None, items[5][1], "en"), (9, items[5][1] * 3, "en"), (9, items[5][1] * 3, "en"),
             (10, "the " * 20_000, "en")]
    return docs, items


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_hits_equal_brute_force(spark, documents, block_words):
    docs, items = _case()
    table = spark.createDataFrame([(*x, "extra") for x in items], "item_id long, text string, n_words string")
    rows = dc.contamination(documents(docs), table, block_words=block_words).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(map(str, r.items))) for r in rows)
    assert got == _brute(docs, items)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in rows)
    clean = dc.contaminated_filter(documents(docs), table, block_words=block_words)
    assert clean.columns == documents([]).columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(d for d, _, n, _ in got if not n)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.contamination(documents([]), some).count() == 0
    assert [tuple(r) for r in dc.contamination(documents([(1, "a b", "en")]), none).collect()] == [(1, 2, 0, [], [])]
    assert dc.contaminated_filter(documents([(1, "a b", "en")]), none).count() == 1


def test_query_equals_brute_force(spark):
    from wardlens.llm.queries import op7_decontamination

    docs = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(d, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0) for d, n, hit, ids in _brute(docs, items)]
    assert sorted((str(r[0]), *r[1:]) for r in op7_decontamination(spark, SF_SMALL).collect()) == want
