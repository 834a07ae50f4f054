"""Bulk-synchronous best-fit packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, documents, vocabulary  # noqa: F401
from wardlens.llm import packing


def _match_one_by_one(size, is_slot, tie):
    order = sorted(range(len(size)), key=lambda i: (-size[i], not is_slot[i], tie[i]))
    stack, got = [], {}
    for i in order:
        if is_slot[i]:
            stack.append(i)
        else:
            got[i] = stack.pop() if stack else -1
    return got, set(stack)


def test_sweep_equals_a_stack():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(0, 30)
        size = np.array([rng.randrange(1, 8) for _ in range(n)], np.int64)
        slot = np.array([rng.random() < 0.5 for _ in range(n)], bool)
        tie = np.array([rng.randrange(100) * 100 + i for i in range(n)], np.int64)
        order, match, left = packing.sweep(size, slot, tie)
        got, stack = _match_one_by_one(size, slot, tie)
        assert {int(order[k]): int(match[k]) for k in range(n) if not slot[order[k]]} == got
        assert {int(order[k]) for k in range(n) if slot[order[k]] and left[k]} == stack
        assert all(left[k] == (match[k] < 0) for k in range(n) if not slot[order[k]])


def test_leftovers_take_the_nearest_larger_slots():
    rows, matched = packing.match_leftovers([(0, 2, 3), (1, 1, 0), (2, 4, 1), (5, 1, 0)])
    assert rows == [(1, 0, 0, 0, 1), (2, 0, 0, 1, 2), (5, 0, 2, 0, 1)]
    assert matched == {0: 0, 1: 1, 2: 2, 5: 1}


def _best_fit_decreasing(lengths, capacity):
    gaps, n = [0] * (capacity + 1), 0
    for x in sorted(lengths, reverse=True):
        g = next((g for g in range(x, capacity + 1) if gaps[g]), None)
        if g is None:
            n, g = n + 1, capacity
        else:
            gaps[g] -= 1
        gaps[g - x] += 1
    return n


def _checked(rows, capacity):
    """Number of sequences, after checking that each is gapless and not too long."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("kind", ["mixed", "tiny", "one size", "hot size"])
def test_packing_is_valid_and_close_to_best_fit(spark, kind):
    rng, cap = random.Random(11), 64
    n = 400
    lengths = {"mixed": [min(cap, int(rng.expovariate(1 / 22)) + 1) for _ in range(n)], "tiny": [rng.choice([1, 1, 2]) for _ in range(n)],
               "one size": [20] * n, "hot size": [rng.choice([25, rng.randrange(1, 65)]) for _ in range(n)]}[kind]
    pieces = spark.createDataFrame([(i, x, "kept") for i, x in enumerate(lengths)], "k long, length long, uid string")
    rows = packing.pack_best_fit(pieces, cap).collect()
    assert sorted((r.k, r.length, r.uid) for r in rows) == [(i, x, "kept") for i, x in enumerate(lengths)]
    assert _checked(rows, cap) <= 1.02 * _best_fit_decreasing(lengths, cap) + 1


def test_bad_lengths_empty_input_and_clashing_columns(spark):
    frame = lambda rows: spark.createDataFrame(rows, "length long, offset string, seq int")
    assert packing.pack_best_fit(frame([]), 8).count() == 0
    for bad in (0, 9, None):
        with pytest.raises(ValueError):
            packing.pack_best_fit(frame([(bad, "a", 1)]), 8)
    rows = packing.pack_best_fit(frame([(8, "a", 1), (8, "a", 1), (3, None, None)]), 8)
    assert rows.columns == ["length", "seq", "sequence_id", "offset"]
    assert sorted((r.length, r.seq or 0, r.offset) for r in rows.collect()) == [(3, 0, 0), (8, 1, 0), (8, 1, 0)]


def test_documents_are_cut_and_packed(spark, documents, vocabulary):
    from wardlens.llm.encoding import Encoder

    path = vocabulary("word_bpe_49k.json")
    rows = [(1, None, "en"), (2, "", None), (3, "some words here " * 900, "en"), (None, "no id", "en"), (4, "twin", "en"), (4, "twin", "en")]
    got = packing.pack_documents(documents(rows), path, 2048, 0).collect()
    enc, want = Encoder(path).tokenizer, []
    for d, t, _ in rows:
        ids = [*enc.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k:k + 2048], "<u4").tobytes()
            want.append((d or -1, k // 2048, k, len(part) // 4, zlib.crc32(part)))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    _checked(got, 2048)
    assert packing.pack_documents(documents([]), path, 2048, 0).count() == 0


def test_query_packs_the_small_tables_well(spark):
    from wardlens.llm.queries import op2_best_fit_packing

    rows = op2_best_fit_packing(spark, SF_SMALL).collect()
    lengths = [r.length for r in rows]
    assert {r.doc_id for r in rows} == {r[0] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()}
    assert _checked(rows, 2048) <= 1.02 * _best_fit_decreasing(lengths, 2048) + 1


def test_ranges_follow_the_rows(spark):
    most = packing.MOST_ROWS_PER_RANGE
    assert [packing.range_tasks(n, 50) for n in (1, 16_000, 16_001, 320_000, 10 * most, 60 * most)] == [1, 1, 2, 20, 50, 61]
    lengths = [random.Random(k).randint(1, 2048) for k in range(packing.ROWS_PER_RANGE * 2)]
    rows = packing.pack_best_fit(spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").repartition(4), 2048).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    assert _checked(rows, 2048) <= 1.02 * max(_best_fit_decreasing(lengths, 2048), sum(lengths) / 2048)
