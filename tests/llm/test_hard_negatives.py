"""Operator 11 against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, pos int, norm string, v int, slot int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, c, "u", 1, "n", 2, 3) for i, v, c in rows], SCHEMA)


def run(spark, rows, every=5):
    got = hn.hard_negatives(table(spark, rows), id_col="vec_id", label=F.col("label"), vector_col="embedding",
                            anchor=F.col("vec_id") % every == 0)
    return sorted(map(tuple, got.collect()), key=str)


def brute(rows, every=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows
            if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, v, c) in enumerate(good):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, d) for b, (j, w, d) in enumerate(good) if b != a]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for reward, j, _ in [s for s in scored if s[2] == c][:5]:
            far = [s for s in scored if s[2] != c and 50 * reward <= 100 * s[0] <= 95 * reward][:3]
            out += [(i, j, k + 1, s[1], reward, s[0]) for k, s in enumerate(far)]
    return sorted(out, key=str)


def random_rows(n, dims, labels, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        c = int(rng.integers(labels)) if rng.random() > .35 else 0  # one label holds over a third
        v = (centres[c] * (1 - spread) + rng.normal(size=dims) * spread) * rng.uniform(.05, 1)
        rows.append((i, [float(np.float32(x)) for x in v], c))
    return rows


@pytest.mark.parametrize("dims, labels, spread", [(8, 4, 0.3), (3, 3, 0.05)])
def test_equals_brute_force_over_many_buckets_blocks_and_rounds(spark, monkeypatch, dims, labels, spread):
    monkeypatch.setattr(hn, "BUCKET", 16)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    monkeypatch.setattr(hn, "GROWTH", 3)
    rows = random_rows(400, dims, labels, dims, spread)
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (5, [0.0, 0.0], 1), (10, None, 1), (15, [1.0, None], 1), (20, [1.0, math.nan], 1),
            (25, [math.inf, 0.0], 2), (30, [1.0, 1.0], None), (None, [0.9, 0.1], 1), (35, [], 2), (40, [0.5], 2), (45, [-1.0, 0.0], 1)]
    rows += [(i, [0.7, 0.1], 2) for i in range(100, 108)] + [(0, [1.0, 0.0], 1), (7, [0.7, 0.1], 3), (7, [0.7, 0.1], 3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1)]) == [] and run(spark, [(5, None, 1)]) == []


def test_pruning_leaves_out_no_row_and_prunes():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(500, 6))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    lists = np.argsort(unit, axis=0, kind="stable").T.astype("<u2")
    anchors, t = unit[:60], rng.uniform(0.3, 1.0, 60)
    found = hn.candidates(unit, lists, anchors, t)
    assert sum(x is not None and len(x) < 100 for x in found) > 10
    for a, least, rows in zip(anchors, t, found):
        hits = np.flatnonzero(unit @ a >= least)
        assert rows is None or set(hits) <= set(rows)


def test_large_components_stay_exact(spark):
    big = float(1 << 20)
    rows = [(0, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big * 0.75, 0.0], 2), (3, [big * 0.75, 1.0], 2)]
    assert run(spark, rows) == brute(rows)
