"""Greedy folds over group signatures."""

import random

from pyspark.sql import functions as F

from wardlens.operators import folds as FO


def one_group_at_a_time(signatures, k):
    pos, rows, share = [0] * k, [0] * k, {}
    for p, r, n in sorted(signatures, key=lambda s: (-s[0], -s[1])):
        for _ in range(n):
            f = min(range(k), key=lambda f: ((pos if p else rows)[f], rows[f], f))
            pos[f] += p
            rows[f] += r
            share[p, r, f] = share.get((p, r, f), 0) + 1
    return pos, share


def round_robin(signatures, k):
    pos, i = [0] * k, 0
    for p, _, n in sorted(signatures, key=lambda s: (-s[0], -s[1])):
        for _ in range(n):
            pos[i % k] += p
            i += 1
    return pos


def test_dealing_in_bulk_equals_one_group_at_a_time_and_is_never_less_even():
    for seed in range(1500):
        rnd = random.Random(seed)
        k, sig = rnd.randint(1, 6), {}
        for _ in range(rnd.randint(1, 12)):
            size = rnd.randint(1, rnd.choice([3, 10, 200]))
            sig[rnd.randint(0, min(size, rnd.choice([1, 5, 200]))), size] = rnd.randint(1, rnd.choice([2, 30]))
        signatures = [(p, r, n) for (p, r), n in sig.items()]
        pos, share = one_group_at_a_time(signatures, k)
        at = 0
        for p, r, before, ends in FO.deal_signatures(signatures, k):
            assert before == at and ends[-1] == sig[p, r]
            at += ends[-1]
            assert [e - s for s, e in zip([0, *ends], ends)] == [share.get((p, r, f), 0) for f in range(k)]
        other = round_robin(signatures, k)
        assert max(pos) - min(pos) <= max(other) - min(other)


def test_work_follows_the_signatures_not_the_groups():
    out = FO.deal_signatures([(10**9, 3 * 10**9, 1), (1, 1, 10**9), (0, 1, 10**10), (3, 5, 10**8)], 5)
    assert sum(ends[-1] for _, _, _, ends in out) == 1 + 10**9 + 10**10 + 10**8
    assert FO.deal_signatures([], 3) == []


def test_even_folds_contract(spark):
    rnd = random.Random(4)
    sizes = {g: rnd.choice([1, 1, 2, 9, 40]) for g in range(60)}
    rows = [(g if g else None, int(rnd.random() < .3)) for g, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "subject_id long, label int")
    folds = FO.grouped_folds(df, "subject_id", "label", 4, method="even")
    assert sorted(map(str, folds.collect())) == sorted(map(str, FO.grouped_folds(df.orderBy("label"), "subject_id", "label", 4, method="even").collect()))
    bal = FO.fold_balance(FO.assign_folds(df, folds, "subject_id"), "subject_id", "label").collect()
    assert sum(r["n_rows"] for r in bal) == len(rows) and {r["fold"] for r in bal} == {0, 1, 2, 3}
    plain = FO.fold_balance(FO.assign_folds(df, FO.grouped_folds(df, "subject_id", "label", 4), "subject_id"), "subject_id", "label").collect()
    spread = lambda b: max(r["n_pos"] for r in b) - min(r["n_pos"] for r in b)
    assert spread(bal) <= spread(plain)
    assert folds.where(F.col("fold").isNull()).count() == 0
