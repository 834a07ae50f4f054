"""Grid search: shared fits, results that survive a restart, and AUCs of all folds at once."""

import os
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wardlens.operators import grid as G
from wardlens.operators import modeling as M
from wardlens.operators.evaluation import fold_rank_auc, rank_auc, rank_auc_by
from wardlens.plans.ordering import keyed_running_totals, running_totals
from wardlens.schemas import RF_PARAM_GRID


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    rows = [(i % 3, int(rnd.random() < 0.2 + 0.5 * (i % 7 == 0)), 1.0, float(i % 7), rnd.random(), rnd.random()) for i in range(240)]
    rows += [(3, 0, 1.0, 1.0, rnd.random(), 0.5) for _ in range(10)]  # a fold with one class
    return spark.createDataFrame(rows, "fold int, label int, weight double, x double, y double, z double").cache()


GRID = {"numTrees": [2, 6], "maxDepth": [1, 3, None], "minInstancesPerNode": [1, 4]}
FEATURES = ["x", "y", "z"]


def test_the_full_grid_needs_one_fit_per_leaf_size():
    settings = G.grid_settings(RF_PARAM_GRID, lambda d: 30 if d is None else d)
    fits = G.shared_fits(settings, 100, 30)
    assert len(settings) == 36 and len(fits) == 3
    assert all(dict(f.params)["numTrees"] == 300 and dict(f.params)["maxDepth"] == 30 and len(f.reads) == 12 for f in fits)
    assert sorted(i for f in fits for i, _, _ in f.reads) == list(range(36))


def test_a_forest_read_whole_gives_its_own_probabilities(data):
    counts = M.fold_label_counts(data)
    fitted = M._fit_without(data, FEATURES, lambda n: M.classifier("rf", params={"numTrees": 7, "maxDepth": 6}), counts, 0)
    forest, rows = fitted.stages[-1], PipelineModel(stages=fitted.stages[:-1]).transform(data)
    scored = forest.transform(rows).collect()
    nodes = G.forest_nodes(forest)
    x = np.array([r["features"].toArray() for r in scored])
    for trees, depth in ((7, 6), (7, 30)):
        assert G.read_forest(nodes, x, [(trees, depth)])[:, 0] == pytest.approx([r["probability"][1] for r in scored])
    # fewer trees: the mean of the first trees; depth 0: the shares at the roots
    one = G.read_forest(nodes, x, [(1, 30), (2, 30), (1, 0), (7, 2)])
    assert one[:, 0] == pytest.approx([forest.trees[0].predictProbability(r["features"])[1] for r in scored[:20]] +
                                      list(one[20:, 0]))
    assert one[:, 2] == pytest.approx([nodes.share[0]] * len(x))
    assert len(np.unique(one[:, 3])) <= len(np.unique(G.read_forest(nodes, x, [(7, 30)])))
    both = G.forest_scores(forest, rows, [(7, 6), (2, 1)]).groupBy("read").count().collect()
    assert {r["read"]: r["count"] for r in both} == {0: data.count(), 1: data.count()}


def test_a_search_that_was_broken_off_resumes(spark, data, scratch, monkeypatch):
    folder, calls = os.path.join(scratch, "results"), []
    fit = M._fit_without

    def dies(d, f, c, n, fold):
        calls.append(fold)
        if len(calls) >= 4:
            raise RuntimeError("killed")
        return fit(d, f, c, n, fold)

    monkeypatch.setattr(M, "_fit_without", dies)
    with pytest.raises(Exception, match="killed"):
        M.grid_search(data, FEATURES, 4, GRID, parallelism=1, unlimited_depth=5, results_dir=folder)
    done = [j for j in os.listdir(folder) if os.path.exists(os.path.join(folder, j, "_SUCCESS"))]
    assert len(done) >= 3

    calls.clear()
    monkeypatch.setattr(M, "_fit_without", lambda d, f, c, n, fold: calls.append(fold) or fit(d, f, c, n, fold))
    best, table = M.grid_search(data, FEATURES, 4, GRID, parallelism=2, unlimited_depth=5, results_dir=folder)
    assert len(calls) == 2 * 3 - 3                   # two fits, three folds with both classes; three were done
    calls.clear()
    again, second = M.grid_search(data, FEATURES, 4, GRID, parallelism=2, unlimited_depth=5, results_dir=folder)
    assert calls == [] and again == best and second.collect() == table.collect()
    rows = table.collect()
    assert len(rows) == 12 and len({r["params"] for r in rows}) == 12
    for r in rows:
        assert r["fold_aucs"][3] is None and all(0 <= a <= 1 for a in r["fold_aucs"][:3])
        assert r["mean_auc"] == pytest.approx(np.mean(r["fold_aucs"][:3]))
        assert r["std_auc"] == pytest.approx(np.std(r["fold_aucs"][:3]))


def test_fingerprint_follows_the_rows_not_their_order(data):
    assert G.data_fingerprint(data, 1) == G.data_fingerprint(data.orderBy("y"), 1)
    assert len({G.data_fingerprint(data, 1), G.data_fingerprint(data, 2), G.data_fingerprint(data.where("y < 0.5"), 1)}) == 3


def test_keyed_totals_restart_at_every_key_and_carry_across_slices(spark):
    rnd = random.Random(1)
    keys = [None, "a", "hot", "hot", "hot", "z"] + [f"k{i}" for i in range(30)]
    rows = [(rnd.choice(keys), rnd.randint(0, 400), i, rnd.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, x int, i int, v long")
    expected, sums, total = {}, {}, {}
    for k, x, i, v in sorted(rows, key=lambda r: (str(r[0]), -r[1], r[2])):
        sums[k] = expected[i] = sums.get(k, 0) + v
        total[k] = total.get(k, 0) + v
    for parts in (1, 13):
        got = keyed_running_totals(df, "k", ["-x", "i"], ["v"], parts).collect()
        assert len(got) == len(rows)
        assert all(r["cum_v"] == expected[r["i"]] and r["total_v"] == total[r["k"]] for r in got)
    one = df.withColumn("k", F.lit(1))
    assert sorted(keyed_running_totals(one, "k", ["x", "i"], ["v"]).select("i", "cum_v").collect()) == sorted(
        running_totals(df, ["x", "i"], ["v"]).select("i", "cum_v").collect())


def test_fold_aucs_equal_one_fold_at_a_time(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([0, 0, 0, 1, 2]), rnd.randint(0, 1), rnd.randint(0, 20) / 20) for _ in range(500)]
    rows += [(3, 1, 0.5), (3, 1, 0.2)]
    df = spark.createDataFrame(rows, "fold int, label int, score double")
    got = {r["fold"]: r for r in fold_rank_auc(df).collect()}
    known = []
    for f in range(4):
        alone = rank_auc(df.where(F.col("fold") == f)).first()
        assert (got[f]["auc"], got[f]["n_pos"], got[f]["n_neg"]) == tuple(alone)
        known += [alone["auc"]] if alone["auc"] is not None else []
    assert got[3]["auc"] is None and len(known) == 3
    assert got[0]["mean_auc"] == pytest.approx(np.mean(known)) and got[0]["std_auc"] == pytest.approx(np.std(known))
    assert rank_auc_by(df.where("false"), "fold").count() == 0 and fold_rank_auc(df.where("false")).count() == 0
    none = fold_rank_auc(df.where("fold = 3")).first()
    assert none["mean_auc"] is None and none["std_auc"] is None


def test_gradient_is_zero_at_the_fit_and_not_beside_it(spark):
    from wardlens.operators.evaluation import INTERCEPT, logistic_gradient
    from wardlens.operators.levels import fit_levels
    rnd = random.Random(8)
    df = spark.createDataFrame([(i, rnd.uniform(20, 90), rnd.choice(["M", "F", None]), int(rnd.random() < .4)) for i in range(300)],
                               "subject_id int, age_years double, gender string, label int")
    enc = fit_levels(df)
    rows = M.with_class_weights(enc.transform(df))
    names = enc.feature_names()
    fitted = M.model_pipeline(names, M.classifier("lr", n_train=300)).fit(rows)
    scaled = fitted.stages[0].transform(rows)
    got = {r["feature"]: r["gradient"] for r in logistic_gradient(fitted.stages[-1], scaled, names).collect()}
    assert set(got) == {"age_years", "gender_M", INTERCEPT} and max(map(abs, got.values())) < 1e-5
    rough = M.model_pipeline(names, M.classifier("lr", n_train=300).setMaxIter(1)).fit(rows)
    far = {r["feature"]: r["gradient"] for r in logistic_gradient(rough.stages[-1], scaled, names).collect()}
    assert max(map(abs, far.values())) > 1e-4
    # the definition, row by row
    b, b0, lam = rough.stages[-1].coefficients.toArray(), rough.stages[-1].intercept, rough.stages[-1].getRegParam()
    data = [(r["features"].toArray(), r["label"], r["weight"]) for r in scaled.collect()]
    pull = [w * (1 / (1 + np.exp(-(x @ b + b0))) - y) for x, y, w in data]
    mass = sum(w for _, _, w in data)
    own = sum(p * x for p, (x, _, _) in zip(pull, data)) / mass + lam * b
    assert [far[n] for n in names] == pytest.approx(list(own)) and far[INTERCEPT] == pytest.approx(sum(pull) / mass)
