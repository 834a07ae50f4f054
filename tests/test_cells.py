"""Forests grown on cells of binned rows."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wardlens.operators import cells as C
from wardlens.operators import grid as G
from wardlens.operators import modeling as M


class EachRowOnce:
    """Draws every row once, as a tree without bootstrap does."""

    def __init__(self):
        self.random = np.random.default_rng(0).random

    def poisson(self, n):
        return n


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    made = []
    for i in range(3000):
        x, y, z = rnd.random(), float(rnd.randint(0, 9)), float(rnd.random() < 0.3)
        made.append((i % 3, int(rnd.random() < 0.1 + 0.5 * (x > 0.6) + 0.03 * y * z), x, y, z))
    df = spark.createDataFrame(made, "fold int, label int, x double, y double, z double")
    return df.withColumn("weight", F.when(F.col("label") == 1, 1.5).otherwise(0.75)).cache()


@pytest.mark.parametrize("depth, least", [(2, 1), (5, 4), (7, 30)])
def test_a_tree_on_cells_is_the_tree_on_the_rows(spark, rows, depth, least):
    data = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(rows)
    bins = C.feature_bins(data, "features", "weight", 32)
    cells = C.cells_of(data, "features", bins, "label", "weight")
    assert cells.n.sum() == 3000 and len(cells.n) < 1500
    tree = DecisionTreeClassifier(labelCol="label", weightCol="weight", maxDepth=depth, minInstancesPerNode=least).fit(data)
    feature, place, left, right, share = C.grow_tree(cells, C.Shape(depth, least, 3), EachRowOnce())
    scored = tree.transform(data).collect()
    x = bins.of_keys(bins.keys(np.array([r["features"].toArray() for r in scored])))
    nodes = G.ForestNodes(np.array([0]), feature, place, left, right, share)
    assert G.read_forest(nodes, x, [(1, depth)])[:, 0] == pytest.approx([r["probability"][1] for r in scored])


def test_the_jobs_of_a_forest_do_not_grow_with_its_depth(spark, rows):
    counts, tracker = M.fold_label_counts(rows), spark.sparkContext.statusTracker()

    def jobs(depth):
        spark.sparkContext.setJobGroup(f"depth-{depth}", "a fold's forest")
        try:
            scored = M.fold_scores(rows, ["x", "y", "z"], "rf", 1, {"numTrees": 5, "maxDepth": depth}, counts)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert scored.agg(F.sum("n")).first()[0] == 1000  # every row of the fold counts
        return len(tracker.getJobIdsForGroup(f"depth-{depth}"))

    assert jobs(2) == jobs(9)


def test_fold_aucs_are_those_of_the_forest_on_the_rows(spark, rows, monkeypatch):
    params = {"numTrees": 40, "maxDepth": 5, "minInstancesPerNode": 3}
    own = [r["auc"] for r in M.fold_aucs(rows, ["x", "y", "z"], "rf", 3, params).orderBy("fold").collect()]
    monkeypatch.setattr(M, "fold_classifier", lambda kind, n, params=None, prepared=None: M.classifier(kind, n_train=n, params=params))
    rowwise = [r["auc"] for r in M.fold_aucs(rows, ["x", "y", "z"], "rf", 3, params).orderBy("fold").collect()]
    assert min(rowwise) > 0.7 and own == pytest.approx(rowwise, abs=0.015)


def test_rows_that_do_not_gather_go_to_the_forest_on_rows(rows, monkeypatch):
    monkeypatch.setattr(C, "MAX_CELLS", 20)
    counts = M.fold_label_counts(rows)
    fit = lambda: M._fit_without(rows, ["x", "y", "z"], lambda n: M.fold_classifier("rf", n, {"numTrees": 2, "maxDepth": 2}), counts, 0)
    assert isinstance(fit().stages[-1], RandomForestClassificationModel)
    monkeypatch.setattr(C, "MAX_CELLS", 100_000)
    fitted = fit()
    assert isinstance(fitted.stages[-1], C.CellForestModel)
    held_out = rows.where("fold = 0")
    one = fitted.transform(held_out).select("probability").collect()
    scaled = PipelineModel(stages=fitted.stages[:-1]).transform(held_out)
    by_cell = fitted.stages[-1].scores(scaled, [(2, 2)]).collect()
    assert sorted(r["probability"][1] for r in one) == pytest.approx(
        sorted(r["scores"][0] for r in by_cell for _ in range(r["n"])))


def test_a_smaller_forest_is_the_head_of_a_larger_one(spark):
    rng = np.random.default_rng(1)
    cells = C.Cells(rng.integers(0, 4, (200, 3)).astype(np.uint8), rng.integers(0, 2, 200), np.ones(200), rng.integers(1, 9, 200), 4)
    few, many = (C.grow_forest(spark, cells, C.Shape(4, 1, 2), trees, 42) for trees in (2, 7))
    n = many.roots[2]
    assert len(few.feature) == n and list(few.feature) == list(many.feature[:n]) and list(few.share) == list(many.share[:n])


def test_split_places_and_summaries():
    few = C.split_places(np.array([1.0, 2.0, 5.0]), np.ones(3), 31)
    assert list(few) == [1.5, 3.5] and len(C.split_places(np.array([7.0]), np.ones(1), 31)) == 0
    values = np.sort(np.random.default_rng(2).normal(size=5000))
    places = C.split_places(values, np.ones(5000), 31)
    held = np.diff(np.searchsorted(values, places), prepend=0, append=5000)
    assert len(places) == 31 and held.min() >= 155 and held.max() <= 158
    kept, mass = C.merged([(values[:3000], np.ones(3000)), (values[2000:], np.ones(3000))], 100)
    assert len(kept) <= 101 and mass.sum() == pytest.approx(6000) and kept[-1] == values[-1]
    bins = C.Bins((few, np.empty(0), places))
    x = np.array([[1.5, 9.0, -9.0], [1.6, 9.0, np.nan], [np.nan, 9.0, 9.0]])
    assert bins.of_keys(bins.keys(x)).tolist() == [[0, 0, 0], [1, 0, 31], [2, 0, 31]]
