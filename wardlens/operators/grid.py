"""Grid search over forests (M12) with a result table that survives a restart.

The settings of a grid differ in three ways, and two of them need no fit of
their own: a forest of 100 trees is the first 100 trees of one of 300, and a
tree of depth 3 is a deeper tree read down to depth 3 (a node keeps its class
counts wherever it stands). So per fold there is one fit for each combination
of the *other* parameters, with the most trees and the greatest depth asked
for, and the held-out rows are scored at every (trees, depth) of the grid in
one pass. 36 settings on 5 folds are 15 fits instead of 180, and the fits of a
fold share one pass over its rows (:mod:`wardlens.operators.cells`).

Each fit is a job of its own, in its own scheduler pool. When it ends, the AUC of
each of its (setting, fold) pairs is written to the result folder; a search
that is started again over the same data skips the jobs it finds there.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import threading
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from wardlens.operators.cells import CellForestModel
from wardlens.operators.evaluation import rank_auc_by
from wardlens.session import drop_written, ensure_checkpoint_dir, ship_package

RESULT_SCHEMA = "setting int, params string, fold int, auc double"


# ---------------------------------------------------------------------------
# Settings and the fits that serve them
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    """One fit: the parameters it is trained with, and the settings read from it as (number, trees, depth)."""

    params: tuple
    reads: tuple


def grid_settings(grid: dict, depth_of) -> list[dict]:
    """Every setting of the grid, each parameter's values ascending; ``depth_of`` maps an unlimited depth."""
    names = sorted(grid)
    choices = [sorted({depth_of(v) if n == "maxDepth" else v for v in grid[n]}) for n in names]
    return [dict(zip(names, values)) for values in itertools.product(*choices)]


def shared_fits(settings: Sequence[dict], default_trees: int, default_depth: int) -> list[Fit]:
    """One fit per combination of the parameters other than tree count and depth."""
    groups: dict[tuple, list] = {}
    for i, s in enumerate(settings):
        rest = tuple(sorted((k, v) for k, v in s.items() if k not in ("numTrees", "maxDepth")))
        groups.setdefault(rest, []).append((i, s.get("numTrees", default_trees), s.get("maxDepth", default_depth)))
    return [Fit((*rest, ("maxDepth", max(r[2] for r in reads)), ("numTrees", max(r[1] for r in reads))), tuple(reads))
            for rest, reads in groups.items()]


# ---------------------------------------------------------------------------
# Reading one forest at several sizes
# ---------------------------------------------------------------------------

@dataclass
class ForestNodes:
    """A binary forest as arrays over its nodes, tree after tree."""

    roots: np.ndarray      # first node of each tree
    feature: np.ndarray    # -1 for a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray      # class 1's share of the node's training weight


def forest_nodes(model: RandomForestClassificationModel) -> ForestNodes:
    """The nodes of a fitted forest, from its saved node table.

    The driver holds what MLlib's own model holds there; continuous splits only
    (the scaled features carry no category metadata).
    """
    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardlens-forest-{uuid.uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    node = "nodeData" if "nodeData" in saved.columns else "node"
    t = saved.select(
        F.col("treeID").alias("tree"), F.col(f"{node}.id").alias("id"), F.col(f"{node}.leftChild").alias("left"),
        F.col(f"{node}.rightChild").alias("right"), F.col(f"{node}.split.featureIndex").alias("feature"),
        F.get(F.col(f"{node}.split.leftCategoriesOrThreshold"), 0).alias("threshold"),
        F.get(F.col(f"{node}.impurityStats"), 0).alias("n0"), F.get(F.col(f"{node}.impurityStats"), 1).alias("n1"),
    ).toArrow()
    drop_written(spark, [path])
    col = {c: t.column(c).to_numpy() for c in ("tree", "id", "left", "right")}
    order = np.lexsort((col["id"], col["tree"]))
    tree = col["tree"][order]
    roots = np.searchsorted(tree, np.arange(tree[-1] + 1))
    start = roots[tree]
    leaf = col["left"][order] < 0
    n0, n1 = (t.column(c).to_numpy()[order] for c in ("n0", "n1"))
    return ForestNodes(
        roots, np.where(leaf, -1, t.column("feature").fill_null(-1).to_numpy()[order]),
        np.where(leaf, 0.0, t.column("threshold").fill_null(0.0).to_numpy()[order]),
        np.where(leaf, 0, start + col["left"][order]), np.where(leaf, 0, start + col["right"][order]),
        n1 / np.where(n0 + n1 > 0, n0 + n1, 1.0))


def read_forest(nodes: ForestNodes, x: np.ndarray, reads: Sequence[tuple[int, int]]) -> np.ndarray:
    """Class-1 probability of each row of ``x`` for each (trees, depth): a rows x reads matrix.

    All rows walk down all trees together, one level at a time; at a depth that
    is asked for, the nodes reached give the shares of the trees cut there.
    """
    rows = np.arange(len(x))[:, None]
    at = np.broadcast_to(nodes.roots, (len(x), len(nodes.roots))).copy()
    out, depths = np.empty((len(x), len(reads))), sorted({d for _, d in reads})
    for level in range(max(depths) + 1):
        feature = nodes.feature[at]
        inner = feature >= 0
        last = not inner.any()
        if level in depths or last:
            total = np.cumsum(nodes.share[at], axis=1)
            for j, (trees, depth) in enumerate(reads):
                if depth == level or (last and depth > level):
                    out[:, j] = total[:, trees - 1] / trees
        if last:
            break
        down = np.where(x[rows, np.maximum(feature, 0)] <= nodes.threshold[at], nodes.left[at], nodes.right[at])
        at = np.where(inner, down, at)
    return out


def forest_scores(model: RandomForestClassificationModel | CellForestModel, rows: DataFrame, reads: Sequence[tuple[int, int]],
                  label: str = "label") -> DataFrame:
    """``label, n, read, score``: the probability of ``n`` rows for each (trees, depth), ``read`` numbering them.

    A forest grown on cells scores a cell's rows at once, one of MLlib row by row.
    """
    if isinstance(model, CellForestModel):
        return model.scores(rows, reads, label).select("label", "n", F.posexplode("scores").alias("read", "score"))
    ship_package(rows.sparkSession)
    nodes = rows.sparkSession.sparkContext.broadcast(forest_nodes(model))
    features = model.getFeaturesCol()
    schema = pa.schema([("label", pa.int32()), ("scores", pa.list_(pa.float64()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in range(0, b.num_rows, 256):
                piece = b.slice(part, 256)
                x = piece.column(1).flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, -1)
                found = read_forest(nodes.value, x, reads)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(list(found), schema.field(1).type)], schema=schema)

    scored = rows.select(F.col(label).cast("int").alias("label"), vector_to_array(features).alias("x")).mapInArrow(
        score, "label int, scores array<double>")
    return scored.select("label", F.lit(1).cast("long").alias("n"), F.posexplode("scores").alias("read", "score"))


# ---------------------------------------------------------------------------
# The result table
# ---------------------------------------------------------------------------

def data_fingerprint(data: DataFrame, *more) -> str:
    """A name for the rows of ``data`` (in any order) and the other arguments."""
    row = data.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.xxhash64(*data.columns).cast("decimal(20,0)")).alias("h")).first()
    said = json.dumps([row["n"], str(row["h"]), data.columns, *more], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()[:16]


class ResultTable:
    """Rows written job by job under one folder; a job's rows count once its write has ended."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _path(self, job: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/job={job}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def finished(self, job: str) -> bool:
        fs, path = self._path(job)
        return bool(fs.exists(path))

    def write(self, job: str, rows: DataFrame) -> None:
        """Each job has its own folder: a repeated or broken write touches no other job's rows."""
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/job={job}")

    def read(self, jobs: Sequence[str]) -> DataFrame:
        """The rows of ``jobs``, all of them finished."""
        paths = [f"{self.folder}/job={j}" for j in jobs]
        return self.spark.read.schema(self.schema).parquet(*paths)


def run_jobs(spark: SparkSession, jobs: Sequence, work, parallelism: int) -> None:
    """``work(job)`` for every job, ``parallelism`` at a time, each thread in its own scheduler pool.

    With ``spark.scheduler.mode=FAIR`` (a session default here) the jobs share
    the executors evenly, so a long fit does not hold back short ones.
    """
    failed = threading.Event()

    def pooled(job):
        if failed.is_set():
            return None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"wardlens-{uuid.uuid4().hex[:8]}")
        try:
            return work(job)
        except BaseException:
            failed.set()  # before this thread takes its next job
            raise
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if jobs:
        with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
            # The first failure ends the loop; jobs not begun are left for the next run.
            for _ in pool.imap_unordered(inheritable_thread_target(spark)(pooled), jobs):
                pass


def search_results(results: ResultTable, settings: Sequence[dict], fits: Sequence[Fit], folds: Sequence[int],
                   fit_fold, parallelism: int) -> DataFrame:
    """``setting, params, fold, auc`` of every pair; pairs whose job is finished are not run again.

    ``fit_fold(params, fold)`` gives (fitted forest, scaled held-out rows), or
    None for a fold that cannot be scored (its pairs get a NULL AUC).
    """
    spark = results.spark
    names = {(n, fold): f"fit{n}-fold{fold}" for n in range(len(fits)) for fold in folds}

    def work(job):
        n, fold = job
        made = fit_fold(dict(fits[n].params), fold)
        said = [(i, json.dumps(settings[i], sort_keys=True), fold) for i, _, _ in fits[n].reads]
        known = spark.createDataFrame([(r, *s) for r, s in enumerate(said)], "read int, setting int, params string, fold int")
        if made is None:
            rows = known.withColumn("auc", F.lit(None).cast("double"))
        else:
            scores = forest_scores(*made, [(t, d) for _, t, d in fits[n].reads])
            rows = known.join(rank_auc_by(scores, "read", n="n").select("read", "auc"), "read", "left")
        results.write(names[job], rows.drop("read"))
        if made is not None and isinstance(made[0], CellForestModel):
            made[0].release()

    run_jobs(spark, [j for j in names if not results.finished(names[j])], work, parallelism)
    return results.read(list(names.values()))
