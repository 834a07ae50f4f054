"""Random forests grown on the distinct binned rows.

A forest splits a feature at one of 31 places at most, so all that it sees of a
row is the bin of each feature. Rows with the same bins, label and weight are
one *cell* with a count: one pass over the table makes the cells, and trees grow
on these instead of passing over the rows level by level. Each row is drawn as
in MLlib: Poisson(1) times per tree, which for the n rows of a cell is one draw
of Poisson(n). Splits, too, follow MLlib's forest: quantile bins, a random set of
features per node, the best Gini gain that leaves enough drawn rows on either
side, leaves of one parent and one prediction merged.

A tree draws from its own seed, so neither the number of tasks nor that of the
other trees changes it. Where the bins do not gather the rows (too many features,
or more than ``MAX_CELLS`` cells), the rows go to MLlib's forest as they are.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.session import ship_package

# Cells that the driver and every task hold (some 50 bytes each, and as much again while a tree grows).
MAX_CELLS = 1_000_000
# A cell's bins are one 64-bit number.
MOST_KEYS = 2**62
# Values of a feature that a task tells of when it has met more than four times as many; split places are chosen
# from those of all tasks (MLlib chooses them from 10,000 rows).
POINTS = 4_096


# ---------------------------------------------------------------------------
# Bins
# ---------------------------------------------------------------------------

def split_places(values: np.ndarray, mass: np.ndarray, most: int) -> np.ndarray:
    """At most about ``most`` places between the ``values`` (ascending) that share out their ``mass`` evenly."""
    between = (values[1:] + values[:-1]) / 2
    if len(between) <= most:
        return between
    reached, stride = np.cumsum(mass), mass.sum() / (most + 1)
    places, target = [], stride
    for before, after, place in zip(reached[:-1], reached[1:], between):
        if abs(before - target) < abs(after - target):
            places.append(place)
            target += stride
    return np.array(places)


@dataclass(frozen=True)
class Bins:
    """The split places of each feature, ascending; a value's bin is the number of places below it."""

    places: tuple

    @property
    def sizes(self) -> list[int]:
        return [len(p) + 1 for p in self.places]

    def keys(self, x: np.ndarray) -> np.ndarray:
        key = np.zeros(len(x), np.int64)
        for p, value in zip(self.places, np.ascontiguousarray(x.T)):
            if len(p):
                key *= len(p) + 1
                key += ~(value <= p[0]) if len(p) == 1 else np.searchsorted(p, value)
        return key

    def of_keys(self, key: np.ndarray) -> np.ndarray:
        out = np.empty((len(key), len(self.places)), np.uint8)
        for f in range(len(self.places) - 1, -1, -1):
            key, out[:, f] = np.divmod(key, self.sizes[f])
        return out


def merged(points: Sequence[tuple[np.ndarray, np.ndarray]], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Values (ascending, each once) and their mass; above ``most`` values, neighbours of little mass are put together."""
    values, mass = (np.concatenate(p) for p in zip(*points))
    if len(values) > 2 and ((high := values == values.max()) | (values == values.min())).all():  # an indicator
        values, mass = np.array([values.min(), values.max()]), np.array([mass[~high].sum(), mass[high].sum()])
        return (values, mass) if values[0] < values[1] else (values[1:], mass[1:])
    order = np.argsort(values, kind="stable")
    values, mass = values[order], mass[order]
    begins = np.flatnonzero(np.append(True, values[1:] != values[:-1]))[:len(values)]
    values, mass = values[begins], np.add.reduceat(mass, begins) if len(values) else mass
    if most and len(values) > most:
        group = np.minimum((np.cumsum(mass) / mass.sum() * most).astype(np.int64), most)
        last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
        values, mass = values[last], np.diff(np.cumsum(mass)[last], prepend=0.0)
    return values, mass


def feature_bins(rows: DataFrame, features: str, weight: str, max_bins: int) -> Bins | None:
    """Bins of the vector column ``features``, from the values of all rows and their weight; None when a key cannot hold them.

    A task keeps some ``POINTS`` values of a feature, all of them if there are no more.
    """
    ship_package(rows.sparkSession)
    first = rows.select(features).first()
    width = 0 if first is None else len(first[0])
    if not 0 < width <= math.log2(MOST_KEYS) or max_bins > 256:
        return None
    schema = pa.schema([("feature", pa.int32()), ("value", pa.float64()), ("mass", pa.float64())])

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [[] for _ in range(width)], 0
        for b in batches:
            x, w = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), b.column(0).to_numpy()
            for f, value in enumerate(np.ascontiguousarray(x.T)):
                known = ~np.isnan(value)
                kept[f].append(merged([(value, w) if known.all() else (value[known], w[known])]))
                held += len(kept[f][-1][0])
            if held > 8 * POINTS * width:
                kept = [[merged(k, POINTS)] for k in kept]
                held = sum(len(k[0][0]) for k in kept)
        for f, k in enumerate(kept):
            if k:
                values, mass = merged(k, 4 * POINTS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), f, np.int32)), pa.array(values), pa.array(mass)], schema=schema)

    def placed(points: pd.DataFrame) -> pd.DataFrame:
        places = split_places(*merged([(points["value"].to_numpy(), points["mass"].to_numpy())]), max_bins - 1)
        return pd.DataFrame({"feature": [points["feature"].iloc[0]], "places": [places]})

    points = rows.select(F.col(weight).cast("double").alias("w"), vector_to_array(features).alias("x")).mapInArrow(
        summarised, "feature int, value double, mass double")
    found = {r["feature"]: np.array(r["places"]) for r in
             points.groupBy("feature").applyInPandas(placed, "feature int, places array<double>").collect()}
    bins = Bins(tuple(found.get(f, np.empty(0)) for f in range(width)))
    return bins if math.prod(bins.sizes) < MOST_KEYS and max(bins.sizes) <= 256 else None


def keyed_rows(rows: DataFrame, features: str, bins: Bins, label: str, *kept: str) -> DataFrame:
    """``key, label`` and the columns ``kept`` (doubles) of every row."""
    ship_package(rows.sparkSession)
    chosen = rows.select(F.col(label).cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in kept],
                         vector_to_array(features).alias("x"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array(bins.keys(x)), *b.columns[:-1]], names=["key", *b.schema.names[:-1]])

    return chosen.mapInArrow(keyed, ", ".join(["key long", "label int", *[f"`{c}` double" for c in kept]]))


@dataclass
class Cells:
    bins: np.ndarray    # cells x features
    label: np.ndarray
    weight: np.ndarray  # of one row
    n: np.ndarray       # rows
    n_bins: int


def cells_of(rows: DataFrame, features: str, bins: Bins, label: str, weight: str) -> Cells | None:
    """The cells of ``rows``, in the order of their keys; None for more than ``MAX_CELLS``."""
    t = (keyed_rows(rows, features, bins, label, weight).groupBy("key", "label", weight)
         .agg(F.count(F.lit(1)).alias("n")).limit(MAX_CELLS + 1).toArrow())
    if t.num_rows > MAX_CELLS:
        return None
    key, y, w, n = (t.column(c).to_numpy() for c in ("key", "label", weight, "n"))
    if not np.isin(y, (0, 1)).all():
        return None
    order = np.lexsort((w, y, key))
    return Cells(bins.of_keys(key[order]), y[order].astype(np.int64), w[order], n[order], max(bins.sizes))


# ---------------------------------------------------------------------------
# Trees
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Shape:
    depth: int
    min_rows: int
    per_node: int  # features that a node chooses from


def grow_tree(cells: Cells, shape: Shape, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """``feature, bin, left, right, share`` of the tree's nodes, the root first; a leaf has feature -1.

    Rows in a bin up to ``bin`` go left; ``share`` is class 1's share of the drawn weight.
    """
    drawn = rng.poisson(cells.n)
    used = np.flatnonzero(drawn)
    bins, label, drawn = cells.bins[used], cells.label[used], drawn[used].astype(float)
    mass, width = drawn * cells.weight[used], cells.n_bins
    n_features, bins = bins.shape[1], bins.ravel()
    start, slot = np.arange(len(used)) * n_features, np.zeros(len(used), np.int64)  # a cell's first bin; its node
    levels = [(np.bincount(label, mass, 2)[None, :], None)]  # per level: class weights, and the splits made there
    active, begin = np.zeros(1, np.int64), 0                 # nodes of the level to be split; the level's first node
    if levels[0][0].min() <= 0 or not len(used):
        active = active[:0]
    for _ in range(shape.depth):
        k = len(active)
        if not k:
            break
        choice = rng.random((k, n_features)).argsort(axis=1)[:, :shape.per_node]
        p = choice.shape[1]
        sums, counts = np.empty((2, k, p, width)), np.empty((k, p, width))
        cell = slot * width
        of_class = cell + label * (k * width)
        for s in range(p):
            b = bins.take(start + choice[:, s].take(slot))
            counts[:, s] = np.bincount(cell + b, drawn, k * width).reshape(k, width)
            sums[:, :, s] = np.bincount(of_class + b, mass, 2 * k * width).reshape(2, k, width)
        np.cumsum(sums, axis=3, out=sums)
        np.cumsum(counts, axis=2, out=counts)
        left, total, n_left, n_total = sums[..., :-1], sums[..., -1:], counts[..., :-1], counts[..., -1:]
        right = np.maximum(total - left, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            pure = lambda side: (side[0] * side[0] + side[1] * side[1]) / (side[0] + side[1])
            gain = (pure(left) + pure(right) - pure(total)) / (total[0] + total[1])
        gain = np.where((n_left >= shape.min_rows) & (n_total - n_left >= shape.min_rows) & (gain > 0), gain, 0.0).reshape(k, -1)
        best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(k, np.int64)
        split = np.flatnonzero(gain[np.arange(k), best] > 0) if gain.shape[1] else np.empty(0, np.int64)
        if not len(split):
            break
        which, place = np.divmod(best[split], width - 1)
        feature = choice[split, which]
        children = np.stack([left[:, split, which, place].T, right[:, split, which, place].T], axis=1).reshape(-1, 2)
        levels[-1] = (levels[-1][0], (active[split] - begin, feature, place))
        begin += len(levels[-1][0])
        levels.append((children, None))
        # A child is looked at again unless it holds one class only.
        again = np.flatnonzero((children.min(axis=1) > 1e-9 * children.sum(axis=1)))
        number, place_of = np.full(k, -1), np.full(len(children), -1)
        number[split], place_of[again] = np.arange(len(split)), np.arange(len(again))
        at = number.take(slot)
        inside = np.flatnonzero(at >= 0)
        at = at[inside]
        slot = place_of.take(2 * at + (bins.take(start[inside] + feature.take(at)) > place.take(at)))
        stays = np.flatnonzero(slot >= 0)
        slot, inside = slot[stays], inside[stays]
        start, label, drawn, mass = start[inside], label[inside], drawn[inside], mass[inside]
        active = begin + again
    return _nodes(levels)


def _nodes(levels: list) -> tuple[np.ndarray, ...]:
    """The levels as arrays over nodes; two leaves of one parent that predict the same class become one leaf."""
    sums = np.concatenate([s for s, _ in levels])
    first = np.cumsum([0] + [len(s) for s, _ in levels])
    feature, place = np.full(len(sums), -1), np.zeros(len(sums), np.int64)
    left, right = np.zeros(len(sums), np.int64), np.zeros(len(sums), np.int64)
    predicted = sums[:, 1] > sums[:, 0]
    for i in range(len(levels) - 1, -1, -1):
        if levels[i][1] is None:
            continue
        at, f, b = levels[i][1]
        at = at + first[i]
        low = first[i + 1] + 2 * np.arange(len(at))
        one = (feature[low] < 0) & (feature[low + 1] < 0) & (predicted[low] == predicted[low + 1])
        at, low, f, b = at[~one], low[~one], f[~one], b[~one]
        feature[at], place[at], left[at], right[at] = f, b, low, low + 1
    mass = sums.sum(axis=1)
    # What was merged away is not reached any more.
    kept = np.zeros(len(sums), bool)
    kept[0] = True
    inner = feature >= 0
    kept[left[inner]] = kept[right[inner]] = True
    new = np.cumsum(kept) - 1
    made = feature, place, new[left], new[right], sums[:, 1] / np.where(mass > 0, mass, 1.0)
    return tuple(a[kept].astype(t) for a, t in zip(made, (np.int16, np.int16, np.int32, np.int32, np.float64)))


_TREE = pa.schema([("tree", pa.int64()), ("feature", pa.list_(pa.int16())), ("bin", pa.list_(pa.int16())),
                   ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())), ("share", pa.list_(pa.float64()))])


def grow_forest(spark, cells: Cells, shape: Shape, trees: int, seed: int):
    """``trees`` trees over the executors' tasks, as :class:`wardlens.operators.grid.ForestNodes` over bins."""
    from wardlens.operators.grid import ForestNodes

    ship_package(spark)
    shared = spark.sparkContext.broadcast(cells)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree in b.column(0).to_pylist():
                made = grow_tree(shared.value, shape, np.random.default_rng([seed % 2**63, tree]))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((tree, *made), _TREE.types)], schema=_TREE)

    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)
    t = spark.range(0, trees, 1, tasks).mapInArrow(
        grow, "tree long, feature array<short>, bin array<short>, left array<int>, right array<int>, share array<double>"
    ).toArrow().sort_by("tree").combine_chunks()
    shared.destroy()
    feature, place, left, right, share = (
        t.column(c).combine_chunks().flatten().to_numpy() for c in ("feature", "bin", "left", "right", "share"))
    sizes = np.array([len(x) for x in t.column("feature")])
    roots = np.cumsum(sizes) - sizes
    start = np.repeat(roots, sizes).astype(np.int32)
    return ForestNodes(roots, feature, place, start + left, start + right, share)


# ---------------------------------------------------------------------------
# Pipeline stages
# ---------------------------------------------------------------------------

class Prepared:
    """Bins and cells of one set of rows, made by the first of the fits that share them."""

    def __init__(self):
        self.lock, self.made = threading.Lock(), None

    def get(self, make):
        with self.lock:
            if self.made is None:
                self.made = (make(),)
        return self.made[0]


class CellForest(Estimator):
    """The forest that ``forest`` describes, grown on cells; ``prepared`` is shared by fits on the same rows."""

    def __init__(self, forest: RandomForestClassifier, prepared: Prepared | None = None):
        super().__init__()
        self.forest, self.prepared = forest, prepared or Prepared()

    def _cells(self, rows: DataFrame) -> tuple[Bins, Cells] | None:
        f = self.forest
        bins = feature_bins(rows, f.getFeaturesCol(), f.getWeightCol(), f.getMaxBins())
        cells = bins and cells_of(rows, f.getFeaturesCol(), bins, f.getLabelCol(), f.getWeightCol())
        return cells and (bins, cells)

    def _fit(self, dataset: DataFrame):
        f = self.forest
        made = self.prepared.get(lambda: self._cells(dataset))
        if made is None:
            return f.fit(dataset)
        bins, cells = made
        shape = Shape(f.getMaxDepth(), f.getMinInstancesPerNode(), math.ceil(math.sqrt(len(bins.places))))
        nodes = grow_forest(dataset.sparkSession, cells, shape, f.getNumTrees(), f.getSeed())
        return CellForestModel(bins, nodes, f.getFeaturesCol(), (f.getNumTrees(), f.getMaxDepth()))


class CellForestModel(Model):
    """Scores rows by their bins."""

    def __init__(self, bins: Bins, nodes, features: str, size: tuple[int, int]):
        super().__init__()
        self.bins, self.nodes, self.features, self.size = bins, nodes, features, size
        self.shared = []

    def _share(self, spark):
        """The nodes as a broadcast, made once."""
        if not self.shared:
            self.shared.append(spark.sparkContext.broadcast(self.nodes))
        return self.shared[0]

    def release(self) -> None:
        """Drop what scoring has left on the executors' disks; tables scored before cannot be read any more."""
        while self.shared:
            self.shared.pop().destroy()

    def scores(self, rows: DataFrame, reads: Sequence[tuple[int, int]], label: str = "label") -> DataFrame:
        """``label, n, scores``: the probabilities for each (trees, depth) of ``n`` rows with the same bins."""
        spark, bins = rows.sparkSession, self.bins
        nodes = self._share(spark)
        cells = keyed_rows(rows, self.features, bins, label).groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        schema = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("scores", pa.list_(pa.float64()))])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from wardlens.operators.grid import read_forest
            for b in batches:
                for part in range(0, b.num_rows, 256):
                    key, y, n = b.slice(part, 256).columns
                    found = read_forest(nodes.value, bins.of_keys(key.to_numpy()), reads)
                    yield pa.RecordBatch.from_arrays([y, n, pa.array(list(found), schema.field(2).type)], schema=schema)

        return cells.repartition(spark.sparkContext.defaultParallelism).mapInArrow(score, "label int, n long, scores array<double>")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        nodes, bins, reads = self._share(dataset.sparkSession), self.bins, [self.size]

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            from wardlens.operators.grid import read_forest
            b = bins.of_keys(bins.keys(np.stack(x.to_numpy()))) if len(x) else np.empty((0, len(bins.places)), np.uint8)
            return pd.Series(np.concatenate([read_forest(nodes.value, b[i:i + 256], reads)[:, 0] for i in range(0, len(b), 256)] or [[]]))

        p = score(vector_to_array(self.features))
        return dataset.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
