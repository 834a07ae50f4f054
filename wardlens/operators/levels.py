"""The design matrix as one sparse vector, for any number and spelling of levels (M1).

Category levels are a table, not a driver-side list: distinct (column, level)
pairs are numbered in sorted order (:func:`global_positions`), the first level of
each column is the baseline and has no place in the vector, and every other
level has one. Rows meet their places by an equijoin on the level, which Spark
broadcasts when the table's measured size allows and shuffles when not. Names
such as ``unit_B.C`` and ``unit_B_C`` are data, so they never clash.

:class:`LevelEncoder` is a pipeline stage that writes its level table next to
its parameters, so a saved model scores raw admission rows, batch or streaming.
"""

from __future__ import annotations

import json

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.plans.ordering import global_positions
from wardlens.schemas import FEATURE_COLS_CATEGORICAL, FEATURE_COLS_NUMERIC
from wardlens.session import materialize

VECTOR = "features_raw"


class VectorFeatures(list):
    """Feature names, in the order of the vector column ``column``."""

    def __init__(self, names, column: str = VECTOR):
        super().__init__(names)
        self.column = column


def level_table(df: DataFrame, columns, n_numeric: int = 0) -> DataFrame:
    """``column, level, position, n_levels, index`` of every non-NULL level of ``columns``.

    ``position`` counts a column's levels from 0 in sorted order; ``index`` is
    the level's place in the vector (numerics first, then column by column),
    NULL for the baseline.
    """
    columns = list(columns)
    pairs = (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("level"))
                                           for i, c in enumerate(columns)])).alias("p"))
             .select("p.c", "p.level").where(F.col("level").isNotNull()).distinct())
    placed = materialize(global_positions(pairs, ["c", "level"], "pos"), "levels")
    # One row per categorical column.
    per = placed.groupBy("c").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n_levels"))
    before = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("start", F.coalesce(F.sum(F.col("n_levels") - 1).over(before), F.lit(0)) + F.lit(n_numeric))
    name = F.lit(None).cast("string")
    for i, c in enumerate(columns):
        name = F.when(F.col("c") == i, F.lit(c)).otherwise(name)
    position = F.col("pos") - F.col("first")
    return placed.join(F.broadcast(per), "c").select(
        name.alias("column"), "level", position.alias("position"), "n_levels",
        F.when(position > 0, F.col("start") + position - 1).alias("index"))


def design_matrix_sparse(frame: DataFrame, numeric=FEATURE_COLS_NUMERIC, categorical=FEATURE_COLS_CATEGORICAL,
                         ids=("subject_id", "hadm_id")) -> DataFrame:
    """M1 in long form: the ``ids``, then ``index, feature, value`` of every entry that is not 0 (or NULL)."""
    ids = [c for c in ids if c in frame.columns]
    numeric = [c for c in numeric if c in frame.columns]
    categorical = [c for c in categorical if c in frame.columns]
    parts = []
    if numeric:
        entry = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("index"), F.lit(c).alias("feature"),
                                             F.col(c).cast("double").alias("value")) for i, c in enumerate(numeric)]))
        parts.append(frame.select(*ids, entry.alias("e")).select(*ids, "e.*").where(F.col("value") != 0))
    if categorical:
        levels = materialize(level_table(frame, categorical, len(numeric)), "level-table")
        cells = frame.select(*ids, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in categorical])).alias("e"))
        parts.append(cells.select(*ids, "e.*").join(levels.where(F.col("index").isNotNull()), ["column", "level"])
                     .select(*ids, "index", F.concat_ws("_", "column", "level").alias("feature"), F.lit(1.0).alias("value")))
    if not parts:
        raise ValueError("no feature column")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class LevelEncoder(Transformer, MLWritable, MLReadable):
    """Numerics and 0/1 levels as one sparse vector column ``features_raw``; drops the categorical inputs.

    A missing input column, a NULL and an unseen level all give zeros, like the
    baseline. The vector is built by ``OneHotEncoder`` and ``VectorAssembler``.
    """

    spec = Param(Params._dummy(), "spec", "JSON: numeric columns, and [column, number of levels] of the categorical ones",
                 typeConverter=TypeConverters.toString)

    def __init__(self, levels: DataFrame | None = None, spec: dict | None = None):
        super().__init__()
        self.levels = levels
        if spec is not None:
            self._set(spec=json.dumps(spec))

    def _spec(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))

    def feature_names(self) -> VectorFeatures:
        """Names in vector order; as many strings as the fitted model has coefficients."""
        named = self.levels.where(F.col("index").isNotNull()).select("index", F.concat_ws("_", "column", "level").alias("name"))
        return VectorFeatures([*self._spec()["numeric"], *[r["name"] for r in named.orderBy("index").collect()]])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spec, out = self._spec(), dataset
        keep = [c for c in dataset.columns if c not in [c for c, _ in spec["categorical"]]]
        slots = {}
        for i, (c, n) in enumerate(spec["categorical"]):
            if n < 2:
                continue  # the baseline alone has no place in the vector
            # Places 0..n-2 for the levels after the baseline; the last one, which the encoder drops, for all else.
            place = F.coalesce(F.col(f"_wl_place{i}"), F.lit(n - 1)).cast("double").alias(f"_wl_slot{i}")
            if c in dataset.columns:
                own = self.levels.where((F.col("column") == c) & (F.col("position") > 0)).select(
                    F.col("level").alias(f"_wl_level{i}"), (F.col("position") - 1).alias(f"_wl_place{i}"))
                out = out.join(own, F.col(c).cast("string") == F.col(f"_wl_level{i}"), "left")
                out = out.select(*[x for x in out.columns if not x.startswith((f"_wl_level{i}", f"_wl_place{i}"))], place)
            else:
                out = out.withColumn(f"_wl_slot{i}", F.lit(float(n - 1)))
            slots[f"_wl_slot{i}"] = n
        vectors = []
        if slots:
            spark = dataset.sparkSession
            sizes = spark.createDataFrame([tuple(float(n - 1) for n in slots.values())], list(slots))
            encoder = OneHotEncoder(inputCols=list(slots), outputCols=[f"{s}_v" for s in slots], dropLast=True).fit(sizes)
            out, vectors = encoder.transform(out), [f"{s}_v" for s in slots]
        numbers = []
        for i, c in enumerate(spec["numeric"]):
            out = out.withColumn(f"_wl_num{i}", F.col(c).cast("double") if c in dataset.columns else F.lit(0.0))
            numbers.append(f"_wl_num{i}")
        out = VectorAssembler(inputCols=[*numbers, *vectors], outputCol=VECTOR, handleInvalid="keep").transform(out)
        names = [{"idx": i, "name": n} for i, n in enumerate(self.feature_names())]
        attrs = {"ml_attr": {"attrs": {"numeric": names}, "num_attrs": len(names)}}
        return out.select(*keep, F.col(VECTOR).alias(VECTOR, metadata=attrs))

    def write(self) -> MLWriter:
        return _LevelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelReader(cls)


class _LevelWriter(MLWriter):
    def __init__(self, stage: LevelEncoder):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.levels.write.mode("overwrite").parquet(f"{path}/levels")


class _LevelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LevelEncoder:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.cls(levels=spark.read.parquet(f"{path}/levels"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


def fit_levels(df: DataFrame, numeric=FEATURE_COLS_NUMERIC, categorical=FEATURE_COLS_CATEGORICAL) -> LevelEncoder:
    """The encoder of the columns of ``df``; its level table is written once."""
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    if categorical:
        levels = materialize(level_table(df, categorical, len(numeric)), "level-table")
        sizes = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.max("n_levels").alias("n")).collect()}
    else:
        levels = df.sparkSession.createDataFrame([], "column string, level string, position long, n_levels long, index long")
        sizes = {}
    return LevelEncoder(levels, {"numeric": numeric, "categorical": [[c, int(sizes.get(c, 0))] for c in categorical]})
