"""The whole analysis as one call (M23): publish, describe, build features, train, save.

The tables are loaded once, into a published store; every later step queries the
store. Each step writes its result under ``out_dir`` and is then noted down with
what it was made from, so a run that was broken off goes on after its last
finished step, and a run over the same input only reads. The grid search keeps
its own table of finished fits. What a step writes on the way is deleted when the
step ends.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from wardlens.operators.descriptive import run_all_descriptive_queries
from wardlens.operators.features import build_cohort_features, feature_report
from wardlens.operators.modeling import TrainResult, merge_target, model_frame, readmission_frame, train_and_evaluate
from wardlens.operators.sequences import readmission_target
from wardlens.session import intermediates
from wardlens.sources.models import load_model
from wardlens.sources.store import POINTER, Files, load_quality, open_store, publish_store
from wardlens.sources.tables import load_and_publish, load_report, register_views


class StepLog:
    """Finished steps of a run: what each was made from and what it said, one small file per step."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.files, self.folder = Files(spark), f"{out_dir.rstrip('/')}/steps"

    def finished(self, step: str, made_from: str) -> dict | None:
        path = f"{self.folder}/{step}.json"
        if not self.files.exists(path):
            return None
        said = json.loads(self.files.read(path))
        return said if said["made_from"] == made_from else None

    def record(self, step: str, made_from: str, **said) -> dict:
        said = {"made_from": made_from, **said}
        self.files.write(f"{self.folder}/{step}.json", json.dumps(said))
        return said


def input_key(spark: SparkSession, data_dir: str | None, tables: dict[str, DataFrame] | None) -> str:
    """A name for the input files: their addresses, sizes and times of change."""
    files, seen = Files(spark), []
    if tables is None:
        for name, size, changed in sorted(files.list(data_dir)):
            inside = [] if size else sorted(files.list(f"{data_dir.rstrip('/')}/{name}"))
            seen.append([data_dir, name, size, changed, inside])
    else:
        for name, df in sorted(tables.items()):
            seen.append([name, df.schema.json(), [[f, files.list(f)] for f in sorted(df.inputFiles())]])
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()[:16]


def run_analysis(spark: SparkSession, data_dir: str | None = None, out_dir: str = "outputs", *,
                 tables: dict[str, DataFrame] | None = None, fmt: str = "csv",
                 grid: dict | None = None, resume: bool = True) -> dict:
    """Run the steps of the analysis; returns the written result tables and training results.

    ``tables`` may be given directly (e.g. stand-in views); otherwise they are
    loaded from ``data_dir``. Results are Parquet tables and saved models under
    ``out_dir``. With ``resume`` (the default), steps that ``out_dir`` holds for
    the same input are skipped.
    """
    log, out = StepLog(spark, out_dir), out_dir.rstrip("/")
    store, source = f"{out}/store", input_key(spark, data_dir, tables)

    def step(name: str, made_from: str, work) -> dict:
        said = log.finished(name, made_from) if resume else None
        if said is None:
            with intermediates(spark):
                said = log.record(name, made_from, **(work() or {}))
        return said

    def publish():
        if tables is None:
            return {"missing": load_and_publish(spark, data_dir, store, fmt), "version": log.files.read(f"{store}/{POINTER}").strip()}
        publish_store(tables, store)
        return {"missing": [], "version": log.files.read(f"{store}/{POINTER}").strip()}

    published = step("publish", source, publish)
    version = published["version"]
    held = open_store(spark, store)
    raw = {name: df for name, df in held.items() if name != "cohort_admissions"}
    register_views(raw)

    def written(name: str, made_from: str, build) -> DataFrame:
        """The result table ``name``, built and written unless this version's is there."""
        path = f"{out}/tables/{name}"
        step(f"table-{name}", made_from, lambda: build().write.mode("overwrite").parquet(path))
        return spark.read.parquet(path)

    results: dict = {"missing_tables": published["missing"]}
    plans = {"load_report": lambda: load_report(raw), "load_quality": lambda: load_quality(spark, store)}
    plans.update({name: (lambda df=df: df) for name, df in run_all_descriptive_queries(raw).items()})
    plans["cohort_features"] = lambda: build_cohort_features(held)
    plans["readmission_target"] = lambda: readmission_target(raw["admissions"], sort=False)
    for name, build in plans.items():
        results[name] = written(name, version, build)
    features, target = results["cohort_features"], results["readmission_target"]
    results["feature_report"] = written("feature_report", version, lambda: feature_report(features))

    frames = {"mortality": lambda: model_frame(features),
              "readmission": lambda: readmission_frame(merge_target(features, target))}
    for label, frame in frames.items():
        results[label] = _trained(spark, step, label, version, frame, out, grid)
    return results


def _trained(spark: SparkSession, step, label: str, version: str, frame, out: str, grid: dict | None) -> TrainResult:
    """One trained model with its tables, from its step's files."""
    model_path, made_from = f"{out}/{label}_model", json.dumps([version, grid], sort_keys=True)

    def train():
        res = train_and_evaluate(frame(), grid=grid, save_path=model_path, results_dir=f"{out}/grid/{label}-{version}")
        made = dict(res.tables)
        if res.importances is not None:
            made["feature_importance"] = res.importances
        for name, df in made.items():
            df.write.mode("overwrite").parquet(f"{out}/tables/{label}_{name}")
        return {"tables": list(made), "best": res.best_params, "folds": res.n_splits, "skipped": res.skipped_reason}

    said = step(f"model-{label}", made_from, train)
    made = {name: spark.read.parquet(f"{out}/tables/{label}_{name}") for name in said["tables"]}
    importances = made.pop("feature_importance", None)
    model = None if said["skipped"] else load_model(model_path)
    return TrainResult(model, importances, made, said["best"], said["folds"], said["skipped"])


def main(argv: list[str] | None = None) -> None:
    """``python -m wardlens.workflow DATA_DIR [OUT_DIR]``: run the analysis on CSV tables."""
    import sys

    from wardlens.session import get_spark

    args = sys.argv[1:] if argv is None else argv
    if not args:
        raise SystemExit("usage: python -m wardlens.workflow DATA_DIR [OUT_DIR]")
    spark = get_spark()
    res = run_analysis(spark, args[0], args[1] if len(args) > 1 else "outputs")
    for label in ("mortality", "readmission"):
        r = res[label]
        print(f"{label}: " + (f"skipped ({r.skipped_reason})" if r.model is None
                              else f"{r.n_splits} folds, best forest {r.best_params}"))


if __name__ == "__main__":
    main()
