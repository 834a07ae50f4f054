"""Saving and loading fitted models.

A model is a ``PipelineModel`` whose first stage is the fitted
:class:`~wardlens.operators.modeling.IndicatorEncoder`, so the levels and the
feature order travel with the model.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> str:
    """Write (replacing) the fitted pipeline to ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Read a saved pipeline; a missing path raises ``FileNotFoundError`` with a hint."""
    try:
        return PipelineModel.load(path)
    except Exception as exc:  # Spark raises a JVM/Analysis error for a missing path
        text = str(exc)
        if any(s in text for s in ("does not exist", "PATH_NOT_FOUND", "FileNotFound",
                                   "No such file", "InvalidInputException")):
            raise FileNotFoundError(
                f"{path} not found - train and save a model first "
                "(wardlens.workflow.run_analysis or modeling.train_and_evaluate)") from exc
        raise
