"""Model directories."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model, path: str, overwrite: bool = False) -> str:
    """Save a fitted model; without ``overwrite`` an existing path is an error."""
    writer = model.write()
    if overwrite:
        writer = writer.overwrite()
    writer.save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
