"""Fitted models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import MLReadable, MLWritable


def save_model(model: MLWritable, path: str, overwrite: bool = False) -> None:
    """Save, failing when the path is taken unless told to overwrite."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model(kind: type[MLReadable], path: str) -> Transformer:
    """A single model of a known class."""
    return kind.load(path)


def chain_models(*models: Transformer) -> PipelineModel:
    """Feature stages and a classifier saved apart, applied as one."""
    stages: list[Transformer] = []
    for model in models:
        stages.extend(model.stages if isinstance(model, PipelineModel) else [model])
    return PipelineModel(stages)
