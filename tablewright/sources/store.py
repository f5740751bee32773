"""Persistence of fitted objects: parameter objects as JSON rows, MLlib models in their own format."""

from __future__ import annotations

import dataclasses
import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_params(spark: SparkSession, params, path: str) -> None:
    """Write a fitted dataclass as one JSON row."""
    body = json.dumps({"kind": type(params).__name__, "fields": dataclasses.asdict(params)})
    spark.createDataFrame([(body,)], "params string").coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, kind: type, path: str):
    body = json.loads(spark.read.parquet(path).first()["params"])
    if body["kind"] != kind.__name__:
        raise ValueError(f"{path} holds {body['kind']}, not {kind.__name__}")
    return kind(**body["fields"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
