"""Run records: processing metadata, model runs, importances, search results."""

from __future__ import annotations

import json
import os
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

RUN_SCHEMA = (
    "model_name string, training_date string, metrics map<string,double>, "
    "feature_importances map<string,double>, model_type string"
)


def processing_metadata(df: DataFrame, target: str | None, moment: datetime | None = None) -> dict:
    target = target if target in df.columns else None
    features = [c for c in df.columns if c != target]
    return {
        "num_samples": df.count(),
        "features": features,
        "target": target,
        "num_features": len(features),
        "timestamp": (moment or datetime.now()).isoformat(),
    }


def metadata_table(spark: SparkSession, metadata: dict) -> DataFrame:
    row = (
        metadata["num_samples"],
        metadata["features"],
        metadata["target"],
        metadata["num_features"],
        metadata["timestamp"],
    )
    return spark.createDataFrame(
        [row], "num_samples long, features array<string>, target string, num_features int, timestamp string"
    )


def run_record(
    spark: SparkSession,
    model_name: str,
    metrics: dict[str, float],
    importances: dict[str, float] | None = None,
    model_type: str | None = None,
    moment: datetime | None = None,
) -> DataFrame:
    """One model run as a one-row table, ready to append to a ``runs`` table."""
    numbers = {k: float(v) for k, v in metrics.items() if v is not None}
    stamp = f"{(moment or datetime.now()):%Y%m%d_%H%M%S}"
    return spark.createDataFrame([(model_name, stamp, numbers, importances, model_type or model_name)], RUN_SCHEMA)


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").json(path)


def save_model(
    model: PipelineModel,
    folder: str,
    model_name: str,
    metrics: dict[str, float],
    importances: DataFrame | None = None,
    search: DataFrame | None = None,
    moment: datetime | None = None,
) -> str:
    """Model, run record, importances and search results below one dated folder. A stacked model is saved like any other."""
    spark = SparkSession.active()
    moment = moment or datetime.now()
    path = os.path.join(folder, f"{model_name}_{moment:%Y%m%d_%H%M%S}")
    model.write().save(os.path.join(path, "model"))
    listed = {r["feature"]: r["importance"] for r in importances.collect()} if importances is not None else None
    record = run_record(spark, model_name, metrics, listed, type(model.stages[-1]).__name__, moment)
    record.coalesce(1).write.json(os.path.join(path, "metadata"))
    for name, table in (("feature_importances", importances), ("cv_results", search)):
        if table is not None:
            table.coalesce(1).write.option("header", True).option("escape", '"').csv(os.path.join(path, name))
    return path


def load_model(path: str, kind: type = PipelineModel):
    """The saved model; ``kind`` is the class that reads it."""
    return kind.load(os.path.join(path, "model"))


def load_results(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The run record and, where they were saved, feature_importances and cv_results of a run's folder."""
    found = {"metadata": spark.read.schema(RUN_SCHEMA).json(os.path.join(path, "metadata"))}
    tables = {"feature_importances": "feature string, importance double", "cv_results": "settings string, cv_score double"}
    for name, schema in tables.items():
        try:
            found[name] = spark.read.schema(schema).option("header", True).option("escape", '"').csv(os.path.join(path, name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def params_text(params: dict) -> str:
    return json.dumps(params, sort_keys=True, default=str)
