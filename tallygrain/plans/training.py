"""Training job: customer dataset in, best model with its records out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallygrain.columns import numeric_columns
from tallygrain.operators.split import stratified_split
from tallygrain.operators.train import (
    SEARCH_SPACES,
    Trained,
    best_family,
    feature_importance,
    predictions,
    preprocessed_head,
    train_families,
)
from tallygrain.sources.readers import read_parquet
from tallygrain.sources.runs import save_model


def train_on_dataset(
    dataset: DataFrame,
    key: str = "CustomerId",
    label: str = "is_high_risk",
    families: dict[str, dict] = SEARCH_SPACES,
    n_iter: int = 10,
    folds: int = 5,
    test_size: float = 0.2,
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[dict[str, Trained], str, DataFrame]:
    """Search every family on the training part; the test part picks the winner."""
    train, test = stratified_split(dataset, key, label, test_size, seed)
    numeric = numeric_columns(dataset, [key, label])
    text = [f.name for f in dataset.schema.fields if f.dataType.typeName() == "string" and f.name not in (key, label)]
    head = preprocessed_head(numeric, text)
    results = train_families(train, label, key, numeric, test, families, n_iter, folds, seed, parallelism, head)
    return results, best_family(results), test


def run_training(
    spark: SparkSession, data_path: str, output_dir: str, moment: datetime | None = None, **options
) -> tuple[str, dict[str, Trained]]:
    """Read the dataset, train, save the best model with metrics, importances and search."""
    dataset = read_parquet(spark, data_path)
    results, winner, test = train_on_dataset(dataset, **options)
    best = results[winner]
    importances = feature_importance(best.model, predictions(best.model, test))
    search = spark.createDataFrame(best.search, "settings string, cv_score double") if best.search else None
    path = save_model(best.model, output_dir, winner, best.test_metrics, importances, search, moment)
    return path, results
