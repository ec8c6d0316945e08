"""Saved fitted transforms: one folder with a manifest, lookups as Parquet and ML stages as they are.

A folder holds ``manifest`` (one JSON document with the format's version, the kind and all small
settings), ``lookups/<name>`` and ``stages/<name>``. What was written is read again without a look
at the training rows, by batch and stream jobs of any session.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.operators.encode import FilledColumns, RareCategories, ScaledColumns, SelectedColumns
from tallygrain.operators.joins import Lookup
from tallygrain.operators.merchant import MerchantProfiles
from tallygrain.operators.profile import CustomerProfiles
from tallygrain.operators.train import Stacked
from tallygrain.plans.supervised import FeatureUnion

VERSION = 1


def write_manifest(spark: SparkSession, path: str, kind: str, document: dict) -> None:
    text = json.dumps({"version": VERSION, "kind": kind, **document}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str, kind: str) -> dict:
    document = json.loads(spark.read.text(f"{path}/manifest", wholetext=True).first()["value"])
    if document.get("kind") != kind:
        raise ValueError(f"{path} holds a {document.get('kind')}, not a {kind}")
    if document["version"] > VERSION:
        raise ValueError(f"{path} is of version {document['version']}, this library reads up to {VERSION}")
    return document


def write_lookup(lookup: Lookup, path: str, name: str) -> dict:
    """Copies the table; the returned facts go to the manifest."""
    lookup.table.write.parquet(f"{path}/lookups/{name}")
    facts = {"keys": list(lookup.keys), "rows": lookup.rows, "bytes": lookup.bytes, "weight": lookup.weight, "total_weight": lookup.total_weight}
    return facts | {"schema": lookup.table.schema.json()}


def read_lookup(spark: SparkSession, path: str, name: str, facts: dict) -> Lookup:
    schema = StructType.fromJson(json.loads(facts["schema"]))
    table = spark.read.schema(schema).parquet(f"{path}/lookups/{name}")
    return Lookup(table, tuple(facts["keys"]), facts["rows"], facts["bytes"], facts["weight"], facts["total_weight"])


def save_union(union: FeatureUnion, path: str) -> str:
    """A fitted feature union: profiles, merchants, affinity and rare categories as lookups, the rest as settings."""
    spark = union.customers.lookup.table.sparkSession
    lookups = {"customers": union.customers.lookup, "merchants": union.merchants.merchants, "affinity": union.merchants.affinity}
    lookups |= {f"rare-{i}": union.rare.rare[c] for i, c in enumerate(union.rare.frequent)}
    stages = {"fills": union.fills, "modes": union.modes, "constant": union.constant, "scales": union.scales}
    document = {
        "numeric": union.numeric, "categorical": union.categorical, "names": union.names, "frequent": list(union.rare.frequent.items()),
        "customer_columns": asdict(union.customers.cols), "merchant_columns": asdict(union.merchants.cols), "with_fraud": union.merchants.with_fraud,
        "settings": {k: v.configuration() if v else None for k, v in stages.items()},
        "lookups": {name: write_lookup(lookup, path, name) for name, lookup in lookups.items()},
    }
    write_manifest(spark, path, "feature union", document)
    return path


def load_union(spark: SparkSession, path: str) -> FeatureUnion:
    saved = read_manifest(spark, path, "feature union")
    lookup = lambda name: read_lookup(spark, path, name, saved["lookups"][name])
    kinds = {"fills": FilledColumns, "modes": FilledColumns, "constant": SelectedColumns, "scales": ScaledColumns}
    stages = {k: kind.of(saved["settings"][k]) if saved["settings"][k] is not None else None for k, kind in kinds.items()}
    frequent = dict(saved["frequent"])
    return FeatureUnion(
        customers=CustomerProfiles(lookup("customers"), TxColumns(**saved["customer_columns"])),
        merchants=MerchantProfiles(lookup("merchants"), lookup("affinity"), TxColumns(**saved["merchant_columns"]), saved["with_fraud"]),
        numeric=saved["numeric"],
        categorical=saved["categorical"],
        rare=RareCategories(frequent, {c: lookup(f"rare-{i}") for i, c in enumerate(frequent)}),
        names=saved["names"],
        **stages,
    )


@dataclass
class FittedPipeline:
    """A feature union and the model that was trained on its features; transforms batches and streams of transactions."""

    union: FeatureUnion
    model: PipelineModel
    keep: list[str]
    cols: TxColumns = DEFAULT

    def transform(self, df: DataFrame) -> DataFrame:
        """The ``keep`` columns, the features and what the model adds."""
        return self.model.transform(self.union.transform(df, self.cols, self.keep))

    def save(self, path: str) -> str:
        spark = self.union.customers.lookup.table.sparkSession
        save_union(self.union, f"{path}/union")
        self.model.write().save(f"{path}/stages/model")
        write_manifest(spark, path, "pipeline", {"keep": list(self.keep), "columns": asdict(self.cols), "model": type(self.model).__name__})
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedPipeline:
        saved = read_manifest(spark, path, "pipeline")
        model = (Stacked if saved["model"] == "Stacked" else PipelineModel).load(f"{path}/stages/model")
        return cls(load_union(spark, f"{path}/union"), model, saved["keep"], TxColumns(**saved["columns"]))
