"""Base for fitted column transformations whose state is small and JSON-like."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame


class _Configured(Params):
    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    def configuration(self) -> dict:
        return json.loads(self.getOrDefault(self.settings))


class FittedColumns(Model, _Configured, DefaultParamsReadable, DefaultParamsWritable):
    """A model that is fully described by a JSON document, so Spark can persist it."""

    @keyword_only
    def __init__(self, settings: str = "{}"):
        super().__init__()
        self._set(settings=settings)

    @classmethod
    def of(cls, state: dict) -> FittedColumns:
        return cls(settings=json.dumps(state))


class ColumnEstimator(Estimator, _Configured, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator configured by a JSON document."""

    @keyword_only
    def __init__(self, settings: str = "{}"):
        super().__init__()
        self._set(settings=settings)

    @classmethod
    def using(cls, **settings) -> ColumnEstimator:
        return cls(settings=json.dumps(settings))

    def _fit(self, df: DataFrame) -> FittedColumns:
        return self.learn(df, **self.configuration())

    def learn(self, df: DataFrame, **settings) -> FittedColumns:
        raise NotImplementedError
