"""Imputers, scalers, encoders and selectors, fitted by one aggregate each."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.operators.clean import modal_values
from tallygrain.operators.fitted import ColumnEstimator, FittedColumns
from tallygrain.operators.joins import Lookup, build_lookup, lookup_join
from tallygrain.operators.order_stats import exact_quantiles

INFREQUENT = "__infrequent"


class FilledColumns(FittedColumns):
    def _transform(self, df: DataFrame) -> DataFrame:
        state = self.configuration()
        out = {}
        for c, value in state["fill"].items():
            column = F.col(c).cast("double") if isinstance(value, float) else F.col(c)
            if isinstance(value, float):
                column = F.nanvl(column, F.lit(None))
            out[c] = F.coalesce(column, F.lit(value))
        return df.withColumns(out).drop(*state["dropped"])


class Fill(ColumnEstimator):
    """median (exact), mean, most_frequent or constant.

    A numeric column without any value is dropped, as there is nothing to fill with.
    """

    def learn(self, df: DataFrame, columns: list[str], strategy: str = "median", value=None) -> FilledColumns:
        if strategy == "constant":
            fill = {c: value for c in columns}
        elif strategy == "median":
            fill = {c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in columns}).items()}
        elif strategy == "mean":
            row = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"{i}") for i, c in enumerate(columns)]).first()
            fill = {c: row[i] for i, c in enumerate(columns)}
        elif strategy == "most_frequent":
            fill = modal_values(df, columns)
        else:
            raise ValueError(f"unknown strategy: {strategy}")
        known = {c: v for c, v in fill.items() if v is not None}
        dropped = [c for c in columns if c not in known] if strategy != "constant" else []
        return FilledColumns.of({"fill": known, "dropped": dropped})


class ScaledColumns(FittedColumns):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(shift)) / F.lit(scale)
                for c, (shift, scale) in self.configuration()["scales"].items()
            }
        )


class Scale(ColumnEstimator):
    """standard (population deviation), scale_only, minmax or robust (median, IQR).

    A constant column has scale 1: it is shifted only.
    """

    def learn(self, df: DataFrame, columns: list[str], method: str = "standard") -> ScaledColumns:
        scales: dict[str, tuple[float, float]] = {}
        if method == "robust":
            for c, (low, mid, high) in exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}).items():
                scales[c] = (mid or 0.0, ((high - low) if high is not None else 0.0) or 1.0)
            return ScaledColumns.of({"scales": scales})
        if method not in ("standard", "scale_only", "minmax"):
            raise ValueError(f"unknown scaling method: {method}")
        pick = {"a": F.avg, "s": F.stddev_pop, "low": F.min, "high": F.max}
        row = df.agg(
            *[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in pick.items()]
        ).first()
        for i, c in enumerate(columns):
            mean, std, low, high = (row[f"{k}{i}"] or 0.0 for k in pick)
            if method == "minmax":
                scales[c] = (low, (high - low) or 1.0)
            else:
                # Merged partial deviations of a constant may differ from 0 by rounding.
                scales[c] = (mean if method == "standard" else 0.0, (std if low < high else 0.0) or 1.0)
        return ScaledColumns.of({"scales": scales})


class SelectedColumns(FittedColumns):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.configuration()["dropped"])


class DropConstant(ColumnEstimator):
    """Drop the listed columns whose variance is 0."""

    def learn(self, df: DataFrame, columns: list[str]) -> SelectedColumns:
        row = df.agg(
            *[F.min(c).alias(f"a{i}") for i, c in enumerate(columns)],
            *[F.max(c).alias(f"b{i}") for i, c in enumerate(columns)],
        ).first()
        return SelectedColumns.of({"dropped": [c for i, c in enumerate(columns) if row[f"a{i}"] == row[f"b{i}"]]})


class RareCategories:
    """Collapse categories that cover less than ``min_frequency`` of the rows.

    At most 1 / min_frequency categories are frequent, so those are literals. The
    rare ones can be any number: they stay in a table, and are told apart from
    categories never seen in the fit, which become NULL (all zeros when encoded).
    """

    def __init__(self, frequent: dict[str, list[str]], rare: dict[str, Lookup]):
        self.frequent = frequent
        self.rare = rare

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], min_frequency: float = 0.01) -> RareCategories:
        total = df.count()
        frequent, rare = {}, {}
        for c in columns:
            counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias(c)).agg(F.count("*").alias("n"))
            often = F.col("n") >= F.lit(min_frequency * total)
            # Pigeonhole: no more than 1 / min_frequency values reach that count.
            frequent[c] = sorted(r[c] for r in counts.where(often).select(c).collect())
            rare[c] = build_lookup(counts.where(~often).withColumn("_rare", F.lit(True)), [c], "rare", "n")
        return cls(frequent, rare)

    def transform(self, df: DataFrame) -> DataFrame:
        for c, often in self.frequent.items():
            df = df.withColumn(c, F.col(c).cast("string"))
            if self.rare[c].rows:
                df = lookup_join(df, self.rare[c]).drop("n")
                rare = F.col("_rare")
            else:
                rare = F.lit(False)
            is_frequent = F.col(c).isin(often) if often else F.lit(False)
            df = df.withColumn(c, F.when(is_frequent, F.col(c)).when(rare, F.lit(INFREQUENT))).drop("_rare")
        return df


def one_hot_stages(columns: list[str]) -> list:
    """Indexer and encoder with sorted categories; an unknown value is all zeros."""
    if not columns:
        return []
    indexed = [f"{c}__index" for c in columns]
    return [
        StringIndexer(inputCols=columns, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}__onehot" for c in columns], dropLast=True),
    ]


def preprocessing(
    numeric: list[str],
    categorical: list[str],
    numeric_strategy: str = "median",
    categorical_strategy: str = "constant",
    scaling: str | None = "standard",
    output: str = "features",
) -> Pipeline:
    """Impute, scale, encode and assemble; other columns do not enter the vector."""
    stages = []
    if numeric:
        stages.append(Fill.using(columns=numeric, strategy=numeric_strategy, value=0.0))
        if scaling:
            stages.append(Scale.using(columns=numeric, method=scaling))
    if categorical:
        stages.append(Fill.using(columns=categorical, strategy=categorical_strategy, value="missing"))
        stages += one_hot_stages(categorical)
    stages.append(
        VectorAssembler(inputCols=[*numeric, *[f"{c}__onehot" for c in categorical]], outputCol=output, handleInvalid="keep")
    )
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of the vector's entries, from the metadata the stages leave behind."""
    attrs = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    entries = [a for group in attrs.values() for a in group]
    names = [a.get("name", str(a["idx"])) for a in sorted(entries, key=lambda a: a["idx"])]
    return [n.replace("__onehot_", "_") for n in names]


def vector_to_columns(df: DataFrame, vector: str, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """The entries of a vector as named columns, next to ``keep`` (default: all other columns)."""
    values = vector_to_array(F.col(vector))
    kept = [c for c in df.columns if c != vector] if keep is None else keep
    return df.select(*kept, *[values[i].alias(n) for i, n in enumerate(names)])


def frequent_flags(column: Column, values: list[str]) -> dict[str, Column]:
    return {v: F.coalesce(column == v, F.lit(False)).cast("int") for v in values}
