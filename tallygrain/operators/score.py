"""Batch scoring with input and output contracts."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrain.functions.amounts import risk_category

# The scoring request, all fields required.
REQUEST_FIELDS = {
    "customer_id": "string",
    "transaction_amount": "double",
    "transaction_count": "long",
    "avg_transaction_amount": "double",
    "days_since_last_transaction": "long",
}


def check_requests(df: DataFrame, fields: dict[str, str] = REQUEST_FIELDS) -> DataFrame:
    """Typed request fields plus ``reason``, NULL when the row is valid."""
    typed, reasons = {}, []
    for name, dtype in fields.items():
        if name not in df.columns:
            typed[name] = F.lit(None).cast(dtype)
            reasons.append(F.lit(f"{name} is missing"))
            continue
        raw = F.col(name)
        value = raw.try_cast(dtype)
        if dtype in ("long", "int"):
            value = F.when(raw.try_cast("double") == F.floor(raw.try_cast("double")), raw.try_cast("double").cast(dtype))
        typed[name] = value
        reasons.append(
            F.when(raw.isNull(), F.lit(f"{name} is missing")).when(value.isNull(), F.lit(f"{name} is not a {dtype}"))
        )
    return df.withColumns({**typed, "reason": F.nullif(F.concat_ws("; ", *reasons), F.lit(""))})


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("reason")


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull())


def score_column(df: DataFrame) -> Column:
    """The score of a transformed table: its own risk_score or the class-1 probability."""
    if "risk_score" in df.columns:
        return F.col("risk_score")
    return vector_to_array("probability")[1]


def score(model: Transformer, df: DataFrame, key: str = "customer_id", version: str = "1.0.0") -> DataFrame:
    """key, risk_score, risk_category, model_version; works on batches and streams."""
    out = model.transform(df)
    risk = score_column(out)
    return out.select(
        key,
        risk.cast(T.DoubleType()).alias("risk_score"),
        risk_category(risk).alias("risk_category"),
        F.lit(version).alias("model_version"),
    )


def contract_violations(scored: DataFrame) -> DataFrame:
    """Rows whose score is missing or outside [0, 1]; there should be none."""
    s = F.col("risk_score")
    return scored.where(s.isNull() | F.isnan(s) | (s < 0) | (s > 1))
