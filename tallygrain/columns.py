"""Column roles of the transaction table, its schema, and schema-level helpers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class TxColumns:
    """Which column plays which role. Every operator takes one of these."""

    transaction: str = "TransactionId"
    customer: str = "CustomerId"
    time: str = "TransactionStartTime"
    amount: str = "Amount"
    value: str = "Value"
    provider: str = "ProviderId"
    product: str = "ProductId"
    category: str = "ProductCategory"
    channel: str = "ChannelId"
    fraud: str = "FraudResult"


DEFAULT = TxColumns()

# Column names, types and descriptions of the transaction table.
TRANSACTION_COLUMNS = [
    ("TransactionId", T.StringType(), "Unique transaction identifier"),
    ("BatchId", T.StringType(), "Batch identifier for processing"),
    ("AccountId", T.StringType(), "Customer account ID"),
    ("SubscriptionId", T.StringType(), "Subscription ID"),
    ("CustomerId", T.StringType(), "Customer identifier"),
    ("CurrencyCode", T.StringType(), "Transaction currency"),
    ("CountryCode", T.StringType(), "Country code"),
    ("ProviderId", T.StringType(), "Service provider"),
    ("ProductId", T.StringType(), "Product identifier"),
    ("ProductCategory", T.StringType(), "Product category"),
    ("ChannelId", T.StringType(), "Transaction channel (web, mobile, etc.)"),
    ("Amount", T.DoubleType(), "Transaction amount (positive for debits, negative for credits)"),
    ("Value", T.DoubleType(), "Absolute transaction value"),
    ("TransactionStartTime", T.TimestampType(), "Transaction timestamp"),
    ("PricingStrategy", T.IntegerType(), "Pricing category"),
    ("FraudResult", T.IntegerType(), "Target: 1 for fraud, 0 for legitimate"),
]

DESCRIPTIONS = {name: text for name, _, text in TRANSACTION_COLUMNS}


def transaction_schema(with_fraud: bool = True) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, dtype, True, {"comment": text})
            for name, dtype, text in TRANSACTION_COLUMNS
            if with_fraud or name != "FraudResult"
        ]
    )


def submission_schema() -> T.StructType:
    return T.StructType([f for f in transaction_schema().fields if f.name in ("TransactionId", "FraudResult")])


_NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_CATEGORICAL = (T.StringType, T.BooleanType)
_DATETIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _of_type(df: DataFrame, types: tuple, exclude) -> list[str]:
    skip = set(exclude or ())
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude=None) -> list[str]:
    """32- and 64-bit integers and floats; byte and short columns are in no class."""
    return _of_type(df, _NUMERIC, exclude)


def categorical_columns(df: DataFrame, exclude=None) -> list[str]:
    return _of_type(df, _CATEGORICAL, exclude)


def datetime_columns(df: DataFrame, exclude=None) -> list[str]:
    return _of_type(df, _DATETIME, exclude)


def numeric_categorical_columns(df: DataFrame, exclude=None) -> tuple[list[str], list[str]]:
    return numeric_columns(df, exclude), categorical_columns(df, exclude)


def require_columns(df: DataFrame, required: dict[str, str | None]) -> None:
    """Raise before any job starts when a named role has no column."""
    missing = [role for role, name in required.items() if name is not None and name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def drop_columns(df: DataFrame, names) -> DataFrame:
    """Drop by name; names that are absent are ignored."""
    return df.drop(*names)


def drop_unnamed(df: DataFrame, pattern: str = r"^Unnamed") -> DataFrame:
    return df.select([df[f"`{c}`"] for c in df.columns if not re.search(pattern, c)])


def first_of_each_name(df: DataFrame) -> DataFrame:
    """Keep the first column of every name when a frame carries duplicates."""
    positional = df.toDF(*[f"{i}" for i in range(len(df.columns))])
    seen: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        seen.setdefault(name, i)
    return positional.select([positional[f"`{i}`"].alias(name) for name, i in seen.items()])


def split_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Features and label as two projections of the same plan."""
    return df.drop(label), df.select(label)
