"""Supervised preprocessing: clean, split, fit features on train, weigh by evidence."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns, require_columns
from tallygrain.functions.casts import coerce_and_drop
from tallygrain.functions.timefeat import TIME_FEATURES, add_time_features
from tallygrain.operators.encode import INFREQUENT, DropConstant, Fill, RareCategories, Scale, frequent_flags
from tallygrain.operators.merchant import MerchantProfiles
from tallygrain.operators.profile import PROFILE_FEATURES, CustomerProfiles
from tallygrain.operators.split import grouped_split, stratified_split
from tallygrain.operators.target import proxy_target
from tallygrain.operators.woe import WeightOfEvidence
from tallygrain.session import materialize

RFM_TARGET = "is_high_risk"
MIN_FREQUENCY = 0.01


@dataclass
class FeatureUnion:
    """Customer, time, merchant, numeric and category blocks fitted on training rows.

    Every output column has a name; the blocks are columns of one table, so there
    is nothing to align.
    """

    customers: CustomerProfiles
    merchants: MerchantProfiles
    numeric: list[str]
    categorical: list[str]
    fills: object
    modes: object
    rare: RareCategories
    constant: object
    scales: object
    names: list[str]

    @staticmethod
    def _blocks(df, customers, merchants, cols: TxColumns) -> DataFrame:
        return add_time_features(merchants.transform(customers.transform(df)), cols.time)

    @classmethod
    def fit(
        cls, train: DataFrame, numeric: list[str], categorical: list[str], cols: TxColumns = DEFAULT
    ) -> FeatureUnion:
        customers = CustomerProfiles.fit(train, cols)
        merchants = MerchantProfiles.fit(train, cols)
        numeric = [c for c in numeric if c in train.columns]
        categorical = [c for c in categorical if c in train.columns]
        merchant_names = merchants.feature_names()
        inputs = cls._inputs(train, numeric, categorical)
        rows, _ = materialize(cls._blocks(inputs, customers, merchants, cols), "union")
        # Profile and time features have no gaps, so only these need a median.
        gaps = [f"num_{c}" for c in numeric] + [c for c in merchant_names if c not in ("merchant_avg_amount", "merchant_tx_count")]
        fills = Fill.using(columns=gaps, strategy="median").fit(rows)
        filled = fills.transform(rows)
        variable = [c for c in [*PROFILE_FEATURES, *[f"num_{c}" for c in numeric]] if c in filled.columns]
        constant = DropConstant.using(columns=variable).fit(filled)
        kept = constant.transform(filled)
        scaled_names = [
            c for c in [*PROFILE_FEATURES, *TIME_FEATURES, *merchant_names, *[f"num_{c}" for c in numeric]] if c in kept.columns
        ]
        scales = Scale.using(columns=scaled_names, method="standard").fit(kept)
        modes = Fill.using(columns=[f"cat_{c}" for c in categorical], strategy="most_frequent").fit(rows) if categorical else None
        kept_categories = [c for c in categorical if modes and f"cat_{c}" not in modes.configuration()["dropped"]]
        rare = RareCategories.fit(modes.transform(rows) if modes else rows, [f"cat_{c}" for c in kept_categories], MIN_FREQUENCY)
        flags = [
            f"{c[4:]}={v}" for c, often in rare.frequent.items() for v in [*often, *([INFREQUENT] if rare.rare[c].rows else [])]
        ]
        return cls(customers, merchants, numeric, kept_categories, fills, modes, rare, constant, scales, [*scaled_names, *flags])

    @staticmethod
    def _inputs(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
        """Copies of the plain inputs; the joins below may replace equally named columns."""
        return df.withColumns(
            {
                **{f"num_{c}": F.col(c).cast("double") for c in numeric},
                **{f"cat_{c}": F.col(c).cast("string") for c in categorical},
            }
        )

    def transform(self, df: DataFrame, cols: TxColumns = DEFAULT, keep: list[str] = ()) -> DataFrame:
        """The ``keep`` columns and all features, in the order of ``names``."""
        held = df.withColumns({f"_keep_{c}": F.col(c) for c in keep}) if keep else df
        inputs = self._inputs(held, self.numeric, self.categorical)
        rows = self._blocks(inputs, self.customers, self.merchants, cols)
        rows = self.scales.transform(self.constant.transform(self.fills.transform(rows)))
        if self.modes:
            present = {c: v for c, v in self.modes.configuration()["fill"].items() if c in rows.columns}
            rows = rows.fillna(present) if present else rows
        rows = self.rare.transform(rows)
        flags = {}
        for c, often in self.rare.frequent.items():
            for v, flag in frequent_flags(F.col(c), [*often, *([INFREQUENT] if self.rare.rare[c].rows else [])]).items():
                flags[f"{c[4:]}={v}"] = flag
        out = [flags[n].alias(n) if n in flags else F.col(f"`{n}`") for n in self.names]
        return rows.select(*[F.col(f"_keep_{c}").alias(c) for c in keep], *out)


@dataclass
class Preprocessed:
    train: DataFrame
    test: DataFrame | None
    feature_names: list[str]
    label: str | None


def preprocess_data(
    df: DataFrame,
    numerical_cols: list[str],
    categorical_cols: list[str],
    target_col: str | None = None,
    cols: TxColumns = DEFAULT,
    test_size: float = 0.2,
    seed: int = 42,
    create_rfm_target: bool = True,
    rfm_target_col: str = RFM_TARGET,
    drop_original: bool = True,
    money_scale: int | None = None,
) -> Preprocessed:
    """Features for training and test rows, fitted on the training rows only.

    Without a target a proxy label is made (and customers are split as groups);
    with ``create_rfm_target`` off there is no label and no split.
    """
    made_target = False
    if target_col is None and create_rfm_target and all(c in df.columns for c in (cols.customer, cols.time, cols.amount)):
        df, _ = proxy_target(coerce_and_drop(df, cols.customer, cols.time, cols.amount), cols, money_scale=money_scale)
        df = df.drop("risk_rank", "rfm_score")
        if rfm_target_col != RFM_TARGET:
            df = df.withColumnRenamed(RFM_TARGET, rfm_target_col)
        target_col, made_target = rfm_target_col, True
    require_columns(
        df, {"customer_id": cols.customer, "date": cols.time, "amount": cols.amount, "merchant": cols.provider, "fraud": target_col}
    )
    rows, _ = materialize(coerce_and_drop(df, cols.customer, cols.time, cols.amount), "preprocess")
    numeric = [c for c in numerical_cols if c != target_col]
    categorical = [c for c in categorical_cols if c != target_col]
    # The label must not feed fraud features, so it is hidden from the feature blocks.
    inner = replace(cols, fraud="__no_fraud__") if target_col == cols.fraud else cols
    if target_col is None:
        union = FeatureUnion.fit(rows, numeric, categorical, inner)
        kept = [cols.transaction, *([] if drop_original else [c for c in rows.columns if c != cols.transaction])]
        return Preprocessed(union.transform(rows, inner, kept), None, union.names, None)
    if made_target:
        train, test = grouped_split(rows, cols.customer, target_col, test_size, seed)
    else:
        train, test = stratified_split(rows, cols.transaction, target_col, test_size, seed)
    union = FeatureUnion.fit(train.drop(target_col), numeric, categorical, inner)
    keep = [cols.transaction, target_col] if drop_original else [c for c in rows.columns]
    train_features, _ = materialize(union.transform(train, inner, keep), "train-features")
    test_features = union.transform(test, inner, keep)
    woe = WeightOfEvidence.using(label=target_col, columns=union.names).fit(train_features)
    weighed = set(woe.configuration()["bins"])
    names = [f"{c}_woe" if c in weighed else c for c in union.names]

    def finish(part: DataFrame) -> DataFrame:
        done = woe.transform(part)
        return done.select(*keep, *[F.col(f"`{c}`").alias(n) for c, n in zip(union.names, names)])

    return Preprocessed(finish(train_features), finish(test_features), names, target_col)
