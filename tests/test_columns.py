from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallygrain import columns as C
from tallygrain.functions import amounts, casts, timefeat
from tallygrain.operators import behavior, clean, outliers


def one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_days_are_whole_24_hour_periods(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 1, 2, 0, 30), datetime(2023, 1, 1, 0, 31)), (datetime(2023, 1, 2, 0, 31), datetime(2023, 1, 1, 0, 31)), (datetime(2023, 1, 1), datetime(2023, 1, 1, 1))],
        "a timestamp, b timestamp",
    )
    assert one(df, timefeat.floor_days(F.col("a"), F.col("b"))) == [0, 1, -1]


def test_amount_classes(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 99.9, 100.0, 500.0, 1000.0, 4999.9, 5000.0, None)], "v double")
    want = [None, "0-100", "0-100", "100-500", "500-1000", "1000-5000", "1000-5000", "5000+", None]
    assert one(df, amounts.amount_category(F.col("v"))) == want


def test_segments_and_risk_categories(spark):
    df = spark.createDataFrame([(s,) for s in (3, 4, 5, 8, 9, 12, 13, 15)], "s int")
    assert one(df, amounts.segment(F.col("s"))) == ["Low", "Low", "Medium", "Medium", "High", "High", "Top", "Top"]
    df = spark.createDataFrame([(s,) for s in (0.0, 0.29, 0.3, 0.69, 0.7, 1.0, None)], "s double")
    assert one(df, amounts.risk_category(F.col("s"))) == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", None]


def test_time_features_at_the_borders(spark):
    hours = [0, 5, 6, 7, 9, 10, 16, 17, 19, 22]
    df = spark.createDataFrame([(datetime(2023, 12, 2, h),) for h in hours], "t timestamp")
    out = timefeat.add_time_features(df, "t").orderBy("t").toPandas()
    assert len(out.columns) == 1 + 14
    assert out["is_night"].tolist() == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    assert out["is_morning_rush"].tolist() == [0, 0, 0, 1, 1, 0, 0, 0, 0, 0]
    assert out["is_business_hours"].tolist() == [0, 0, 0, 0, 1, 1, 1, 0, 0, 0]
    assert out["is_evening_rush"].tolist() == [0, 0, 0, 0, 0, 0, 1, 1, 0, 0]
    assert set(out["is_weekend"]) == {1} and set(out["season"]) == {1}


def test_cyclical_by_maximum_is_null_where_the_maximum_is_zero(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2023-01-01', timestamp'2023-12-31', interval 1 day)) AS t")
    out = timefeat.add_cyclical_by_max(df, "t", "d").toPandas()
    assert out["d_hour_sin"].isna().all() and out["d_minute_cos"].isna().all()
    assert out["d_month_sin"].notna().all() and out["d_dayofyear"].max() == 365


def test_casts(spark):
    df = spark.createDataFrame([("1", "x", "False", 0), ("2.5", "3.5", "", 2), (None, None, None, None)], "a string, b string, c string, d int")
    out = casts.convert_types(df, int_cols=["a", "nope"], float_cols=["b"], bool_cols=["c", "d"]).collect()
    assert [tuple(r) for r in out] == [(1, None, True, False), (None, 3.5, False, True), (None, None, True, True)]
    with pytest.raises(Exception, match="not a whole number"):
        casts.convert_types(df, int_cols=["a"], strict=True).collect()


def test_label_from_class_counts_missing_as_zero(spark):
    df = spark.createDataFrame([("yes",), ("no",), (None,)], "default string")
    assert one(casts.label_from_class(df), "label") == [1, 0, 0]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 1.0, "a", True)], "i int, d double, s string, b boolean").withColumn("y", F.lit(1).cast("byte"))
    assert C.numeric_categorical_columns(df, ["d"]) == (["i"], ["s", "b"])
    assert C.first_of_each_name(df.select("i", "d", F.lit(9).alias("i"))).first() == (1, 1.0)
    assert C.drop_unnamed(df.withColumn("Unnamed: 3", F.lit(1))).columns == df.columns
    with pytest.raises(ValueError, match="merchant"):
        C.require_columns(df, {"id": "i", "merchant": "m", "fraud": None})


def test_typed_imputation(spark):
    df = spark.createDataFrame(
        [(None, 1, "UGX", " a "), (2.0, 2, "UGX", None), (3.0, None, None, "b"), (4.0, 10, "KES", "c")],
        "Amount double, PricingStrategy int, CurrencyCode string, Note string",
    )
    got = clean.trim_strings(clean.impute_typed(df)).collect()
    assert [tuple(r) for r in got] == [(0.0, 1, "UGX", "a"), (2.0, 2, "UGX", "unknown"), (3.0, 2, "UGX", "b"), (4.0, 10, "KES", "c")]


def test_clip_keeps_missing_values_and_unknown_method_fails(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + [1000]] + [(None,)], "v double")
    out = outliers.handle_outliers(df, ["v"], "clip", 3.0)
    assert out.where("v IS NULL").count() == 1 and out.agg(F.max("v")).first()[0] < 1000
    assert outliers.handle_outliers(df, ["v"], "remove").count() == 50
    with pytest.raises(ValueError):
        outliers.handle_outliers(df, ["v"], "other")


def test_modes_prefer_the_smallest_and_ignore_gaps(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, None), (2, None), (3, 4), (3, 4), (3, 0)], "g int, v int")
    got = df.groupBy("g").agg(behavior.small_domain_mode(F.col("v"), 7).alias("m")).orderBy("g").collect()
    assert [r["m"] for r in got] == [2, None, 4]
