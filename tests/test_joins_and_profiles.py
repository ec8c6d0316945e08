import pytest
from datetime import datetime

from pyspark.sql import functions as F

from tallygrain.columns import TxColumns
from tallygrain.operators.joins import build_lookup, lookup_join, semi_join
from tallygrain.operators import merchant
from tallygrain.operators.merchant import MerchantProfiles
from tallygrain.operators.profile import PROFILE_FEATURES, CustomerProfiles


def skewed_rows(spark):
    """A third of the rows has one key and another part has none."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(6000).select("id", key.alias("k"))


def test_salted_join_equals_broadcast_join(spark):
    rows = skewed_rows(spark)
    table = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    lookup = build_lookup(table, ["k"], "test", "n")
    assert lookup.rows == table.count() and lookup.total_weight == rows.where("k IS NOT NULL").count()
    plain = lookup_join(rows, lookup).select("id", "k", "top")
    for shares in (2000, 20, 3):
        salted = lookup_join(rows, lookup, broadcast_bytes=0, hot_shares=shares).select("id", "k", "top")
        assert salted.count() == 6000
        assert salted.exceptAll(plain).count() == 0
    assert plain.where("k IS NULL AND top IS NOT NULL").count() == 0


def test_salted_join_spreads_the_hot_key(spark):
    rows = skewed_rows(spark)
    table = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    lookup = build_lookup(table, ["k"], "test", "n")
    joined = lookup_join(rows.withColumn("x", F.lit(1)), lookup, broadcast_bytes=0, hot_shares=100)
    plan = joined._jdf.queryExecution().toString()
    assert "_salt" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_profiles_and_defaults_for_new_customers(spark):
    tx = spark.createDataFrame(
        [("t1", "a", datetime(2023, 1, 1, 10), 10.0, 0), ("t2", "a", datetime(2023, 1, 3, 9), -4.0, 1), ("t3", None, datetime(2023, 1, 5), 1.0, 0)],
        "TransactionId string, CustomerId string, TransactionStartTime timestamp, Amount double, FraudResult int",
    )
    profiles = CustomerProfiles.fit(tx)
    seen = profiles.transform(tx).where("TransactionId = 't1'").first()
    assert seen["recency_days"] == 2 and seen["days_since_first_tx"] == 4 and seen["transaction_count"] == 2
    assert seen["credit_ratio"] == 0.5 and seen["fraud_rate"] == 0.5 and seen["unique_days"] == 2 and seen["total_amount"] == 6.0
    new = profiles.transform(tx.withColumn("CustomerId", F.lit("z"))).first()
    assert [new[c] for c in PROFILE_FEATURES] == [365, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 365, 0.0, 0.0, 0.0, 1, 0.0, 0]


def test_merchants_and_affinity(spark):
    tx = spark.createDataFrame(
        [("a", "m", 10.0, 1), ("a", "m", 20.0, 0), ("a", "n", 5.0, 0), ("a", None, 1.0, 0), ("b", "n", 7.0, 0)],
        "CustomerId string, ProviderId string, Amount double, FraudResult int",
    )
    model = MerchantProfiles.fit(tx)
    got = {(r["CustomerId"], r["ProviderId"]): r for r in model.transform(tx).collect()}
    assert got[("a", "m")]["customer_merchant_affinity"] == 0.5 and got[("a", "m")]["merchant_avg_amount"] == 15.0
    assert got[("a", "n")]["merchant_tx_count"] == 2 and got[("b", "n")]["customer_merchant_affinity"] == 1.0
    new = model.transform(spark.createDataFrame([("b", "q", 1.0, 0)], tx.schema)).first()
    assert new["merchant_tx_count"] == 0 and new["customer_merchant_affinity"] is None
    cols = TxColumns(fraud="absent")
    assert "merchant_fraud_rate" not in MerchantProfiles.fit(tx, cols).feature_names()


def test_semi_join_keeps_rows_once(spark):
    wanted = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert semi_join(spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string"), wanted, "k").collect() == [(1, "x")]


def test_merchant_statistics_merge_from_pairs(spark):
    """Large amounts of little spread keep their digits; single rows and missing amounts as in one aggregation."""
    i = F.col("id")
    tx = spark.range(2000).select(
        (i % 37).alias("CustomerId"), F.when(i % 11 != 0, (i % 13).cast("string")).alias("ProviderId"),
        F.when(i % 17 != 0, F.lit(1e9) + F.sin(i.cast("double"))).alias("Amount"), (i % 5 == 0).cast("int").alias("FraudResult"),
    ).unionAll(spark.createDataFrame([(1, "single", 3.5, 1), (2, "none", None, 0)], "c long, p string, a double, f int"))
    pairs = merchant.pair_statistics(tx)
    want = {r["ProviderId"]: r for r in merchant.merchant_statistics(tx).collect()}
    got = {r["ProviderId"]: r for r in merchant.merchants_of_pairs(pairs).collect()}
    assert set(got) == set(want)
    for name, row in want.items():
        assert got[name]["merchant_tx_count"] == row["merchant_tx_count"] and got[name]["merchant_fraud_rate"] == pytest.approx(row["merchant_fraud_rate"])
        for column in ("merchant_avg_amount", "merchant_std_amount"):
            if row[column] is None:
                assert got[name][column] is None
            else:
                assert got[name][column] == pytest.approx(row[column], rel=1e-6 if column == "merchant_std_amount" else 1e-12)
