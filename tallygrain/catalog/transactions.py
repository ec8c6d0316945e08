"""Transaction-grain queries: merchants, time, cleaning, casts, joins, files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallygrain.catalog.customers import PROFILE_ROUNDING, PROFILE_SQL, TARGET_SQL
from tallygrain.catalog.tables import EVENTS, LINES, ORDERS, events, lines, orders, rounded, table
from tallygrain.columns import (
    DESCRIPTIONS,
    categorical_columns,
    datetime_columns,
    drop_columns,
    drop_unnamed,
    first_of_each_name,
    numeric_columns,
    split_label,
    transaction_schema,
)
from tallygrain.functions import amounts, casts, timefeat
from tallygrain.operators import clean, eda, joins, merchant, outliers, rfm, split, target
from tallygrain.operators.profile import CustomerProfiles
from tallygrain.session import materialize, scratch_path
from tallygrain.sources import readers, runs, sinks

# ---- merchants -------------------------------------------------------------


def merchant_stats(spark, sf):
    df = merchant.merchant_statistics(lines(spark, sf))
    df = rounded(df, 4, "merchant_std_amount")
    return rounded(df, 6, "merchant_avg_amount", "merchant_fraud_rate")


def merchant_affinity(spark, sf):
    return rounded(merchant.merchant_affinity(lines(spark, sf)), 6, "affinity")


def tx_with_merchant(spark, sf):
    tx = lines(spark, sf)
    out = merchant.MerchantProfiles.fit(tx).transform(tx)
    out = rounded(out, 4, "merchant_std_amount")
    return rounded(out, 6, "merchant_avg_amount", "merchant_fraud_rate", "customer_merchant_affinity").select(
        "TransactionId", "CustomerId", "ProviderId", "Amount", *merchant.MERCHANT_FEATURES
    )


MERCHANT_SQL = f"""tx AS ({LINES}),
ms AS (SELECT ProviderId, ROUND(AVG(Amount), 6) AS merchant_avg_amount, ROUND(STDDEV_SAMP(Amount), 4) AS merchant_std_amount,
  COUNT(Amount) AS merchant_tx_count, ROUND(AVG(FraudResult), 6) AS merchant_fraud_rate FROM tx GROUP BY ProviderId),
pairs AS (SELECT CustomerId, ProviderId, COUNT(*) AS tx_count FROM tx GROUP BY CustomerId, ProviderId),
aff AS (SELECT p.*, t.total_tx, ROUND(tx_count / total_tx, 6) AS affinity FROM pairs p
  JOIN (SELECT CustomerId, COUNT(*) AS total_tx FROM tx GROUP BY CustomerId) t USING (CustomerId))"""


# ---- time ------------------------------------------------------------------


def tx_time_features(spark, sf):
    df = timefeat.add_time_parts(events(spark, sf).select("TransactionId", "TransactionStartTime"), "TransactionStartTime", "t")
    df = timefeat.add_activity_columns(df, "TransactionStartTime")
    return df.withColumn("transaction_date", F.date_format("TransactionStartTime", "yyyy-MM-dd")).drop("TransactionStartTime")


def plus_zero(df, places, *names):
    """Rounded, without negative zeros."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in names})


FIXED_WAVES = [f"{f}_{w}" for f in timefeat.FIXED_PERIODS for w in ("sin", "cos")]


def tx_cyclical_fixed(spark, sf):
    df = timefeat.add_time_features(events(spark, sf), "TransactionStartTime")
    return plus_zero(df.select("TransactionId", *FIXED_WAVES), 6, *FIXED_WAVES)


def season_flags(spark, sf):
    df = timefeat.add_time_features(events(spark, sf), "TransactionStartTime")
    return df.select("TransactionId", *[c for c in timefeat.TIME_FEATURES if c not in FIXED_WAVES])


def calendar_columns(spark, sf):
    """The calendar fields of the transaction path and of the preparation job."""
    df = events(spark, sf).select("TransactionId", "TransactionStartTime")
    df = timefeat.add_preparation_columns(timefeat.add_calendar_columns(df, "TransactionStartTime"), "TransactionStartTime")
    return df.drop("TransactionStartTime").withColumn("transaction_date", F.date_format("transaction_date", "yyyy-MM-dd"))


def tx_cyclical_max(spark, sf):
    df = timefeat.add_cyclical_by_max(events(spark, sf).select("TransactionId", "TransactionStartTime"), "TransactionStartTime", "t")
    names = [f"t_{f}_{w}" for f in timefeat.DEFAULT_CYCLIC for w in ("sin", "cos")]
    return plus_zero(df.select("TransactionId", *names), 6, *names)


SPARK_TO_SQL = {
    "month": "month(ts)",
    "day": "day(ts)",
    "hour": "hour(ts)",
    "minute": "minute(ts)",
    "dayofweek": "(isodow(ts) - 1)",
    "dayofyear": "dayofyear(ts)",
    "weekofyear": "weekofyear(ts)",
}


# ---- cleaning --------------------------------------------------------------

DIRTY = """SELECT event_id AS TransactionId, nullif(user_id, 3) AS CustomerId,
  CASE WHEN event_id % 11 = 0 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TimeText,
  CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS AmountText,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS Value, CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS Amount,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 2 END AS Score,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 100 AS INTEGER) END AS PricingStrategy,
  nullif(event_type, 'error') AS CurrencyCode, nullif(event_type, 'view') AS CountryCode,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE '  ' || event_type || ' ' END AS Note FROM events"""


def dirty_events(spark, sf):
    """Events with gaps and unreadable text put in."""
    e, i = table(spark, sf, "events"), F.col("event_id")
    return e.select(
        i.alias("TransactionId"),
        F.nullif("user_id", F.lit(3)).alias("CustomerId"),
        F.when(i % 11 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("TimeText"),
        F.when(i % 7 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("AmountText"),
        F.when(i % 5 != 0, F.col("value")).alias("Value"),
        F.when(i % 13 != 0, F.col("value")).alias("Amount"),
        F.when(i % 3 != 0, F.col("value") * 2).alias("Score"),
        F.when(i % 9 != 0, (i % 100).cast("int")).alias("PricingStrategy"),
        F.nullif("event_type", F.lit("error")).alias("CurrencyCode"),
        F.nullif("event_type", F.lit("view")).alias("CountryCode"),
        F.when(i % 4 != 0, F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("Note"),
    )


def fill_amounts(spark, sf):
    return clean.fill_amounts(dirty_events(spark, sf)).select("TransactionId", "Amount", "Value")


def impute_typed(spark, sf):
    return clean.impute_typed(dirty_events(spark, sf)).select(
        "TransactionId", "Amount", "Value", "Score", F.col("PricingStrategy").cast("double").alias("PricingStrategy"), "CurrencyCode", "CountryCode", "Note"
    )


def trim_strings(spark, sf):
    return clean.trim_strings(dirty_events(spark, sf)).select("TransactionId", "Note", F.length("Note").alias("length"))


def cast_types(spark, sf):
    df = casts.convert_types(
        dirty_events(spark, sf).withColumns({"Truth": F.col("PricingStrategy"), "TextTruth": F.nullif("CurrencyCode", F.lit("click"))}),
        int_cols=["AmountText", "absent"],
        float_cols=["Value"],
        category_cols=["PricingStrategy"],
        datetime_cols={"TimeText": "yyyy-MM-dd HH:mm:ss"},
        bool_cols=["Truth", "TextTruth"],
    )
    return df.select(
        "TransactionId",
        F.col("AmountText").alias("whole"),
        "Value",
        "PricingStrategy",
        F.unix_seconds("TimeText").alias("seconds"),
        F.col("Truth").cast("int").alias("truth"),
        F.col("TextTruth").cast("int").alias("text_truth"),
    )


def utc_normalise(spark, sf):
    """Zoned text becomes a UTC instant."""
    zoned = events(spark, sf).select(
        "TransactionId", F.concat(F.date_format("TransactionStartTime", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00")).alias("t")
    )
    return clean.normalise_time(zoned, "t").select("TransactionId", F.unix_seconds("t").alias("seconds"), F.hour("t").alias("hour"))


def coerce_and_drop_null(spark, sf):
    df = casts.coerce_and_drop(dirty_events(spark, sf), "CustomerId", "TimeText", "AmountText")
    return df.select("TransactionId", "CustomerId", F.unix_seconds("TimeText").alias("seconds"), F.col("AmountText").alias("amount"))


def binarise_target(spark, sf):
    return casts.binarise_target(dirty_events(spark, sf).select("TransactionId", "PricingStrategy"), "PricingStrategy")


def label_from_class(spark, sf):
    return casts.label_from_class(dirty_events(spark, sf).select("TransactionId", "CurrencyCode"), "CurrencyCode", "purchase")


def column_pruning(spark, sf):
    """Unnamed, repeated and unwanted columns go; the label is projected apart."""
    df = drop_unnamed(orders(spark, sf).withColumn("Unnamed: 0", F.col("TransactionId")))
    twice = df.select("*", F.lit(-1.0).alias("Value"))
    kept = drop_columns(first_of_each_name(twice), ["ChannelId", "ProductCategory", "ProviderId", "absent"])
    features, label = split_label(kept.drop("TransactionStartTime"), "FraudResult")
    return features.withColumn("n_labels", F.lit(len(label.columns)))


def dtype_classes(spark, sf):
    """Class of every column with the number of values it holds."""
    df = table(spark, sf, "events")
    groups = {"numeric": numeric_columns(df), "categorical": categorical_columns(df), "datetime": datetime_columns(df)}
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("class"), F.count(c).alias("n")) for kind, cs in groups.items() for c in cs
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


# ---- outliers --------------------------------------------------------------

OUTLIER_COLUMNS = ["l_extendedprice", "l_quantity"]


def _outliers(spark, sf, method, threshold):
    df = table(spark, sf, "lineitem").select("l_partkey", *OUTLIER_COLUMNS)
    return rounded(outliers.handle_outliers(df, OUTLIER_COLUMNS, method, threshold), 4, *OUTLIER_COLUMNS)


def outlier_clip(spark, sf):
    return _outliers(spark, sf, "clip", 1.5)


def outlier_remove(spark, sf):
    return _outliers(spark, sf, "remove", 1.5)


def outlier_winsorize(spark, sf):
    return _outliers(spark, sf, "winsorize", 3.0)


# ---- amounts ---------------------------------------------------------------


def amount_features(spark, sf):
    return plus_zero(amounts.add_amount_features(orders(spark, sf).select("TransactionId", "Amount"), "Amount"), 8, "amount_log")


def log_rfm(spark, sf):
    t, _ = rfm.rfm_base(orders(spark, sf), money_scale=2)
    names = ["Recency", "Frequency", "Monetary"]
    return rounded(target.log_features(t, names).select("CustomerId", *[f"log_{c}" for c in names]), 8, *[f"log_{c}" for c in names])


# ---- joins -----------------------------------------------------------------

LATE = "1998-01-01"


def _early_late(spark, sf):
    tx = orders(spark, sf)
    early = F.col("TransactionStartTime") < F.lit(LATE).cast("timestamp")
    return tx.where(early), tx.where(~early)


def tx_with_customer_profile(spark, sf):
    tx = orders(spark, sf)
    out = CustomerProfiles.fit(tx).transform(tx)
    for places, names in PROFILE_ROUNDING.items():
        out = rounded(out, places, *names)
    return out.select("TransactionId", "CustomerId", "Amount", "recency_days", "transaction_count", "total_amount", "std_amount",
                      "days_since_first_tx", "avg_tx_per_day", "unique_days", "fraud_rate")


def unseen_customer_defaults(spark, sf):
    """Profiles of early customers applied to later orders; every seventh customer is made new."""
    early, late = _early_late(spark, sf)
    fresh = late.withColumn("CustomerId", F.when(F.col("CustomerId") % 7 == 0, -F.col("CustomerId") - 1).otherwise(F.col("CustomerId")))
    out = CustomerProfiles.fit(early).transform(fresh)
    return rounded(out, 2, "total_amount").select("TransactionId", "CustomerId", "recency_days", "transaction_count", "total_amount", "unique_days", "fraud_count")


def tx_risk_back_join(spark, sf):
    """Weighted scores of customers joined back to their transactions."""
    scored, _ = rfm.target_rfm_table(orders(spark, sf), money_scale=2)
    lookup = joins.build_lookup(scored.select("CustomerId", "rfm_score", "frequency"), ["CustomerId"], "risk", "frequency")
    return rounded(joins.lookup_join(orders(spark, sf), lookup), 6, "rfm_score").select("TransactionId", "CustomerId", "rfm_score")


def label_left_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return joins.label_join(docs, table(spark, sf, "labels"), "doc_id")


def semi_join_customers(spark, sf):
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("CustomerId"))
    return joins.semi_join(orders(spark, sf), rich, "CustomerId").select("TransactionId", "CustomerId", "Amount")


# ---- order, top, sample ----------------------------------------------------


def sorted_transactions(spark, sf):
    """Events by customer and time, with the place of each row in that order.

    The sort is one distributed sort; places count on from the sizes of the parts before.
    """
    ordered = events(spark, sf).orderBy("CustomerId", "TransactionStartTime", "TransactionId").select("TransactionId", "CustomerId", "Value")
    rows, _ = materialize(ordered.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of the sort
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    parts = parts.select("part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("at") - F.col("first") + 1
    return rows.join(parts, "part").select("TransactionId", "CustomerId", "Value", place.alias("position"))


def top_categories(spark, sf):
    return eda.category_shares(table(spark, sf, "part"), "p_brand", 10).select("value", "n", F.round("share", 6).alias("share"))


def repeatable_sample(spark, sf):
    return split.sample_rows(events(spark, sf), "TransactionId", 500).select("TransactionId", "Value")


def customer_targets(spark, sf):
    return split.customer_targets(orders(spark, sf), "CustomerId", "FraudResult")


# ---- files -----------------------------------------------------------------


def full_transactions(spark, sf):
    """Orders in the full 16-column layout."""
    o = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    values = {
        "TransactionId": F.col("o_orderkey"),
        "BatchId": F.concat(F.lit("B"), F.col("o_orderkey")),
        "AccountId": F.concat(F.lit("A"), F.col("o_custkey")),
        "SubscriptionId": F.concat(F.lit("S"), F.col("o_custkey")),
        "CustomerId": F.col("o_custkey"),
        "CurrencyCode": F.lit("UGX"),
        "CountryCode": F.lit("256"),
        "ProviderId": F.col("o_orderpriority"),
        "ProductId": F.col("o_orderpriority"),
        "ProductCategory": F.col("o_orderpriority"),
        "ChannelId": status,
        "Amount": F.when(status == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")),
        "Value": F.col("o_totalprice"),
        "TransactionStartTime": F.col("o_orderdate").cast("timestamp"),
        "PricingStrategy": F.substring("o_orderpriority", 1, 1),
        "FraudResult": (status == "F"),
    }
    return o.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in transaction_schema().fields])


def csv_roundtrip(spark, sf):
    path = sinks.write_table(full_transactions(spark, sf), scratch_path(spark, "csv"), "csv")
    return readers.read_csv_typed(spark, path).select(
        "TransactionId", "CustomerId", "Amount", "PricingStrategy", "FraudResult", F.unix_seconds("TransactionStartTime").alias("seconds")
    )


def csv_shuffled_columns(spark, sf):
    """Two files with other column orders and a further column, read by name."""
    full = full_transactions(spark, sf)
    folder = scratch_path(spark, "csv")
    names = full.columns
    half = F.col("TransactionId").cast("long") % 2 == 0
    for part, order in ((full.where(half), names[::-1]), (full.where(~half), [*names[5:], *names[:5]])):
        part.select(*order[:3], F.lit("more").alias("Further"), *order[3:]).write.mode("append").option("header", True).csv(folder)
    return readers.read_csv_typed(spark, folder).select(
        "TransactionId", "CustomerId", "Amount", "Value", "PricingStrategy", "FraudResult", F.unix_seconds("TransactionStartTime").alias("seconds")
    )


def untyped_scan(spark, sf):
    source = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return readers.read_csv_untyped(spark, sinks.write_table(source, scratch_path(spark, "csv"), "csv"))


def head_n(spark, sf):
    return readers.first_rows(orders(spark, sf), 10_000, "TransactionId").select("TransactionId", "CustomerId", "Value")


def multi_file_scan(spark, sf):
    """A raw folder with known files, then one with unknown files only."""
    known, unknown = scratch_path(spark, "raw"), scratch_path(spark, "raw")
    full = full_transactions(spark, sf)
    sinks.write_table(full, f"{known}/transactions.csv", "csv")
    sinks.write_table(full.drop("FraudResult"), f"{known}/test.csv", "csv")
    sinks.write_submission(full, f"{known}/sample_submission.csv")
    sinks.write_table(table(spark, sf, "customer"), f"{unknown}/people.csv", "csv")
    out = None
    for folder in (known, unknown):
        for name, df in sorted(readers.read_raw_folder(spark, folder).items()):
            part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), F.lit(len(df.columns)).alias("n_columns"), "n_rows")
            out = part if out is None else out.unionAll(part)
    return out


def sink_formats(spark, sf):
    """The same table through every sink format, counted after reading it back."""
    df = full_transactions(spark, sf)
    folder = scratch_path(spark, "sinks")
    paths = {fmt: sinks.write_processed(df, folder, fmt) for fmt in sinks.FORMATS}
    parquet = readers.read_parquet(spark, paths["parquet"]).select(F.lit("parquet").alias("fmt"), "Value")
    csv = readers.read_csv_typed(spark, paths["csv"]).select(F.lit("csv").alias("fmt"), "Value")
    return parquet.unionAll(csv).groupBy("fmt").agg(F.count("*").alias("n"), F.round(F.sum("Value"), 2).alias("total"))


def submission_projection(spark, sf):
    path = sinks.write_submission(full_transactions(spark, sf), scratch_path(spark, "submission"))
    return readers.read_csv_typed(spark, path, readers.submission_schema())


def data_dictionary(spark, sf):
    return sinks.data_dictionary(sinks.describe_columns(full_transactions(spark, sf)))


def matrix_sinks(spark, sf):
    """Split matrices written as CSV and counted after reading them back."""
    df = orders(spark, sf).select("TransactionId", "Value", "Amount", "FraudResult")
    train, test = split.stratified_split(df, "TransactionId", "FraudResult")
    paths = sinks.write_matrices(train, test, scratch_path(spark, "matrices"), "FraudResult")
    out = None
    for p in paths:
        part = spark.read.option("header", True).csv(p)
        row = part.agg(F.count("*").alias("n")).select(F.lit(p.rsplit("/", 1)[1]).alias("name"), F.lit(len(part.columns)).alias("columns"), "n")
        out = row if out is None else out.unionAll(row)
    return out


def processing_metadata(spark, sf):
    found = runs.processing_metadata(full_transactions(spark, sf), "FraudResult")
    return runs.metadata_table(spark, found).select("num_samples", "target", "num_features", F.array_join("features", ",").alias("features"))


def dataset_counts(spark, sf):
    return eda.dataset_counts(orders(spark, sf), {"customers": "CustomerId", "providers": "ProviderId", "categories": "ProductCategory"})


QUERIES = {
    "merchant_stats": merchant_stats,
    "merchant_affinity": merchant_affinity,
    "tx_with_merchant": tx_with_merchant,
    "tx_time_features": tx_time_features,
    "tx_cyclical_fixed": tx_cyclical_fixed,
    "tx_cyclical_max": tx_cyclical_max,
    "season_flags": season_flags,
    "calendar_columns": calendar_columns,
    "fill_amounts": fill_amounts,
    "impute_typed": impute_typed,
    "trim_strings": trim_strings,
    "cast_types": cast_types,
    "utc_normalise": utc_normalise,
    "coerce_and_drop_null": coerce_and_drop_null,
    "binarise_target": binarise_target,
    "label_from_class": label_from_class,
    "column_pruning": column_pruning,
    "dtype_classes": dtype_classes,
    "outlier_clip": outlier_clip,
    "outlier_remove": outlier_remove,
    "outlier_winsorize": outlier_winsorize,
    "amount_features": amount_features,
    "log_rfm": log_rfm,
    "tx_with_customer_profile": tx_with_customer_profile,
    "unseen_customer_defaults": unseen_customer_defaults,
    "tx_risk_back_join": tx_risk_back_join,
    "label_left_join": label_left_join,
    "semi_join_customers": semi_join_customers,
    "sorted_transactions": sorted_transactions,
    "top_categories": top_categories,
    "repeatable_sample": repeatable_sample,
    "customer_targets": customer_targets,
    "csv_roundtrip": csv_roundtrip,
    "csv_shuffled_columns": csv_shuffled_columns,
    "untyped_scan": untyped_scan,
    "head_n": head_n,
    "multi_file_scan": multi_file_scan,
    "sink_formats": sink_formats,
    "submission_projection": submission_projection,
    "data_dictionary": data_dictionary,
    "matrix_sinks": matrix_sinks,
    "processing_metadata": processing_metadata,
    "dataset_counts": dataset_counts,
}

_WAVES_FIXED = ", ".join(
    f"ROUND({w}(2 * pi() * {e} / {p}), 6) + 0.0 AS {f}_{w}"
    for f, e, p in (("hour", "hour(ts)", 24), ("day_of_week", "(isodow(ts) - 1)", 7), ("day_of_month", "day(ts)", 30), ("month", "month(ts)", 12))
    for w in ("sin", "cos")
)
_WAVES_MAX = ", ".join(
    f"ROUND({w}(2 * pi() * {e} / nullif((SELECT MAX({e}) FROM events), 0)), 6) + 0.0 AS t_{f}_{w}"
    for f, e in SPARK_TO_SQL.items()
    for w in ("sin", "cos")
)
_BOUNDS = "SELECT AVG({c}) - 1.5 * STDDEV_SAMP({c}) AS lo, AVG({c}) + 1.5 * STDDEV_SAMP({c}) AS hi FROM lineitem"
_PARTS = ", ".join(f"CAST({e} AS INTEGER) AS t_{f}" for f, e in SPARK_TO_SQL.items())
_FULL = """SELECT CAST(o_orderkey AS VARCHAR) AS TransactionId, CAST(o_custkey AS VARCHAR) AS CustomerId,
  CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS Amount, o_totalprice AS Value,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS PricingStrategy, CAST(o_orderstatus = 'F' AS INTEGER) AS FraudResult,
  CAST(epoch(o_orderdate) AS BIGINT) AS seconds FROM orders"""

SQL = {
    "merchant_stats": f"WITH {MERCHANT_SQL} SELECT * FROM ms",
    "merchant_affinity": f"WITH {MERCHANT_SQL} SELECT * FROM aff",
    "tx_with_merchant": f"""WITH {MERCHANT_SQL} SELECT TransactionId, CustomerId, ProviderId, Amount, merchant_avg_amount, merchant_std_amount,
      merchant_tx_count, merchant_fraud_rate, affinity AS customer_merchant_affinity
      FROM tx LEFT JOIN ms USING (ProviderId) LEFT JOIN aff USING (CustomerId, ProviderId)""",
    "tx_time_features": f"""SELECT event_id AS TransactionId, CAST(year(ts) AS INTEGER) AS t_year, {_PARTS},
      CAST(isodow(ts) IN (6, 7) AS INTEGER) AS t_is_weekend, strftime(ts, '%Y-%m') AS TransactionMonth, CAST(year(ts) AS INTEGER) AS TransactionYear,
      CAST(isodow(ts) - 1 AS INTEGER) AS DayOfWeek, CAST(hour(ts) AS INTEGER) AS HourOfDay, strftime(ts, '%Y-%m-%d') AS transaction_date FROM events""",
    "tx_cyclical_fixed": f"SELECT event_id AS TransactionId, {_WAVES_FIXED} FROM events",
    "tx_cyclical_max": f"SELECT event_id AS TransactionId, {_WAVES_MAX} FROM events",
    "season_flags": """SELECT event_id AS TransactionId, CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend,
      CAST(hour(ts) BETWEEN 9 AND 16 AS INTEGER) AS is_business_hours, CAST(hour(ts) >= 22 OR hour(ts) < 6 AS INTEGER) AS is_night,
      CAST(hour(ts) BETWEEN 7 AND 9 AS INTEGER) AS is_morning_rush, CAST(hour(ts) BETWEEN 16 AND 18 AS INTEGER) AS is_evening_rush,
      CAST((month(ts) % 12 + 3) // 3 AS INTEGER) AS season FROM events""",
    "calendar_columns": """SELECT event_id AS TransactionId, strftime(ts, '%Y-%m-%d') AS transaction_date, CAST(hour(ts) AS INTEGER) AS transaction_hour,
      CAST(isodow(ts) - 1 AS INTEGER) AS transaction_day_of_week, CAST(day(ts) AS INTEGER) AS transaction_day_of_month, CAST(month(ts) AS INTEGER) AS transaction_month,
      CAST(year(ts) AS INTEGER) AS transaction_year, CAST(hour(ts) AS INTEGER) AS TransactionHour, CAST(isodow(ts) - 1 AS INTEGER) AS TransactionDayOfWeek,
      CAST(day(ts) AS INTEGER) AS TransactionDayOfMonth, CAST(month(ts) AS INTEGER) AS TransactionMonth FROM events""",
    "fill_amounts": f"SELECT TransactionId, COALESCE(Amount, 0) AS Amount, COALESCE(Value, 0) AS Value FROM ({DIRTY})",
    "impute_typed": f"""WITH d AS ({DIRTY}),
      cur AS (SELECT CurrencyCode AS c FROM d WHERE CurrencyCode IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
      cty AS (SELECT CountryCode AS c FROM d WHERE CountryCode IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
      SELECT TransactionId, COALESCE(Amount, 0) AS Amount, COALESCE(Value, 0) AS Value, COALESCE(Score, (SELECT quantile_cont(Score, 0.5) FROM d)) AS Score,
        COALESCE(CAST(PricingStrategy AS DOUBLE), (SELECT quantile_cont(PricingStrategy, 0.5) FROM d)) AS PricingStrategy,
        COALESCE(CurrencyCode, (SELECT c FROM cur)) AS CurrencyCode, COALESCE(CountryCode, (SELECT c FROM cty)) AS CountryCode, COALESCE(Note, 'unknown') AS Note FROM d""",
    "trim_strings": f"SELECT TransactionId, trim(Note) AS Note, CAST(length(trim(Note)) AS INTEGER) AS length FROM ({DIRTY})",
    "cast_types": f"""SELECT TransactionId, CASE WHEN TRY_CAST(AmountText AS DOUBLE) = FLOOR(TRY_CAST(AmountText AS DOUBLE)) THEN CAST(TRY_CAST(AmountText AS DOUBLE) AS BIGINT) END AS whole,
      Value, CAST(PricingStrategy AS VARCHAR) AS PricingStrategy, CAST(epoch(TRY_CAST(TimeText AS TIMESTAMP)) AS BIGINT) AS seconds,
      CAST(PricingStrategy IS NULL OR PricingStrategy <> 0 AS INTEGER) AS truth, 1 AS text_truth FROM ({DIRTY})""",
    "utc_normalise": """SELECT event_id AS TransactionId, CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 10800 AS seconds,
      CAST(hour(ts - INTERVAL 3 HOUR) AS INTEGER) AS hour FROM events""",
    "coerce_and_drop_null": f"""SELECT TransactionId, CustomerId, CAST(epoch(TRY_CAST(TimeText AS TIMESTAMP)) AS BIGINT) AS seconds, TRY_CAST(AmountText AS DOUBLE) AS amount
      FROM ({DIRTY}) WHERE CustomerId IS NOT NULL AND TRY_CAST(TimeText AS TIMESTAMP) IS NOT NULL AND TRY_CAST(AmountText AS DOUBLE) IS NOT NULL""",
    "binarise_target": f"SELECT TransactionId, CAST(PricingStrategy > 0 AS INTEGER) AS PricingStrategy FROM ({DIRTY}) WHERE PricingStrategy IS NOT NULL",
    "label_from_class": f"SELECT TransactionId, CAST(COALESCE(CurrencyCode = 'purchase', FALSE) AS INTEGER) AS label FROM ({DIRTY})",
    "column_pruning": f"SELECT TransactionId, CustomerId, Amount, Value, 1 AS n_labels FROM ({ORDERS})",
    "dtype_classes": """SELECT 'event_id' AS "column", 'numeric' AS "class", COUNT(event_id) AS n FROM events UNION ALL SELECT 'user_id', 'numeric', COUNT(user_id) FROM events
      UNION ALL SELECT 'value', 'numeric', COUNT(value) FROM events UNION ALL SELECT 'event_type', 'categorical', COUNT(event_type) FROM events
      UNION ALL SELECT 'props', 'categorical', COUNT(props) FROM events UNION ALL SELECT 'ts', 'datetime', COUNT(ts) FROM events""",
    "outlier_clip": f"""WITH p AS ({_BOUNDS.format(c="l_extendedprice")}), q AS ({_BOUNDS.format(c="l_quantity")})
      SELECT l_partkey, ROUND(LEAST(GREATEST(l_extendedprice, p.lo), p.hi), 4) AS l_extendedprice, ROUND(LEAST(GREATEST(l_quantity, q.lo), q.hi), 4) AS l_quantity FROM lineitem, p, q""",
    "outlier_remove": """WITH a AS (SELECT AVG(l_extendedprice) AS m, STDDEV_SAMP(l_extendedprice) AS s FROM lineitem),
      b AS (SELECT l_partkey, l_extendedprice, l_quantity FROM lineitem, a WHERE ABS((l_extendedprice - m) / s) <= 1.5),
      c AS (SELECT AVG(l_quantity) AS m, STDDEV_SAMP(l_quantity) AS s FROM b)
      SELECT l_partkey, ROUND(l_extendedprice, 4) AS l_extendedprice, ROUND(l_quantity, 4) AS l_quantity FROM b, c WHERE ABS((l_quantity - m) / s) <= 1.5""",
    "outlier_winsorize": """WITH e AS (SELECT quantile_cont(l_extendedprice, [0.01, 0.99]) AS p, quantile_cont(l_quantity, [0.01, 0.99]) AS q FROM lineitem)
      SELECT l_partkey, ROUND(LEAST(GREATEST(l_extendedprice, p[1]), p[2]), 4) AS l_extendedprice, ROUND(LEAST(GREATEST(l_quantity, q[1]), q[2]), 4) AS l_quantity FROM lineitem, e""",
    "amount_features": f"""SELECT TransactionId, Amount, CAST(Amount > 0 AS INTEGER) AS is_credit, CAST(Amount < 0 AS INTEGER) AS is_debit, ABS(Amount) AS amount_abs,
      ROUND(LN(1 + ABS(Amount)), 8) + 0.0 AS amount_log FROM ({ORDERS})""",
    "log_rfm": f"""WITH tx AS ({ORDERS}), base AS (SELECT CustomerId, MAX(TransactionStartTime) AS l, COUNT(*) AS f, ROUND(SUM(Value), 2) AS m FROM tx GROUP BY CustomerId)
      SELECT CustomerId, ROUND(LN(1 + date_diff('day', l, (SELECT MAX(l) FROM base)) + 1), 8) AS log_Recency, ROUND(LN(1 + f), 8) AS log_Frequency, ROUND(LN(1 + m), 8) AS log_Monetary FROM base""",
    "tx_with_customer_profile": f"""WITH tx AS ({ORDERS}), {PROFILE_SQL} SELECT TransactionId, tx.CustomerId, Amount, recency_days, transaction_count, total_amount,
      COALESCE(std_amount, 0) AS std_amount, days_since_first_tx, avg_tx_per_day, unique_days, fraud_rate FROM tx LEFT JOIN profile ON tx.CustomerId = profile.CustomerId""",
    "unseen_customer_defaults": f"""WITH every AS ({ORDERS}), tx AS (SELECT * FROM every WHERE TransactionStartTime < TIMESTAMP '{LATE}'), {PROFILE_SQL},
      late AS (SELECT TransactionId, CASE WHEN CustomerId % 7 = 0 THEN -CustomerId - 1 ELSE CustomerId END AS CustomerId FROM every WHERE TransactionStartTime >= TIMESTAMP '{LATE}')
      SELECT TransactionId, late.CustomerId, COALESCE(recency_days, 365) AS recency_days, COALESCE(transaction_count, 0) AS transaction_count,
        COALESCE(total_amount, 0) AS total_amount, COALESCE(unique_days, 1) AS unique_days, COALESCE(fraud_count, 0) AS fraud_count
      FROM late LEFT JOIN profile ON late.CustomerId = profile.CustomerId""",
    "tx_risk_back_join": f"WITH {TARGET_SQL} SELECT TransactionId, tx.CustomerId, rfm_score FROM tx LEFT JOIN weighted ON tx.CustomerId = weighted.CustomerId",
    "label_left_join": "SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "semi_join_customers": f"SELECT TransactionId, CustomerId, Amount FROM ({ORDERS}) WHERE CustomerId IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)",
    "sorted_transactions": f"SELECT TransactionId, CustomerId, Value, ROW_NUMBER() OVER (ORDER BY CustomerId, TransactionStartTime, TransactionId) AS position FROM ({EVENTS})",
    "top_categories": """SELECT p_brand AS value, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(p_brand) FROM part), 6) AS share FROM part WHERE p_brand IS NOT NULL
      GROUP BY p_brand ORDER BY n DESC, value LIMIT 10""",
    "customer_targets": f"SELECT DISTINCT CustomerId, FraudResult FROM ({ORDERS})",
    "csv_shuffled_columns": f"SELECT TransactionId, CustomerId, Amount, Value, PricingStrategy, FraudResult, seconds FROM ({_FULL})",
    "csv_roundtrip": f"SELECT TransactionId, CustomerId, Amount, PricingStrategy, FraudResult, seconds FROM ({_FULL})",
    "untyped_scan": "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "head_n": f"SELECT TransactionId, CustomerId, Value FROM ({ORDERS}) ORDER BY TransactionId LIMIT 10000",
    "multi_file_scan": """SELECT 'transactions' AS name, 16 AS n_columns, COUNT(*) AS n_rows FROM orders UNION ALL SELECT 'test', 15, COUNT(*) FROM orders
      UNION ALL SELECT 'sample_submission', 2, COUNT(*) FROM orders UNION ALL SELECT 'people', 5, COUNT(*) FROM customer""",
    "sink_formats": """SELECT fmt, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders, (SELECT unnest(['parquet', 'csv']) AS fmt) GROUP BY fmt""",
    "submission_projection": f"SELECT TransactionId, FraudResult FROM ({_FULL})",
    "data_dictionary": "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in DESCRIPTIONS)
    + """]) AS "column", unnest(["""
    + ", ".join(f"'{d}'" for d in DESCRIPTIONS.values())
    + """]) AS description, (SELECT COUNT(*) FROM orders) AS "values\"""",
    "matrix_sinks": """WITH n AS (SELECT COUNT(*) AS n, CAST(CEIL(0.2 * COUNT(*)) AS BIGINT) AS t FROM orders)
      SELECT 'X_train' AS name, 3 AS columns, n - t AS n FROM n UNION ALL SELECT 'y_train', 1, n - t FROM n UNION ALL SELECT 'X_test', 3, t FROM n UNION ALL SELECT 'y_test', 1, t FROM n""",
    "processing_metadata": "SELECT COUNT(*) AS num_samples, 'FraudResult' AS target, 15 AS num_features, '"
    + ",".join(c for c in DESCRIPTIONS if c != "FraudResult")
    + "' AS features FROM orders",
    "dataset_counts": f"""SELECT COUNT(*) AS transactions, COUNT(DISTINCT CustomerId) AS customers, COUNT(DISTINCT ProviderId) AS providers,
      COUNT(DISTINCT ProductCategory) AS categories FROM ({ORDERS})""",
}

