"""Customer-grain queries: RFM, behaviour, profile, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.catalog.tables import EVENTS, ORDERS, events, orders, rounded
from tallygrain.functions import amounts
from tallygrain.operators import behavior, binning, clean, profile, rfm

RFM_SQL = f"""
tx AS ({ORDERS}),
base AS (
  SELECT CustomerId, MAX(TransactionStartTime) AS last_ts, COUNT(TransactionId) AS Frequency,
    ROUND(SUM(Value), 2) AS Monetary, AVG(Value) AS AvgTransactionValue, MAX(Value) AS MaxTransactionValue
  FROM tx GROUP BY CustomerId),
rfm AS (
  SELECT b.CustomerId, date_diff('day', last_ts, (SELECT MAX(last_ts) FROM base)) + 1 AS Recency, Frequency, Monetary,
    AvgTransactionValue, MaxTransactionValue, Monetary / Frequency AS MonetaryPerFrequency
  FROM base b),
edges AS (
  SELECT quantile_cont(Recency, [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(Monetary, [0.2, 0.4, 0.6, 0.8]) AS m,
    COUNT(*) AS n FROM rfm),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY Frequency, CustomerId) AS fr FROM rfm),
scored AS (
  SELECT ranked.*,
    5 - (CAST(Recency > r[1] AS INT) + CAST(Recency > r[2] AS INT) + CAST(Recency > r[3] AS INT) + CAST(Recency > r[4] AS INT)) AS RecencyScore,
    1 + (CAST((fr - 1) * 5 > (n - 1) AS INT) + CAST((fr - 1) * 5 > (n - 1) * 2 AS INT) + CAST((fr - 1) * 5 > (n - 1) * 3 AS INT) + CAST((fr - 1) * 5 > (n - 1) * 4 AS INT)) AS FrequencyScore,
    1 + (CAST(Monetary > m[1] AS INT) + CAST(Monetary > m[2] AS INT) + CAST(Monetary > m[3] AS INT) + CAST(Monetary > m[4] AS INT)) AS MonetaryScore
  FROM ranked, edges)
"""


def rfm_metrics(spark, sf):
    table, _ = rfm.rfm_base(orders(spark, sf), money_scale=2)
    return rounded(
        table.select(
            "CustomerId", "Recency", "Frequency", "Monetary", "AvgTransactionValue", "MaxTransactionValue", "MonetaryPerFrequency"
        ),
        6,
        "AvgTransactionValue",
        "MonetaryPerFrequency",
    )


def rfm_scores(spark, sf):
    return rfm.rfm_table(orders(spark, sf), money_scale=2).select(
        "CustomerId", "RecencyScore", "FrequencyScore", "MonetaryScore", "RFM_Score"
    )


def rfm_segments(spark, sf):
    return rfm.rfm_table(orders(spark, sf), money_scale=2).select(
        "CustomerId", "Recency", "Frequency", "Monetary", "RFM_Score", "RFM_Segment"
    )


TARGET_SQL = f"""
tx AS ({ORDERS}),
base AS (
  SELECT CustomerId, MAX(TransactionStartTime) AS last_ts, COUNT(*) AS frequency, ROUND(SUM(Amount), 2) AS monetary
  FROM tx GROUP BY CustomerId),
rfm AS (
  SELECT CustomerId, date_diff('day', last_ts, (SELECT MAX(last_ts) FROM base)) + 1 AS recency, frequency, monetary FROM base),
edges AS (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS r, COUNT(*) AS n FROM rfm),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY frequency, CustomerId) AS fr, ROW_NUMBER() OVER (ORDER BY monetary, CustomerId) AS mr FROM rfm),
scored AS (
  SELECT ranked.*,
    5 - (CAST(recency > r[1] AS INT) + CAST(recency > r[2] AS INT) + CAST(recency > r[3] AS INT) + CAST(recency > r[4] AS INT)) AS recency_score,
    1 + (CAST((fr - 1) * 5 > (n - 1) AS INT) + CAST((fr - 1) * 5 > (n - 1) * 2 AS INT) + CAST((fr - 1) * 5 > (n - 1) * 3 AS INT) + CAST((fr - 1) * 5 > (n - 1) * 4 AS INT)) AS frequency_score,
    1 + (CAST((mr - 1) * 5 > (n - 1) AS INT) + CAST((mr - 1) * 5 > (n - 1) * 2 AS INT) + CAST((mr - 1) * 5 > (n - 1) * 3 AS INT) + CAST((mr - 1) * 5 > (n - 1) * 4 AS INT)) AS monetary_score
  FROM ranked, edges),
weighted AS (
  SELECT CustomerId, recency, frequency, monetary, recency_score, frequency_score, monetary_score,
    ROUND(CAST(recency_score AS DOUBLE) * CAST(0.4 AS DOUBLE) + CAST(frequency_score AS DOUBLE) * CAST(0.3 AS DOUBLE) + CAST(monetary_score AS DOUBLE) * CAST(0.3 AS DOUBLE), 6) AS rfm_score FROM scored)
"""


def rfm_weighted_target_path(spark, sf):
    """Weighted score and the fallback label: the lowest fifth of the scores."""
    from tallygrain.operators.target import fallback_label

    table, _ = rfm.target_rfm_table(orders(spark, sf), money_scale=2)
    return fallback_label(rounded(table, 6, "rfm_score")).select(
        "CustomerId", "recency", "frequency", "monetary", "recency_score", "frequency_score", "monetary_score", "rfm_score", "is_high_risk"
    )


AMOUNT_CLASS_SQL = "CASE WHEN Value >= 5000 THEN 4 WHEN Value >= 1000 THEN 3 WHEN Value >= 500 THEN 2 WHEN Value >= 100 THEN 1 WHEN Value >= 0 THEN 0 END"
LABEL_SQL = "['0-100', '100-500', '500-1000', '1000-5000', '5000+']"


def behavior_sql(source: str) -> str:
    return f"""
btx AS (SELECT *, isodow(TransactionStartTime) - 1 AS dow, hour(TransactionStartTime) AS hod, {AMOUNT_CLASS_SQL} AS ac FROM ({source})),
day_mode AS (SELECT CustomerId, dow FROM (SELECT CustomerId, dow, ROW_NUMBER() OVER (PARTITION BY CustomerId ORDER BY COUNT(*) DESC, dow) AS k FROM btx GROUP BY CustomerId, dow) WHERE k = 1),
hour_mode AS (SELECT CustomerId, hod FROM (SELECT CustomerId, hod, ROW_NUMBER() OVER (PARTITION BY CustomerId ORDER BY COUNT(*) DESC, hod) AS k FROM btx GROUP BY CustomerId, hod) WHERE k = 1),
amount_mode AS (SELECT CustomerId, ac FROM (SELECT CustomerId, ac, ROW_NUMBER() OVER (PARTITION BY CustomerId ORDER BY COUNT(*) DESC, ac) AS k FROM btx WHERE ac IS NOT NULL GROUP BY CustomerId, ac) WHERE k = 1),
stats AS (
  SELECT CustomerId, COUNT(TransactionId) AS TotalTransactions, ROUND(SUM(Value), 2) AS TotalSpend, AVG(Value) AS AvgTransactionValue,
    STDDEV_SAMP(Value) AS StdTransactionValue, MIN(Value) AS MinTransactionValue, MAX(Value) AS MaxTransactionValue,
    MIN(TransactionStartTime) AS f, MAX(TransactionStartTime) AS l, COUNT(DISTINCT TransactionStartTime) AS UniqueTransactionDays,
    COUNT(DISTINCT ProductCategory) AS UniqueProductCategories, COUNT(DISTINCT ProviderId) AS UniqueProviders, COUNT(DISTINCT ChannelId) AS UniqueChannels,
    MAX(FraudResult) AS had_fraud
  FROM btx GROUP BY CustomerId),
behav AS (
  SELECT s.CustomerId, TotalTransactions, TotalSpend, ROUND(AvgTransactionValue, 4) AS AvgTransactionValue, ROUND(StdTransactionValue, 4) AS StdTransactionValue,
    MinTransactionValue, MaxTransactionValue, UniqueTransactionDays, UniqueProductCategories, UniqueProviders, UniqueChannels,
    CAST(dow AS INTEGER) AS MostActiveDay, CAST(hod AS INTEGER) AS MostActiveHour, ({LABEL_SQL})[ac + 1] AS MostCommonAmountCategory,
    ROUND(TotalTransactions / UniqueTransactionDays, 6) AS TransactionFrequency,
    CAST(FLOOR((epoch_us(l) - epoch_us(f)) / 86400000000) AS BIGINT) AS CustomerLifetime,
    ROUND(FLOOR((epoch_us(l) - epoch_us(f)) / 86400000000) / TotalTransactions, 6) AS AvgDaysBetweenTransactions,
    CAST(FLOOR(((SELECT MAX(epoch_us(l)) FROM stats) + 86400000000 - epoch_us(f)) / 86400000000) AS BIGINT) AS DaysSinceFirstTransactionDate,
    CAST(FLOOR(((SELECT MAX(epoch_us(l)) FROM stats) + 86400000000 - epoch_us(l)) / 86400000000) AS BIGINT) AS DaysSinceLastTransactionDate,
    had_fraud
  FROM stats s LEFT JOIN day_mode USING (CustomerId) LEFT JOIN hour_mode USING (CustomerId) LEFT JOIN amount_mode USING (CustomerId))
"""


BEHAVIOR_ROUNDING = {4: ("AvgTransactionValue", "StdTransactionValue"), 6: ("TransactionFrequency", "AvgDaysBetweenTransactions")}


def behavior_features(spark, sf):
    df = behavior.behavior_features(clean.clean_customer_path(events(spark, sf)), money_scale=2)
    for places, names in BEHAVIOR_ROUNDING.items():
        df = rounded(df, places, *names)
    return df


def modal_activity(spark, sf):
    df = clean.clean_customer_path(events(spark, sf))
    return df.groupBy("CustomerId").agg(
        behavior.small_domain_mode(F.col("DayOfWeek"), 7).alias("MostActiveDay"),
        behavior.small_domain_mode(F.col("HourOfDay"), 24).alias("MostActiveHour"),
        amounts.amount_label(behavior.small_domain_mode(F.col("AmountClass"), 5)).alias("MostCommonAmountCategory"),
    )


def amount_category(spark, sf):
    df = events(spark, sf)
    return df.select("TransactionId", "Amount", amounts.amount_category(F.col("Amount")).alias("AmountCategory"))


def fraud_history(spark, sf):
    return behavior.fraud_history(orders(spark, sf))


def customer_wide_table(spark, sf):
    df = behavior.customer_wide_by_fraud(clean.clean_customer_path(orders(spark, sf)), money_scale=2)
    df = rounded(df, 4, "StdTransactionValue", "TransactionFrequency", "AvgDaysBetweenTransactions")
    return rounded(df, 6, "AvgTransactionValue_x", "AvgTransactionValue_y", "MonetaryPerFrequency")


def duplicate_edges_merged(spark, sf):
    """Quintile bins of event recency, where edges coincide and are merged."""
    table, _ = rfm.rfm_base(events(spark, sf))
    bins = binning.fit_scores(table, "CustomerId", [binning.Score("Recency", "bin")], on_duplicate="merge")
    return table.select("CustomerId", "Recency", (bins["bin"] - 1).alias("bin"))


PROFILE_SQL = """
ref AS (SELECT MAX(epoch_us(TransactionStartTime)) + 86400000000 AS t FROM tx),
prof AS (
  SELECT CustomerId, CAST(FLOOR(((SELECT t FROM ref) - MAX(epoch_us(TransactionStartTime))) / 86400000000) AS BIGINT) AS recency_days,
    COUNT(*) AS transaction_count, COUNT(DISTINCT CAST(TransactionStartTime AS DATE)) AS unique_days,
    ROUND(SUM(Amount), 2) AS total_amount, ROUND(AVG(Amount), 6) AS avg_amount, MAX(Amount) AS max_amount, MIN(Amount) AS min_amount, ROUND(STDDEV_SAMP(Amount), 4) AS std_amount,
    CAST(SUM(CAST(Amount > 0 AS INT)) AS BIGINT) AS credit_count, ROUND(AVG(CAST(Amount > 0 AS INT)), 6) AS credit_ratio,
    CAST(SUM(CAST(Amount < 0 AS INT)) AS BIGINT) AS debit_count, ROUND(AVG(CAST(Amount < 0 AS INT)), 6) AS debit_ratio,
    CAST(FLOOR(((SELECT t FROM ref) - MIN(epoch_us(TransactionStartTime))) / 86400000000) AS BIGINT) AS days_since_first_tx,
    CAST(SUM(FraudResult) AS BIGINT) AS fraud_count, ROUND(AVG(FraudResult), 6) AS fraud_rate
  FROM tx GROUP BY CustomerId),
profile AS (SELECT *, ROUND(transaction_count / (days_since_first_tx + 1), 6) AS avg_tx_per_day FROM prof)
"""

PROFILE_ROUNDING = {
    2: ("total_amount",),
    4: ("std_amount",),
    6: ("avg_amount", "credit_ratio", "debit_ratio", "avg_tx_per_day", "fraud_rate"),
}


def customer_profile(spark, sf):
    df = profile.customer_profile(orders(spark, sf))
    for places, names in PROFILE_ROUNDING.items():
        df = rounded(df, places, *names)
    return df.select(
        "CustomerId", "recency_days", "transaction_count", "unique_days", "total_amount", "avg_amount", "max_amount",
        "min_amount", "std_amount", "days_since_first_tx", "avg_tx_per_day",
    )


def credit_debit_mix(spark, sf):
    df = profile.customer_profile(orders(spark, sf))
    return rounded(df, 6, "credit_ratio", "debit_ratio", "fraud_rate").select(
        "CustomerId", "credit_count", "credit_ratio", "debit_count", "debit_ratio", "fraud_count", "fraud_rate"
    )


QUERIES = {
    "rfm_metrics": rfm_metrics,
    "rfm_scores": rfm_scores,
    "rfm_segments": rfm_segments,
    "rfm_weighted_target_path": rfm_weighted_target_path,
    "behavior_features": behavior_features,
    "modal_activity": modal_activity,
    "amount_category": amount_category,
    "fraud_history": fraud_history,
    "customer_wide_table": customer_wide_table,
    "duplicate_edges_merged": duplicate_edges_merged,
    "customer_profile": customer_profile,
    "credit_debit_mix": credit_debit_mix,
}

SEGMENT_SQL = """CASE WHEN RecencyScore + FrequencyScore + MonetaryScore <= 4 THEN 'Low' WHEN RecencyScore + FrequencyScore + MonetaryScore <= 8 THEN 'Medium'
  WHEN RecencyScore + FrequencyScore + MonetaryScore <= 12 THEN 'High' ELSE 'Top' END"""

SQL = {
    "rfm_metrics": f"""WITH {RFM_SQL} SELECT CustomerId, Recency, Frequency, Monetary, ROUND(AvgTransactionValue, 6) AS AvgTransactionValue,
      MaxTransactionValue, ROUND(MonetaryPerFrequency, 6) AS MonetaryPerFrequency FROM rfm""",
    "rfm_scores": f"""WITH {RFM_SQL} SELECT CustomerId, RecencyScore, FrequencyScore, MonetaryScore,
      RecencyScore + FrequencyScore + MonetaryScore AS RFM_Score FROM scored""",
    "rfm_segments": f"""WITH {RFM_SQL} SELECT CustomerId, Recency, Frequency, Monetary,
      RecencyScore + FrequencyScore + MonetaryScore AS RFM_Score, {SEGMENT_SQL} AS RFM_Segment FROM scored""",
    "rfm_weighted_target_path": f"""WITH {TARGET_SQL} SELECT *, CAST(rfm_score <= (SELECT quantile_cont(rfm_score, 0.2) FROM weighted) AS INTEGER) AS is_high_risk FROM weighted""",
    "behavior_features": f"WITH {behavior_sql(EVENTS)} SELECT * EXCLUDE (had_fraud) FROM behav",
    "modal_activity": f"WITH {behavior_sql(EVENTS)} SELECT CustomerId, MostActiveDay, MostActiveHour, MostCommonAmountCategory FROM behav",
    "amount_category": f"""SELECT TransactionId, Amount, CASE WHEN Amount >= 5000 THEN '5000+' WHEN Amount >= 1000 THEN '1000-5000' WHEN Amount >= 500 THEN '500-1000'
      WHEN Amount >= 100 THEN '100-500' WHEN Amount >= 0 THEN '0-100' END AS AmountCategory FROM ({EVENTS})""",
    "fraud_history": f"SELECT CustomerId, MAX(FraudResult) AS is_high_risk FROM ({ORDERS}) GROUP BY CustomerId",
    "customer_wide_table": f"""WITH {RFM_SQL}, {behavior_sql(ORDERS)}
      SELECT s.CustomerId, Recency, Frequency, Monetary, ROUND(s.AvgTransactionValue, 6) AS AvgTransactionValue_x, s.MaxTransactionValue AS MaxTransactionValue_x,
        ROUND(MonetaryPerFrequency, 6) AS MonetaryPerFrequency, RecencyScore, FrequencyScore, MonetaryScore,
        RecencyScore + FrequencyScore + MonetaryScore AS RFM_Score, TotalTransactions, TotalSpend, ROUND(s.AvgTransactionValue, 6) AS AvgTransactionValue_y,
        COALESCE(StdTransactionValue, 0) AS StdTransactionValue, MinTransactionValue, b.MaxTransactionValue AS MaxTransactionValue_y, UniqueTransactionDays,
        UniqueProductCategories, UniqueProviders, UniqueChannels, MostActiveDay, MostActiveHour, ROUND(TransactionFrequency, 4) AS TransactionFrequency,
        CustomerLifetime, ROUND(CustomerLifetime / TotalTransactions, 4) AS AvgDaysBetweenTransactions, DaysSinceFirstTransactionDate, DaysSinceLastTransactionDate,
        {SEGMENT_SQL} AS RFM_Segment, had_fraud AS is_high_risk
      FROM scored s JOIN behav b ON s.CustomerId = b.CustomerId""",
    "duplicate_edges_merged": f"""WITH tx AS ({EVENTS}), base AS (SELECT CustomerId, MAX(epoch_us(TransactionStartTime)) AS l FROM tx GROUP BY CustomerId),
      rfm AS (SELECT CustomerId, CAST(FLOOR(((SELECT MAX(l) FROM base) + 86400000000 - l) / 86400000000) AS BIGINT) AS Recency FROM base),
      e AS (SELECT list_sort(list_distinct(quantile_cont(Recency, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS q FROM rfm)
      SELECT CustomerId, Recency, CAST(len(list_filter(q[2:-2], lambda x: x < Recency)) AS INTEGER) AS bin FROM rfm, e""",
    "customer_profile": f"""WITH tx AS ({ORDERS}), {PROFILE_SQL} SELECT CustomerId, recency_days, transaction_count, unique_days, total_amount, avg_amount,
      max_amount, min_amount, std_amount, days_since_first_tx, avg_tx_per_day FROM profile""",
    "credit_debit_mix": f"""WITH tx AS ({ORDERS}), {PROFILE_SQL} SELECT CustomerId, credit_count, credit_ratio, debit_count, debit_ratio, fraud_count, fraud_rate FROM profile""",
}
