"""Data profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.catalog.tables import rounded, table
from tallygrain.catalog.transactions import DIRTY, dirty_events, plus_zero
from tallygrain.operators import eda

BOXED = ["l_quantity", "l_extendedprice", "l_discount"]


def eda_shape(spark, sf):
    df = eda.shape(table(spark, sf, "orders"))
    return df.select("position", "column", "dtype", "n_rows", "n_columns")


def eda_describe(spark, sf):
    """Numeric part of the summary."""
    df = eda.describe(table(spark, sf, "lineitem").select(*BOXED))
    return rounded(df, 4, "mean", "std", "min", "p25", "p50", "p75", "max").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def eda_describe_text(spark, sf):
    """Text and time part of the summary."""
    df = eda.describe(table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus", "o_orderdate"))
    text = F.col("column") != "o_orderdate"
    return df.select("column", "count", "unique", F.when(text, F.col("top")).alias("top"), "freq", F.substring("first", 1, 10).alias("first"), F.substring("last", 1, 10).alias("last"))


def eda_hist(spark, sf):
    return rounded(eda.histogram(table(spark, sf, "lineitem"), BOXED), 4, "low", "high")


def eda_shares(spark, sf):
    return eda.category_shares(table(spark, sf, "events"), "event_type", 5).select("value", "n", F.round("share", 6).alias("share"))


def eda_corr(spark, sf):
    return plus_zero(eda.correlation(table(spark, sf, "lineitem"), BOXED), 6, "r")


def eda_nulls(spark, sf):
    return rounded(eda.missing_values(dirty_events(spark, sf).select("CustomerId", "TimeText", "Value", "Score", "CurrencyCode", "Note")), 6, "percent")


def eda_box(spark, sf):
    return rounded(eda.box_statistics(table(spark, sf, "lineitem"), BOXED), 4, "q1", "median", "q3", "low_fence", "high_fence")


def eda_concentration(spark, sf):
    return rounded(eda.concentration(table(spark, sf, "events"), "user_id"), 8, "share")


def eda_skewness(spark, sf):
    return plus_zero(eda.skewness(table(spark, sf, "events"), ["value", "user_id"]), 6, "skewness")


QUERIES = {
    "eda_shape": eda_shape,
    "eda_describe": eda_describe,
    "eda_describe_text": eda_describe_text,
    "eda_hist": eda_hist,
    "eda_shares": eda_shares,
    "eda_corr": eda_corr,
    "eda_nulls": eda_nulls,
    "eda_box": eda_box,
    "eda_concentration": eda_concentration,
    "eda_skewness": eda_skewness,
}

_ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


def _union(template: str, names: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in names)


SQL = {
    "eda_shape": " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS "position", '{c}' AS "column", '{t}' AS dtype, COUNT(*) AS n_rows, 6 AS n_columns FROM orders""" for i, (c, t) in enumerate(_ORDERS)
    ),
    "eda_describe": _union(
        """SELECT '{c}' AS "column", COUNT({c}) AS "count", ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS std, ROUND(MIN({c}), 4) AS "min",
        ROUND(quantile_cont({c}, 0.25), 4) AS p25, ROUND(quantile_cont({c}, 0.5), 4) AS p50, ROUND(quantile_cont({c}, 0.75), 4) AS p75, ROUND(MAX({c}), 4) AS "max" FROM lineitem""",
        BOXED,
    ),
    "eda_describe_text": _union(
        """SELECT '{c}' AS "column", COUNT({c}) AS "count", COUNT(DISTINCT {c}) AS "unique", (SELECT {c} FROM orders GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS top,
        (SELECT COUNT(*) FROM orders GROUP BY {c} ORDER BY COUNT(*) DESC LIMIT 1) AS freq, CAST(NULL AS VARCHAR) AS "first", CAST(NULL AS VARCHAR) AS "last" FROM orders""",
        ["o_orderpriority", "o_orderstatus"],
    )
    + """ UNION ALL SELECT 'o_orderdate', COUNT(o_orderdate), NULL, NULL, NULL, strftime(MIN(o_orderdate), '%Y-%m-%d'), strftime(MAX(o_orderdate), '%Y-%m-%d') FROM orders""",
    "eda_hist": "WITH "
    + ", ".join(f"e_{c} AS (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM lineitem)" for c in BOXED)
    + " "
    + _union(
        """SELECT '{c}' AS "column", bin, ROUND(lo + bin * ((hi - lo) / 30), 4) AS low, ROUND(lo + (bin + 1) * ((hi - lo) / 30), 4) AS high, n FROM
        (SELECT CAST(LEAST(FLOOR(({c} - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, lo, hi, COUNT(*) AS n FROM lineitem, e_{c} GROUP BY 1, 2, 3)""",
        BOXED,
    ),
    "eda_shares": """SELECT event_type AS value, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(event_type) FROM events), 6) AS share FROM events WHERE event_type IS NOT NULL
      GROUP BY event_type ORDER BY n DESC, value LIMIT 5""",
    "eda_corr": " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a in BOXED for b in BOXED),
    "eda_nulls": f"WITH d AS ({DIRTY}) SELECT * FROM ("
    + _union(
        """SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing, ROUND((COUNT(*) - COUNT({c})) * 100 / COUNT(*), 6) AS percent FROM d""",
        ["CustomerId", "TimeText", "Value", "Score", "CurrencyCode", "Note"],
    )
    + ") WHERE missing > 0",
    "eda_box": "WITH "
    + ", ".join(f"q_{c} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM lineitem)" for c in BOXED)
    + " "
    + _union(
        """SELECT '{c}' AS "column", ROUND(q1, 4) AS q1, ROUND(m, 4) AS median, ROUND(q3, 4) AS q3, ROUND(q1 - 1.5 * (q3 - q1), 4) AS low_fence, ROUND(q3 + 1.5 * (q3 - q1), 4) AS high_fence,
        (SELECT COUNT(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers FROM q_{c}""",
        BOXED,
    ),
    "eda_concentration": "SELECT user_id, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM events), 8) AS share FROM events GROUP BY user_id",
    "eda_skewness": _union(
        """SELECT '{c}' AS "column", ROUND(AVG(({c} - m) ** 3) / (AVG(({c} - m) ** 2) ** 1.5), 6) + 0.0 AS skewness FROM events, (SELECT AVG({c}) AS m FROM events)""",
        ["value", "user_id"],
    ),
}
