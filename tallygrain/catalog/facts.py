"""Queries on trained models whose results are facts that SQL can tell: sizes, sums, and differences that must be none."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.catalog.models import NUMBERS, labelled_customers
from tallygrain.catalog.tables import ORDERS, orders
from tallygrain.operators import split, train
from tallygrain.operators.tree_shapley import tree_shapley
from tallygrain.plans import supervised
from tallygrain.session import scratch_path
from tallygrain.sources import runs
from tallygrain.sources.artifacts import FittedPipeline
from tallygrain.sources.readers import read_parquet

KEY, LABEL = "CustomerId", "is_high_risk"


def _parts(spark, sf):
    return split.stratified_split(labelled_customers(spark, sf), KEY, LABEL)


def search_saved(spark, sf):
    """The whole logistic grid in 5 folds, saved with its search and importances and read back."""
    tr, te = _parts(spark, sf)
    grid = train.draw_settings(train.LOGISTIC_SPACE, 12)
    run = train.search_model(tr, "logistic_regression", LABEL, KEY, train.standard_head(NUMBERS), settings=grid)
    scored = train.predictions(run.model, te)
    search = spark.createDataFrame(run.search, "settings string, cv_score double")
    importance = train.feature_importance(run.model, scored)
    again = runs.load_results(spark, runs.save_model(run.model, scratch_path(spark, "models"), run.family, {"cv_score": run.cv_score}, importance, search))
    facts = again["cv_results"].agg(
        F.count_distinct("settings").alias("settings"), F.count_if(~F.col("cv_score").between(0, 1)).alias("out_of_range"), (F.max("cv_score") == run.cv_score).alias("best_is_top")
    )
    lost = again["cv_results"].exceptAll(search).count() + again["feature_importances"].exceptAll(importance).count()
    names = again["feature_importances"].agg(F.count("feature").alias("features"))
    record = again["metadata"].agg(F.max(F.size("feature_importances")).cast("long").alias("recorded"))
    return facts.crossJoin(F.broadcast(names)).crossJoin(F.broadcast(record)).withColumn("lost", F.lit(lost).cast("long")).withColumn("n_test", F.lit(scored.count()).cast("long"))


def shapley_additive(spark, sf):
    """Exact attributions of 100 boosted trees for every test customer: they and the base add up to the margin."""
    tr, te = _parts(spark, sf)
    run = train.search_model(tr, "gradient_boosting", LABEL, KEY, train.standard_head(NUMBERS), settings=[{"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}], folds=1)
    values = tree_shapley(run.model, te, KEY)
    raw = train.predictions(run.model, te).select(KEY, "risk_score")
    rows = values.groupBy(KEY).agg(F.sum("shapley").alias("s"), F.first("base").alias("base"), F.first("margin").alias("margin"), F.count("*").alias("k")).join(raw, KEY)
    away = F.abs(F.col("s") + F.col("base") - F.col("margin")) > 1e-9
    wrong = F.abs(1 / (1 + F.exp(-2 * F.col("margin"))) - F.col("risk_score")) > 1e-9
    return rows.agg(F.count("*").alias("customers"), F.min("k").alias("features"), F.count_if(away).alias("not_additive"), F.count_if(wrong).alias("not_the_score"))


def forest_importance_sum(spark, sf):
    """Importances of a forest of 100 trees add up to one; so do its exact attributions to the probability."""
    tr, te = _parts(spark, sf)
    run = train.search_model(tr, "random_forest", LABEL, KEY, train.standard_head(NUMBERS), settings=[{"n_estimators": 100, "max_depth": 10}], folds=1)
    scored = train.predictions(run.model, te)
    total = train.feature_importance(run.model, scored).agg(F.round(F.sum("importance"), 9).alias("total"), F.count("*").alias("features"))
    rows = tree_shapley(run.model, te, KEY).groupBy(KEY).agg((F.sum("shapley") + F.first("base")).alias("s")).join(scored.select(KEY, "risk_score"), KEY)
    return total.crossJoin(F.broadcast(rows.agg(F.count("*").alias("customers"), F.count_if(F.abs(F.col("s") - F.col("risk_score")) > 1e-9).alias("not_additive"))))


def _timed_orders(spark, sf):
    tx = orders(spark, sf)
    return tx.select("TransactionId", "TransactionStartTime", "FraudResult", F.col("Amount").cast("double").alias("Amount"), F.hour("TransactionStartTime").cast("double").alias("hour"), F.dayofweek("TransactionStartTime").cast("double").alias("weekday"))


def time_fold_sizes(spark, sf):
    """Training and test rows of expanding folds with a gap of 100 rows; training rows that are not earlier than all test rows."""
    planned = split.time_series_plan(_timed_orders(spark, sf), "TransactionStartTime", "TransactionId", 5, 100)
    place = F.struct("TransactionStartTime", "TransactionId")
    out = None
    for f in range(1, 6):
        trained, tested = split.fold_parts(planned, f)
        row = planned.agg(
            F.lit(f).alias("fold"), F.count_if(trained).alias("train"), F.count_if(tested).alias("test"),
            (F.max(F.when(trained, place)) >= F.min(F.when(tested, place))).alias("leaks"),
        )
        out = row if out is None else out.unionAll(row)
    return out


def time_search(spark, sf):
    """Search over logistic settings with folds in time over all transactions: settings tried, scores in range, the best one refit."""
    grid = train.draw_settings(train.LOGISTIC_SPACE, 12)
    tx = _timed_orders(spark, sf)
    run = train.search_model(tx, "logistic_regression", "FraudResult", "TransactionId", train.standard_head(["Amount", "hour", "weekday"]), settings=grid, time="TransactionStartTime", gap=100)
    areas = [a for _, a in run.search]
    scored = train.predictions(run.model, tx)
    return scored.agg(
        F.lit(len(areas)).cast("long").alias("settings"), F.lit(all(0 <= a <= 1 for a in areas)).alias("in_range"),
        F.lit(run.cv_score == max(areas)).alias("best_is_top"), F.count("risk_score").alias("scored"),
    )


def pipeline_roundtrip(spark, sf):
    """A feature union and a model on it, saved, loaded in another session: test rows whose score changes."""
    tr, te = split.temporal_split(orders(spark, sf), "TransactionStartTime", "TransactionId")
    union = supervised.FeatureUnion.fit(tr.drop("FraudResult"), ["Value"], ["ProductCategory", "ChannelId"])
    rows = union.transform(tr.drop("FraudResult"), keep=["TransactionId"]).join(tr.select("TransactionId", "FraudResult"), "TransactionId")
    run = train.search_model(rows, "logistic_regression", "FraudResult", "TransactionId", train.standard_head(union.names), settings=[{"C": 1.0}], folds=1)
    fitted = FittedPipeline(union, run.model, ["TransactionId"])
    again = FittedPipeline.load(spark.newSession(), fitted.save(scratch_path(spark, "pipeline")))
    path = scratch_path(spark, "requests")
    te.drop("FraudResult").write.parquet(path)
    before = train.predictions(fitted, read_parquet(spark, path)).select("TransactionId", F.col("risk_score").alias("before"))
    after = train.predictions(again, read_parquet(again.union.customers.lookup.table.sparkSession, path)).select("TransactionId", F.col("risk_score").alias("after"))
    saved = scratch_path(spark, "scores")
    after.write.parquet(saved)
    return before.join(read_parquet(spark, saved), "TransactionId").agg(F.count_if(F.col("before") != F.col("after")).alias("changed"), F.count("*").alias("n"))


def stacking_roundtrip(spark, sf):
    """A stacked model, saved with its records and loaded again: test customers whose score changes."""
    tr, te = _parts(spark, sf)
    model = train.train_stacking(tr, LABEL, KEY, train.standard_head(NUMBERS), {"rf_n_estimators": 20, "rf_max_depth": 10, "gb_n_estimators": 10})
    importance = train.feature_importance(model, model.head.transform(te))
    path = runs.save_model(model, scratch_path(spark, "models"), "stacking", {"n": float(te.count())}, importance)
    again = runs.load_model(path, train.Stacked)
    before = train.predictions(model, te).select(KEY, F.col("risk_score").alias("before"))
    after = train.predictions(again, te).select(KEY, F.col("risk_score").alias("after"))
    return before.join(after, KEY).agg(F.count_if(F.col("before") != F.col("after")).alias("changed"), F.count("*").alias("n"))


QUERIES = {
    "search_saved": search_saved,
    "shapley_additive": shapley_additive,
    "forest_importance_sum": forest_importance_sum,
    "time_fold_sizes": time_fold_sizes,
    "time_search": time_search,
    "pipeline_roundtrip": pipeline_roundtrip,
    "stacking_roundtrip": stacking_roundtrip,
}

_TEST = "CAST(CEIL(0.2 * COUNT(DISTINCT o_custkey)) AS BIGINT)"
_WIDE = len(NUMBERS)

SQL = {
    "search_saved": f"SELECT CAST(12 AS BIGINT) AS settings, CAST(0 AS BIGINT) AS out_of_range, true AS best_is_top, CAST({_WIDE} AS BIGINT) AS features, CAST({_WIDE} AS BIGINT) AS recorded, CAST(0 AS BIGINT) AS lost, {_TEST} AS n_test FROM orders",
    "shapley_additive": f"SELECT {_TEST} AS customers, CAST({_WIDE} AS BIGINT) AS features, CAST(0 AS BIGINT) AS not_additive, CAST(0 AS BIGINT) AS not_the_score FROM orders",
    "forest_importance_sum": f"SELECT CAST(1 AS DOUBLE) AS total, CAST({_WIDE} AS BIGINT) AS features, {_TEST} AS customers, CAST(0 AS BIGINT) AS not_additive FROM orders",
    "time_fold_sizes": """SELECT CAST(f AS INTEGER) AS fold, CAST(n - (6 - f) * (n // 6) - 100 AS BIGINT) AS train, CAST(n // 6 AS BIGINT) AS test, false AS leaks
      FROM (SELECT COUNT(*) AS n FROM orders), unnest([1, 2, 3, 4, 5]) AS t(f)""",
    "time_search": f"SELECT CAST(12 AS BIGINT) AS settings, true AS in_range, true AS best_is_top, COUNT(*) AS scored FROM ({ORDERS})",
    "pipeline_roundtrip": "SELECT CAST(0 AS BIGINT) AS changed, CAST(COUNT(*) - FLOOR(0.8 * COUNT(*)) AS BIGINT) AS n FROM orders",
    "stacking_roundtrip": f"SELECT CAST(0 AS BIGINT) AS changed, {_TEST} AS n FROM orders",
}
