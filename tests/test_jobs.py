import os
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallygrain.operators import clean, evaluate, explain, score, split, target, train
from tallygrain.operators.behavior import FEATURE_NAMES
from tallygrain.operators.target import AS_CODED
from tallygrain.plans import customers, prepare, supervised, training, transactions as tx_plan
from tallygrain.session import scratch_path
from tallygrain.sources import readers, runs, sinks
from tallygrain.streaming import scoring


@pytest.fixture(scope="module")
def csv_file(spark, transactions):
    return sinks.write_table(transactions, scratch_path(spark, "tx") + "/transactions.csv", "csv")


def test_customer_dataset_from_csv(spark, csv_file):
    path = customers.create_processed_dataset(spark, csv_file, scratch_path(spark, "out"), moment=datetime(2025, 1, 2, 3, 4, 5))
    assert path.endswith("processed_data_20250102_030405.parquet")
    df = spark.read.parquet(path)
    assert df.columns == ["CustomerId", *FEATURE_NAMES, "is_high_risk"] and df.count() == 10
    assert {r[0] for r in df.select("is_high_risk").distinct().collect()} <= {0, 1}
    numeric, text = customers.dataset_features(df)
    assert len(numeric) + len(text) == 28 and text == ["RFM_Segment"]
    assert df.agg(F.sum("Frequency")).first()[0] == 100


def test_fraud_history_and_bad_method(transactions):
    df = customers.customer_dataset(transactions, method="fraud_history")
    want = {r["CustomerId"]: r["f"] for r in transactions.groupBy("CustomerId").agg(F.max("FraudResult").alias("f")).collect()}
    assert {r["CustomerId"]: r["is_high_risk"] for r in df.collect()} == want
    with pytest.raises(ValueError, match="invalid method"):
        customers.customer_dataset(transactions, method="other")


def test_polarities_flag_opposite_ends(spark):
    """Customer k has 2k + 1 purchases, the later the larger k."""
    i = F.col("id")
    tx = spark.range(400).select(
        i.cast("string").alias("TransactionId"), F.floor(F.sqrt("id")).alias("CustomerId"), (i + 1.0).alias("Value"), (i + 1.0).alias("Amount"),
        F.timestamp_seconds(i * 86400).alias("TransactionStartTime"), F.lit("c").alias("ProductCategory"), F.lit("p").alias("ProviderId"), F.lit("w").alias("ChannelId"),
    )
    flagged = {}
    for polarity in ("intended", AS_CODED):
        rows = customers.customer_dataset(tx, restarts=2, polarity=polarity).where("is_high_risk = 1").collect()
        flagged[polarity] = {r["CustomerId"] for r in rows}
    assert flagged["intended"] and flagged[AS_CODED]
    assert max(flagged["intended"]) < min(flagged[AS_CODED])


def test_malformed_rows_fail_or_are_kept_aside(spark):
    folder = scratch_path(spark, "bad")
    lines = ["TransactionId,FraudResult", "T1,0", "T2,x"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(folder)
    schema = readers.submission_schema()
    with pytest.raises(Exception):
        readers.read_csv_typed(spark, folder, schema).collect()
    rows = readers.read_csv_typed(spark, folder, schema, keep_bad_rows=True).collect()
    assert [r[readers.CORRUPT] for r in rows] == [None, "T2,x"]


def test_sinks_reject_other_formats(transactions):
    with pytest.raises(ValueError, match="unsupported format"):
        sinks.write_table(transactions, "/nowhere", "xlsx")


def test_transaction_dataset(spark, csv_file, transactions):
    out, meta = tx_plan.process_transactions(spark, csv_file)
    assert meta["num_samples"] == 100 and meta["target"] == "is_high_risk" and meta["num_features"] == len(out.columns) - 1
    assert out.select("TransactionId").distinct().count() == 100
    # Features belong to their own row: one value per customer, equal to a direct count.
    assert out.where("transaction_count <> 10").count() == 0
    joined = out.join(transactions.select("TransactionId", F.col("Amount").alias("a")), "TransactionId")
    assert joined.where("abs(amount_abs - abs(a)) > 1e-9").count() == 0
    per_customer = out.groupBy("CustomerId").agg(F.count_distinct("is_high_risk").alias("n"))
    assert per_customer.where("n > 1").count() == 0


def test_prepare_dataset(spark, csv_file):
    done = prepare.prepare_dataset(spark, csv_file, scratch_path(spark, "prep"))
    assert {r["part"]: r["n"] for r in done["rates"].collect()} == {"train": 80, "test": 20}
    assert done["counts"].first()["customers"] == 10 and done["missing"].count() == 0
    assert spark.read.option("header", True).csv(done["submission"]).columns == ["TransactionId", "FraudResult"]
    assert spark.read.text(done["dictionary"]).count() == 16


def test_supervised_preprocessing(spark, transactions):
    rows = transactions.withColumn("FraudResult", (F.col("Value") > 5000).cast("int"))
    done = supervised.preprocess_data(rows, ["Amount"], ["ProductCategory", "ChannelId"], "FraudResult")
    assert done.train.count() == 80 and done.test.count() == 20
    assert done.train.columns == ["TransactionId", "FraudResult", *done.feature_names] == done.test.columns
    assert "num_Amount_woe" in done.feature_names and not any("fraud" in n for n in done.feature_names)
    assert done.train.select("TransactionId").intersect(done.test.select("TransactionId")).count() == 0
    with pytest.raises(ValueError, match="missing required columns"):
        supervised.preprocess_data(rows.drop("ProviderId"), ["Amount"], [], "FraudResult")


@pytest.fixture(scope="module")
def labelled(spark):
    x = (F.rand(1) * 10).alias("x")
    df = spark.range(400).select("id", x, (F.rand(2) * 10).alias("z"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"))
    return df.withColumn("y", (F.col("x") + F.col("z") * 0.1 > 7).cast("int")).persist()


def test_search_saves_and_loads_the_same_model(spark, labelled):
    tr, te = split.stratified_split(labelled, "id", "y")
    grid = [{"C": 0.01, "penalty": "l2"}, {"C": 10.0, "penalty": "l2"}]
    run = train.search_model(tr, "logistic_regression", "y", "id", train.preprocessed_head(["x", "z"], ["c"]), settings=grid, folds=3)
    assert run.best_settings["C"] == 10.0 and run.cv_score > 0.9 and len(run.search) == 2
    scored = train.predictions(run.model, te)
    importance = train.feature_importance(run.model, scored)
    assert importance.first()["feature"] == "x" and importance.count() == 4
    path = runs.save_model(run.model, scratch_path(spark, "models"), run.family, {"roc_auc": 1.0}, importance, moment=datetime(2025, 1, 1))
    assert os.path.basename(path) == "logistic_regression_20250101_000000"
    again = train.predictions(runs.load_model(path), te)
    assert scored.select("id", "risk_score").exceptAll(again.select("id", "risk_score")).count() == 0
    assert spark.read.json(path + "/metadata").first()["model_name"] == "logistic_regression"


def test_families_stacking_and_unknown_family(labelled):
    small = {"random_forest": {"n_estimators": [5], "max_depth": [4]}, "gradient_boosting": {"n_estimators": [3], "max_depth": [3]}}
    results, winner, _ = training.train_on_dataset(labelled, "id", "y", small, n_iter=1, folds=2)
    assert winner in results and all(0.8 < r.test_metrics["roc_auc"] <= 1 for r in results.values())
    stacked = train.train_stacking(labelled, "y", "id", train.standard_head(["x", "z"]), {"rf_n_estimators": 5, "rf_max_depth": 4, "gb_n_estimators": 3}, folds=2)
    out = train.predictions(stacked, labelled)
    assert out.count() == 400 and out.where("risk_score < 0 OR risk_score > 1").count() == 0
    with pytest.raises(ValueError, match="unsupported model family"):
        train.classifier("other", {}, "y", "features")


def test_model_types_and_searches(labelled):
    tr, te = split.stratified_split(labelled, "id", "y")
    small = {"C": [0.1, 1.0], "penalty": ["l1", "l2"]}
    grid = train.fit_model(tr, "logistic", "y", "id", ["x", "z"], ["c"], "grid", folds=2, space=small)
    assert len(grid.search) == 4 and grid.cv_score == max(a for _, a in grid.search)
    drawn = train.fit_model(tr, "logistic", "y", "id", ["x"], search="random", n_iter=1, folds=2, space=small)
    assert len(drawn.search) == 1
    plain = train.fit_model(tr, "gradient_boosting", "y", "id", ["x", "z"], search="none", space=small)
    metrics = evaluate.evaluate(train.predictions(plain.model, te), "y", "predicted", "risk_score", "test_")
    assert metrics["test_roc_auc"] > 0.9 and plain.cv_score is None
    for bad in ({"model_type": "svm"}, {"model_type": "logistic", "search": "bayes"}):
        with pytest.raises(ValueError):
            train.fit_model(tr, label="y", key="id", numeric=["x"], **bad)


def test_stacking_search_picks_the_best_settings(labelled):
    settings = [{"rf_n_estimators": 3, "rf_max_depth": 3, "gb_n_estimators": 2}]
    run = train.search_stacking(labelled, "y", "id", train.standard_head(["x", "z"]), settings, folds=2)
    assert run.best_settings == settings[0] and run.cv_score > 0.8
    assert train.predictions(run.model, labelled).count() == 400


def test_proxy_target_polarities_follow_their_quantiles(spark):
    i = F.col("id")
    tx = spark.range(900).select(
        i.alias("TransactionId"), F.floor(F.sqrt("id")).alias("CustomerId"), (i % 50 + 1.0).alias("Amount"), F.timestamp_seconds(i * 86400).alias("TransactionStartTime")
    )
    intended, ranker = target.proxy_target(tx, k=3, share=0.2, restarts=2)
    rows = intended.select("CustomerId", "risk_rank", "is_high_risk").distinct().toPandas()
    edge = rows["risk_rank"].quantile(0.2)
    assert ((rows["risk_rank"] <= edge).astype(int) == rows["is_high_risk"]).all() and sorted(ranker.ranks.values()) == [0, 1, 2]
    coded, _ = target.proxy_target(tx, k=3, share=0.8, polarity=AS_CODED, restarts=2)
    rows = coded.toPandas()
    assert len(rows) == 900 and ((rows["risk_rank"] >= rows["risk_rank"].quantile(0.8)).astype(int) == rows["is_high_risk"]).all()


def test_shapley_values_add_up(labelled):
    tr, te = split.stratified_split(labelled, "id", "y")
    run = train.search_model(tr, "gradient_boosting", "y", "id", train.standard_head(["x", "z"]), settings=[{"n_estimators": 3}], folds=1)
    values = explain.shapley_values(run.model, te, "id", ["x", "z"], permutations=5)
    assert values.select("id").distinct().count() == te.count() and values.count() == 2 * te.count()
    base = explain.expected_value(run.model, explain.background_table(te, "id", ["x", "z"]))
    assert 0 <= base <= 1
    assert explain.shapley_values(run.model, te, "id", ["x", "z"], n_samples=40, permutations=2).select("id").distinct().count() == 40
    assert explain.shapley_importance(values).first()["feature"] == "x"
    total = values.groupBy("id").agg(F.sum("shapley").alias("t"))
    assert total.where("abs(t) > 1").count() == 0


def test_stream_scores_and_rejects_once(spark):
    folder = scratch_path(spark, "stream")
    rows = [("C1", "150.75", 5, 120.5, 3), ("C2", "oops", 5, 1.0, 3), (None, "1.0", 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "customer_id string, transaction_amount string, transaction_count int, avg_transaction_amount double, days_since_last_transaction int")
    df.write.parquet(folder + "/in")
    model = PipelineModel([SQLTransformer(statement="SELECT *, 0.25 AS risk_score FROM __THIS__")])
    for _ in range(2):  # the second start finds nothing new
        stream = scoring.read_requests(spark, folder + "/in", df.schema)
        scoring.score_available(model, stream, folder + "/out", folder + "/bad", folder + "/state")
    out = spark.read.parquet(folder + "/out").collect()
    assert [tuple(r) for r in out] == [("C1", 0.25, "LOW", "1.0.0")]
    reasons = {r["reason"] for r in spark.read.parquet(folder + "/bad").collect()}
    assert reasons == {"transaction_amount is not a double", "customer_id is missing"}


def test_missing_request_columns_reject_every_row(spark):
    df = spark.createDataFrame([("C1",)], "customer_id string")
    assert score.valid_requests(score.check_requests(df)).count() == 0
    bad = spark.createDataFrame([("a", 1.5), ("b", 0.5), ("c", None)], "customer_id string, risk_score double")
    assert score.contract_violations(bad).count() == 2


def test_run_records(spark):
    path = scratch_path(spark, "runs")
    for name in ("first", "second"):
        runs.append_run(runs.run_record(spark, name, {"roc_auc": 0.5, "gap": None}), path)
    got = spark.read.schema(runs.RUN_SCHEMA).json(path).orderBy("model_name").collect()
    assert [r["model_name"] for r in got] == ["first", "second"] and got[0]["metrics"] == {"roc_auc": 0.5}


def test_csv_columns_are_matched_by_name(spark):
    folder = scratch_path(spark, "named")
    for name, lines in {"a": ["FraudResult,extra,TransactionId", "1,x,T1"], "b": ["TransactionId,FraudResult", "T2,0"]}.items():
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(folder)
    rows = readers.read_csv_typed(spark, folder, readers.submission_schema()).collect()
    assert sorted((r["TransactionId"], r["FraudResult"]) for r in rows) == [("T1", 1), ("T2", 0)]
    other = scratch_path(spark, "lacking")
    spark.createDataFrame([("TransactionId\nT1",)], "value string").coalesce(1).write.text(other)
    with pytest.raises(ValueError, match="FraudResult"):
        readers.read_csv_typed(spark, other, readers.submission_schema())


def write_lines(spark, folder, files):
    for lines in files:
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(folder)


def test_untyped_folders_are_matched_by_name(spark):
    folder = scratch_path(spark, "orders")
    write_lines(spark, folder, [["x,y,d", "1,10,2024-01-01"], ["", "y,x,d", "20.5,2,2024-01-02 03:00:00"], ["x,z", "3,word"], [""]])
    df = readers.read_csv_untyped(spark, folder)
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {"x": "int", "y": "double", "d": "timestamp", "z": "string"}
    rows = sorted((r.x, r.y, r.d and str(r.d), r.z) for r in df.collect())
    assert rows == [(1, 10.0, "2024-01-01 00:00:00", None), (2, 20.5, "2024-01-02 03:00:00", None), (3, None, None, "word")]
    mixed = scratch_path(spark, "mixed")
    write_lines(spark, mixed, [["x,y", "1,1"], ["y,x", "a,2"]])
    assert sorted((r.x, r.y) for r in readers.read_csv_untyped(spark, mixed).collect()) == [(1, "1"), (2, "a")]
    empty = scratch_path(spark, "empty")
    write_lines(spark, empty, [[""]])
    assert readers.read_csv_untyped(spark, empty).collect() == []


def test_headers_of_many_files_take_a_job_for_each_different_one(spark):
    folder = scratch_path(spark, "many")
    spark.range(60).repartition(60).selectExpr("concat('T', id) AS TransactionId", "cast(id % 2 AS int) AS FraudResult").write.option("header", True).csv(folder)
    spark.range(60, 80).repartition(20).selectExpr("cast(id % 2 AS int) AS FraudResult", "concat('T', id) AS TransactionId").write.mode("append").option("header", True).option("compression", "gzip").csv(folder)
    spark.sparkContext.setJobGroup("headers", "")
    try:
        df = readers.read_csv_typed(spark, folder, readers.submission_schema())
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert df.selectExpr("count(DISTINCT TransactionId) AS n", "sum(FraudResult) AS s").first() == (80, 40)


def test_modes_are_decided_in_the_type_of_the_column(spark):
    rows = [(9.0, 100, "b"), (10.0, 9, "a"), (9.0, 9, "b"), (10.0, 100, "a"), (float("nan"), None, None), (float("nan"), None, None), (float("nan"), None, None)]
    df = spark.createDataFrame(rows, "x double, n long, s string")
    assert clean.modal_values(df, ["x", "n", "s"]) == {"x": 9.0, "n": 9, "s": "a"}


def test_depths_and_equal_candidates():
    with pytest.raises(ValueError):
        train.classifier("random_forest", {"max_depth": 31}, "y", "f")
    space = {"min_samples_split": [2, 10], "min_samples_leaf": [1, 2, 5], "max_depth": [None, 30]}
    assert len(train.draw_settings(space, 100)) == 3  # leaves of 1, 2 and 5 rows


def test_rows_without_a_key_stay_in_label_joins(spark):
    from tallygrain.operators.joins import label_join

    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (3, "d")], "k long, v string")
    labels = spark.createDataFrame([(1, 5), (None, 9)], "k long, y int")
    assert sorted((r["v"], r["y"]) for r in label_join(rows, labels, "k").collect()) == [("a", 5), ("b", None), ("c", None), ("d", None)]
