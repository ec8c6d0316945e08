"""Encoders, evidence weights, splits, clusters, evaluation, training and scoring queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallygrain.catalog.customers import RFM_SQL, TARGET_SQL
from tallygrain.catalog.tables import LINES, ORDERS, events, lines, orders, rounded, table
from tallygrain.catalog.transactions import full_transactions, plus_zero
from tallygrain.columns import numeric_columns
from tallygrain.functions.amounts import risk_category
from tallygrain.operators import encode, evaluate, explain, rfm, score, split, target, train, woe
from tallygrain.operators.behavior import FEATURE_NAMES
from tallygrain.operators.rfm import target_rfm_table
from tallygrain.plans import customers as customer_plan
from tallygrain.plans import prepare, supervised, training
from tallygrain.plans import transactions as transaction_plan
from tallygrain.session import materialize, scratch_path
from tallygrain.sources import runs
from tallygrain.sources.runs import params_text
from tallygrain.streaming import scoring

# ---- encoders --------------------------------------------------------------

SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def _scaled(spark, sf, method):
    df = table(spark, sf, "lineitem").select("l_partkey", *SCALED)
    return plus_zero(encode.Scale.using(columns=SCALED, method=method).fit(df).transform(df), 6, *SCALED)


def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


def scale_only(spark, sf):
    return _scaled(spark, sf, "scale_only")


def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


def impute_numeric_mode(spark, sf):
    """The most frequent number in place of gaps; the smallest where several are."""
    i = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    df = table(spark, sf, "lineitem").select(
        i.alias("line"), F.when(i % 7 != 0, F.col("l_quantity")).alias("quantity"), F.when(i % 5 != 0, F.col("l_linenumber")).alias("number")
    )
    return encode.Fill.using(columns=["quantity", "number"], strategy="most_frequent").fit(df).transform(df)


def impute_strategies(spark, sf):
    """Median, mean and most frequent value in place of gaps."""
    i = F.col("event_id")
    df = table(spark, sf, "events").select(
        i.alias("TransactionId"),
        F.when(i % 3 != 0, F.col("value")).alias("a"),
        F.when(i % 5 != 0, F.col("value")).alias("b"),
        F.when(i % 4 != 0, F.col("event_type")).alias("c"),
        F.when(i % 4 != 1, F.col("event_type")).alias("d"),
    )
    for stage in (
        encode.Fill.using(columns=["a"], strategy="median"),
        encode.Fill.using(columns=["b"], strategy="mean"),
        encode.Fill.using(columns=["c"], strategy="most_frequent"),
        encode.Fill.using(columns=["d"], strategy="constant", value="missing"),
    ):
        df = stage.fit(df).transform(df)
    return rounded(df, 6, "a", "b")


def onehot(spark, sf):
    """Set indicators only: (part, feature, value)."""
    df = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    model = Pipeline(stages=[*encode.one_hot_stages(["p_type", "p_brand"]), encode.VectorAssembler(inputCols=["p_type__onehot", "p_brand__onehot"], outputCol="features")]).fit(df)
    out = model.transform(df)
    names = encode.feature_names(out)
    wide = encode.vector_to_columns(out, "features", names)
    entry = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").alias("value")) for n in names]))
    return wide.select("p_partkey", entry.alias("e")).select("p_partkey", "e.feature", "e.value").where(F.col("value") != 0)


def onehot_infrequent(spark, sf):
    """Brands below the frequency limit share one category."""
    df = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encode.RareCategories.fit(df, ["p_brand"], 0.04).transform(df)


def variance_select(spark, sf):
    """Columns left after constants are dropped, with their sums."""
    df = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax").withColumn("fixed", F.lit(7.0))
    kept = encode.DropConstant.using(columns=df.columns).fit(df).transform(df)
    entries = [F.struct(F.lit(c).alias("column"), F.round(F.sum(c), 2).alias("total")) for c in kept.columns]
    return kept.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


WOE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def _woe(spark, sf):
    df = table(spark, sf, "lineitem").select("l_partkey", *WOE_COLUMNS, (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return df, woe.WeightOfEvidence.using(label="label", columns=WOE_COLUMNS).fit(df)


def woe_fit(spark, sf):
    _, model = _woe(spark, sf)
    return plus_zero(model.table(spark), 6, "woe").select("column", "bin", "good", "bad", "woe")


def woe_apply(spark, sf):
    df, model = _woe(spark, sf)
    return plus_zero(model.transform(df), 6, *WOE_COLUMNS)


def woe_ratio(spark, sf):
    df = table(spark, sf, "lineitem").select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return plus_zero(woe.woe_by_category(df, "l_linestatus", "label"), 6, "woe")


def _woe_sql(column: str) -> str:
    return f"""{column}_e AS (SELECT list_sort(list_distinct(quantile_cont({column}, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS q FROM src),
{column}_b AS (SELECT src.*, CAST(len(list_filter(q[2:-2], lambda x: x < {column})) AS INTEGER) AS bin FROM src, {column}_e),
{column}_w AS (SELECT bin, CAST(SUM(label) AS BIGINT) AS good, COUNT(*) - CAST(SUM(label) AS BIGINT) AS bad,
  ROUND(LN(((SUM(label) + 0.5) / ((SELECT SUM(label) FROM src) + 1)) / ((COUNT(*) - SUM(label) + 0.5) / ((SELECT COUNT(*) - SUM(label) FROM src) + 1))), 6) + 0.0 AS woe
  FROM {column}_b GROUP BY bin)"""


WOE_SQL = "src AS (SELECT l_partkey, l_quantity, l_extendedprice, l_discount, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem), " + ", ".join(
    _woe_sql(c) for c in WOE_COLUMNS
)

# ---- splits ----------------------------------------------------------------


def temporal_split(spark, sf):
    tx = orders(spark, sf)
    train_part = split.temporal_membership(tx, "TransactionStartTime", "TransactionId")
    return tx.select("TransactionId", F.when(train_part, "train").otherwise("test").alias("part"))


def temporal_rates(spark, sf):
    tx = orders(spark, sf)
    return rounded(prepare.split_rates(*split.temporal_split(tx, "TransactionStartTime", "TransactionId")), 6, "fraud_rate")


def strat_split_sizes(spark, sf):
    tx = orders(spark, sf)
    part = F.when(split.stratified_membership(tx, "TransactionId", "FraudResult"), "train").otherwise("test")
    return tx.groupBy("FraudResult", part.alias("part")).agg(F.count("*").alias("n"))


def grouped_split(spark, sf):
    """Customers per label and part; a customer counts once in its part."""
    tx = orders(spark, sf)
    labelled = tx.drop("FraudResult").join(
        tx.groupBy("CustomerId").agg((F.sum("FraudResult") >= 4).cast("int").alias("label")), "CustomerId"
    )
    tr, te = split.grouped_split(labelled, "CustomerId", "label")
    both = tr.select("CustomerId", "label", F.lit("train").alias("part")).unionAll(te.select("CustomerId", "label", F.lit("test")))
    return both.groupBy("label", "part").agg(F.count_distinct("CustomerId").alias("customers"))


def kfold_sizes(spark, sf):
    return split.stratified_folds(orders(spark, sf), "TransactionId", "FraudResult", 5).groupBy("FraudResult", "fold").agg(F.count("*").alias("n"))


def kfold_in_order(spark, sf):
    return split.stratified_folds(orders(spark, sf), "TransactionId", "FraudResult", 5, seed=None).select("TransactionId", "fold")


def time_series_blocks(spark, sf):
    return split.time_series_blocks(orders(spark, sf), "TransactionStartTime", "TransactionId", 5).select("TransactionId", "block")


# ---- evaluation ------------------------------------------------------------


def scored_orders(spark, sf):
    """Orders with a deterministic score that leans towards the label and has ties."""
    spread = F.pmod(F.col("TransactionId") * 7919, F.lit(997)) / 997.0
    tx = orders(spark, sf)
    return tx.select(
        "TransactionId", F.col("FraudResult").alias("label"), F.round(0.2 * F.col("FraudResult") + 0.7 * spread, 3).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


SCORED = """SELECT o_orderkey AS TransactionId, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
  ROUND(CAST(0.2 AS DOUBLE) * CAST(o_orderstatus = 'F' AS INTEGER) + CAST(0.7 AS DOUBLE) * (((o_orderkey * 7919) % 997) / CAST(997.0 AS DOUBLE)), 3) AS score FROM orders"""

CURVE_SQL = f"""sc AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM ({SCORED})),
tot AS (SELECT CAST(SUM(label) AS DOUBLE) AS p, CAST(COUNT(*) - SUM(label) AS DOUBLE) AS n FROM sc),
g AS (SELECT score, CAST(SUM(label) AS BIGINT) AS pos, COUNT(*) - CAST(SUM(label) AS BIGINT) AS neg FROM sc GROUP BY score),
c AS (SELECT *, CAST(SUM(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(SUM(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp FROM g),
pr AS (SELECT c.*, tp / p AS tpr, fp / n AS fpr, tp / (tp + fp) AS prec, 2 * (tp / (tp + fp)) * (tp / p) / (tp / (tp + fp) + tp / p + 1e-10) AS f1, p, n FROM c, tot),
cm AS (SELECT COUNT(*) FILTER (label = 0 AND predicted = 0) AS tn, COUNT(*) FILTER (label = 0 AND predicted = 1) AS fp,
  COUNT(*) FILTER (label = 1 AND predicted = 0) AS fn, COUNT(*) FILTER (label = 1 AND predicted = 1) AS tp FROM sc)"""


def confusion(spark, sf):
    return evaluate.confusion(scored_orders(spark, sf), "label", "predicted")


RATES = ["accuracy", "precision", "recall", "f1", "f2", "class_ratio"]


def class_metrics(spark, sf):
    return rounded(evaluate.class_metrics(confusion(spark, sf)), 8, *RATES).select(*RATES, "n_samples")


def error_cost(spark, sf):
    return evaluate.class_metrics(confusion(spark, sf)).select("cost_of_errors")


def class_ratio(spark, sf):
    return rounded(evaluate.class_distribution(scored_orders(spark, sf), "label"), 8, "share")


def _scores(spark, sf):
    return evaluate.score_table(scored_orders(spark, sf), "label", "score")


def roc_auc(spark, sf):
    return rounded(evaluate.ranking_metrics(_scores(spark, sf)), 8, "roc_auc").select("roc_auc")


def avg_precision(spark, sf):
    return rounded(evaluate.ranking_metrics(_scores(spark, sf)), 8, "average_precision").select("average_precision")


def ks_stat(spark, sf):
    return rounded(evaluate.ranking_metrics(_scores(spark, sf)), 8, "ks_statistic").select("ks_statistic")


def best_threshold(spark, sf):
    return rounded(evaluate.ranking_metrics(_scores(spark, sf)), 8, "best_f1").select("best_threshold", "best_f1")


def roc_pr_curves(spark, sf):
    return rounded(evaluate.curve(_scores(spark, sf)), 8, "tpr", "fpr", "precision", "f1").select("threshold", "tp", "fp", "tpr", "fpr", "precision", "f1")


def log_loss(spark, sf):
    return rounded(evaluate.log_loss(scored_orders(spark, sf), "label", "score"), 8, "log_loss")


def balanced_weights(spark, sf):
    weighted = train.add_class_weight(scored_orders(spark, sf), "label")
    return weighted.groupBy("label").agg(F.round(F.avg("class_weight"), 8).alias("weight"), F.round(F.sum("class_weight"), 4).alias("total"))


def best_family(spark, sf):
    """Families compared by a metric: here each order status by its mean price."""
    per = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("model_name")).agg(F.round(F.avg("o_totalprice"), 4).alias("roc_auc"))
    per, _ = materialize(per, "families")
    results = {r["model_name"]: train.Trained(r["model_name"], None, None, None, test_metrics={"roc_auc": r["roc_auc"]}) for r in per.orderBy("model_name").collect()}
    return per.where(F.col("model_name") == train.best_family(results))


# ---- clusters --------------------------------------------------------------

CENTROIDS = [[-0.5, 0.5, 0.5], [0.0, 0.0, 0.0], [1.5, -0.8, -0.7]]


def fixed_clusters(spark, sf):
    customers, rows = target_rfm_table(orders(spark, sf), money_scale=2)
    scales = encode.Scale.using(columns=["recency", "frequency", "monetary"], method="standard").fit(customers)
    ranker = target.RiskRanker(scales, CENTROIDS, {0: 2, 1: 1, 2: 0})
    return ranker.transform(customers), rows


def kmeans_assign_fixed(spark, sf):
    return fixed_clusters(spark, sf)[0].select("CustomerId", "cluster")


def cluster_means(spark, sf):
    means = target.cluster_means(fixed_clusters(spark, sf)[0], ["recency", "frequency", "monetary", "rfm_score"])
    return rounded(means, 4, "recency", "frequency", "monetary", "rfm_score")


def cluster_risk_rank(spark, sf):
    """Rank of every cluster by mean score, joined to its customers as literals."""
    clustered, _ = fixed_clusters(spark, sf)
    ranks = target.cluster_risk_rank(target.cluster_means(clustered, ["rfm_score"]))
    return clustered.select("CustomerId", "cluster", target.map_values(F.col("cluster"), ranks).cast("int").alias("risk_rank"))


def cluster_high_risk(spark, sf):
    """The flagged cluster under both polarities."""
    clustered, _ = fixed_clusters(spark, sf)
    means = target.cluster_means(
        clustered.select("cluster", F.col("recency").alias("Recency"), F.col("frequency").alias("Frequency"), F.col("monetary").alias("Monetary")),
        ["Recency", "Frequency", "Monetary"],
    )
    means, _ = materialize(means, "cluster-means")
    chosen = {p: target.high_risk_cluster(means, polarity=p) for p in (target.INTENDED, target.AS_CODED)}
    flag = {p: (F.col("cluster") == c).cast("int").alias(p) for p, c in chosen.items()}
    return clustered.select("CustomerId", *flag.values())


def threshold_label(spark, sf):
    clustered, _ = fixed_clusters(spark, sf)
    intended = target.threshold_label(clustered, share=0.2).withColumnRenamed("is_high_risk", "intended")
    both = target.threshold_label(intended, share=0.8, polarity=target.AS_CODED).withColumnRenamed("is_high_risk", "as_coded")
    return both.select("CustomerId", "intended", "as_coded")


def kmeans_label(spark, sf):
    """Customer path: cluster labels of all customers, in the wide table."""
    return customer_plan.customer_dataset(orders(spark, sf), money_scale=2)


def proxy_target(spark, sf):
    """Target path: labels on transactions."""
    out, _ = target.proxy_target(orders(spark, sf), k=4, money_scale=2)
    return out.select("TransactionId", "CustomerId", "risk_rank", "rfm_score", "is_high_risk")


CLUSTER_SQL = f"""{TARGET_SQL},
z AS (SELECT w.*, (recency - AVG(recency) OVER ()) / STDDEV_POP(recency) OVER () AS zr, (frequency - AVG(frequency) OVER ()) / STDDEV_POP(frequency) OVER () AS zf,
  (monetary - AVG(monetary) OVER ()) / STDDEV_POP(monetary) OVER () AS zm FROM weighted w),
d AS (SELECT *, (zr + 0.5) ** 2 + (zf - 0.5) ** 2 + (zm - 0.5) ** 2 AS d0, zr ** 2 + zf ** 2 + zm ** 2 AS d1, (zr - 1.5) ** 2 + (zf + 0.8) ** 2 + (zm + 0.7) ** 2 AS d2 FROM z),
cl AS (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d),
cmean AS (SELECT cluster, AVG(recency) AS recency, AVG(frequency) AS frequency, AVG(monetary) AS monetary, AVG(rfm_score) AS rfm_score FROM cl GROUP BY cluster)"""

# ---- scoring ---------------------------------------------------------------

LOGIT = "1 / (1 + exp(-(0.002 * transaction_amount - 0.05 * transaction_count + 0.01 * days_since_last_transaction - 0.4)))"


def fixed_model(spark):
    """A scoring model with known coefficients."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {LOGIT} AS risk_score FROM __THIS__")])


def requests(spark, sf):
    """Scoring requests from events, some of them unreadable."""
    e = table(spark, sf, "events")
    i = F.col("event_id")
    return e.select(
        F.when(i % 19 != 0, F.concat(F.lit("C"), "user_id")).alias("customer_id"),
        F.when(i % 17 == 0, "many").otherwise(F.col("value").cast("string")).alias("transaction_amount"),
        (i % 10).cast("string").alias("transaction_count"),
        F.col("value").alias("avg_transaction_amount"),
        F.when(i % 23 == 0, F.lit(2.5)).otherwise(F.dayofmonth("ts").cast("double")).alias("days_since_last_transaction"),
    )


REQUESTS = """SELECT CASE WHEN event_id % 19 <> 0 THEN 'C' || user_id END AS customer_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS transaction_amount,
  event_id % 10 AS transaction_count, value AS avg_transaction_amount, CASE WHEN event_id % 23 = 0 THEN NULL ELSE day(ts) END AS days_since_last_transaction,
  event_id % 17 = 0 AS bad_amount, event_id % 23 = 0 AS bad_days, event_id % 19 = 0 AS no_id FROM events"""
SCORE_SQL = "1 / (1 + exp(-(CAST(0.002 AS DOUBLE) * transaction_amount - CAST(0.05 AS DOUBLE) * transaction_count + CAST(0.01 AS DOUBLE) * days_since_last_transaction - CAST(0.4 AS DOUBLE))))"
CATEGORY_SQL = "CASE WHEN s < 0.3 THEN 'LOW' WHEN s < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END"


def risk_category_query(spark, sf):
    return scored_orders(spark, sf).select("TransactionId", "score", risk_category(F.col("score")).alias("risk_category"))


def request_contract(spark, sf):
    """Rejected requests per reason."""
    return score.rejected_requests(score.check_requests(requests(spark, sf))).groupBy("reason").agg(F.count("*").alias("n"))


def score_batch(spark, sf):
    valid = score.valid_requests(score.check_requests(requests(spark, sf)))
    return rounded(score.score(fixed_model(spark), valid), 8, "risk_score")


def score_contract(spark, sf):
    """Output rows outside the contract, here for scores stretched beyond 1."""
    stretched = scored_orders(spark, sf).select("TransactionId", (F.col("score") * 1.5).alias("risk_score"))
    return score.contract_violations(stretched).agg(F.count("*").alias("violations"))


def score_stream(spark, sf):
    """The same scoring as a stream over files; counts per category and the rejects."""
    folder = scratch_path(spark, "stream")
    requests(spark, sf).write.parquet(f"{folder}/in")
    schema = requests(spark, sf).schema
    stream = scoring.read_requests(spark, f"{folder}/in", schema)
    scoring.score_available(fixed_model(spark), stream, f"{folder}/out", f"{folder}/bad", f"{folder}/state")
    out = spark.read.parquet(f"{folder}/out").select("risk_category")
    bad = spark.read.parquet(f"{folder}/bad").select(F.lit("REJECTED").alias("risk_category"))
    return out.unionAll(bad).groupBy("risk_category").agg(F.count("*").alias("n"))


# ---- training --------------------------------------------------------------

NUMBERS = [c for c in FEATURE_NAMES if c != "RFM_Segment"]


def labelled_customers(spark, sf):
    """Customer dataset with cluster labels, written once per call."""
    df = customer_plan.customer_dataset(orders(spark, sf), money_scale=2)
    return materialize(df, "labelled")[0]


def _metrics(spark, name, metrics):
    return spark.createDataFrame([(name, k, float(v)) for k, v in metrics.items() if v is not None], "model string, metric string, value double")


def _train(spark, sf, family, settings, folds=5):
    data = labelled_customers(spark, sf)
    tr, te = split.stratified_split(data, "CustomerId", "is_high_risk")
    run = train.search_model(tr, family, "is_high_risk", "CustomerId", train.standard_head(NUMBERS), settings=settings, folds=folds)
    return run, te


def train_logistic(spark, sf):
    """Two settings of the logistic family under cross validation, test metrics."""
    run, te = _train(spark, sf, "logistic_regression", train.draw_settings(train.LOGISTIC_SPACE, 2))
    scored = train.predictions(run.model, te)
    return _metrics(spark, run.family, evaluate.evaluate(scored, "is_high_risk", "predicted", "risk_score"))


def train_forest(spark, sf):
    run, te = _train(spark, sf, "random_forest", [{"n_estimators": 100, "max_depth": 10}], folds=1)
    scored = train.predictions(run.model, te)
    return train.feature_importance(run.model, scored)


def train_boosting(spark, sf):
    run, te = _train(spark, sf, "gradient_boosting", [{"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}], folds=1)
    return train.predictions(run.model, te).select("CustomerId", "is_high_risk", "predicted", "risk_score")


def train_stacking(spark, sf):
    data = labelled_customers(spark, sf)
    tr, te = split.stratified_split(data, "CustomerId", "is_high_risk")
    model = train.train_stacking(
        tr, "is_high_risk", "CustomerId", train.standard_head(NUMBERS), {"rf_n_estimators": 10, "rf_max_depth": 5, "gb_n_estimators": 5}, folds=2
    )
    return train.predictions(model, te).select("CustomerId", "is_high_risk", "predicted", "risk_score")


def train_search(spark, sf):
    """Grid of logistic settings with their cross-validated areas."""
    grid = train.draw_settings(train.LOGISTIC_SPACE, 12)
    run, _ = _train(spark, sf, "logistic_regression", grid)
    return spark.createDataFrame(run.search, "settings string, cv_score double").withColumn(
        "best", F.col("settings") == params_text(run.best_settings)
    )


def train_families(spark, sf):
    """All three families by random search; the winner by test area."""
    small = {
        "logistic_regression": {"C": [1.0], "penalty": ["l2"]},
        "random_forest": {"n_estimators": [10], "max_depth": [5]},
        "gradient_boosting": {"n_estimators": [5], "max_depth": [3]},
    }
    data = labelled_customers(spark, sf).select("CustomerId", *NUMBERS, "is_high_risk")
    results, winner, _ = training.train_on_dataset(data, families=small, n_iter=1, folds=2)
    rows = [(f, float(r.cv_score), float(r.test_metrics["roc_auc"]), f == winner) for f, r in results.items()]
    return spark.createDataFrame(rows, "model_name string, cv_score double, roc_auc double, best boolean")


def model_roundtrip(spark, sf):
    """Rows whose score changes when the model is saved with its records and loaded again."""
    run, te = _train(spark, sf, "logistic_regression", [{"C": 1.0}], folds=1)
    before = train.predictions(run.model, te).select("CustomerId", F.col("risk_score").alias("before"))
    metrics = evaluate.evaluate(train.predictions(run.model, te), "is_high_risk", "predicted", "risk_score")
    path = runs.save_model(run.model, scratch_path(spark, "models"), run.family, metrics, train.feature_importance(run.model, run.model.transform(te)))
    after = train.predictions(runs.load_model(path), te).select("CustomerId", F.col("risk_score").alias("after"))
    return before.join(after, "CustomerId").agg(F.count_if(F.col("before") != F.col("after")).alias("changed"), F.count("*").alias("n"))


def run_metadata(spark, sf):
    """A run record appended to a table and read back."""
    counts = evaluate.evaluate(scored_orders(spark, sf), "label", "predicted", "score")
    path = scratch_path(spark, "runs")
    runs.append_run(runs.run_record(spark, "fixed", counts), path)
    return spark.read.json(path).select("model_name", "model_type", F.col("metrics.n_samples").alias("n_samples"), F.round("metrics.roc_auc", 6).alias("roc_auc"))


def shapley(spark, sf):
    """Mean absolute attributions of a boosting model."""
    run, te = _train(spark, sf, "gradient_boosting", [{"n_estimators": 5, "max_depth": 3}], folds=1)
    values = explain.shapley_values(run.model, te, "CustomerId", NUMBERS)
    return explain.shapley_importance(values)


def score_customers(spark, sf):
    """Trained model applied to all customers, in the scoring output form."""
    run, _ = _train(spark, sf, "logistic_regression", [{"C": 1.0}], folds=1)
    return score.score(run.model, labelled_customers(spark, sf), "CustomerId")


# ---- preprocessing ---------------------------------------------------------


def preprocess_columns(spark, sf):
    """Impute, scale, encode and assemble, then spread over named columns."""
    df = table(spark, sf, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    out = encode.preprocessing(["p_size", "p_retailprice"], ["p_type"]).fit(df).transform(df)
    wide = encode.vector_to_columns(out, "features", encode.feature_names(out), ["p_partkey"])
    return plus_zero(wide, 6, "p_size", "p_retailprice")


def feature_union(spark, sf):
    tx = orders(spark, sf).drop("FraudResult")
    union = supervised.FeatureUnion.fit(tx, ["Value"], ["ProductCategory", "ChannelId"])
    return union.transform(tx, keep=["TransactionId"])


def preprocess_data(spark, sf):
    """Given label: stratified split, features fitted on train, evidence weights."""
    done = supervised.preprocess_data(orders(spark, sf), ["Value"], ["ProductCategory", "ChannelId"], "FraudResult")
    return done.train.withColumn("part", F.lit("train")).unionByName(done.test.withColumn("part", F.lit("test")))


def preprocess_with_proxy(spark, sf):
    """No label given: a proxy label is made and customers are split as groups."""
    done = supervised.preprocess_data(orders(spark, sf), ["Value"], ["ProductCategory"], money_scale=2)
    return done.train.withColumn("part", F.lit("train")).unionByName(done.test.withColumn("part", F.lit("test")))


def preprocess_unlabelled(spark, sf):
    return supervised.preprocess_data(orders(spark, sf), ["Value"], ["ProductCategory"], create_rfm_target=False).train


def transaction_dataset(spark, sf):
    """Cleaning, profile, time and amount features, and the proxy label, on every row."""
    from tallygrain.operators.clean import clean_transaction_path

    features = transaction_plan.transaction_features(clean_transaction_path(full_transactions(spark, sf)))
    return transaction_plan.add_target(features, money_scale=2)


def prepare_dataset(spark, sf):
    """Raw CSV to a temporal train and test table with companions; their sizes."""
    from tallygrain.sources.sinks import write_table

    raw = write_table(full_transactions(spark, sf), scratch_path(spark, "raw") + "/data.csv", "csv")
    done = prepare.prepare_dataset(spark, raw, scratch_path(spark, "prepared"))
    return rounded(done["rates"], 6, "fraud_rate")


QUERIES = {
    "scale_standard": scale_standard,
    "scale_only": scale_only,
    "scale_minmax": scale_minmax,
    "scale_robust": scale_robust,
    "impute_strategies": impute_strategies,
    "impute_numeric_mode": impute_numeric_mode,
    "onehot": onehot,
    "onehot_infrequent": onehot_infrequent,
    "variance_select": variance_select,
    "woe_fit": woe_fit,
    "woe_apply": woe_apply,
    "woe_ratio": woe_ratio,
    "temporal_split": temporal_split,
    "temporal_rates": temporal_rates,
    "strat_split_sizes": strat_split_sizes,
    "grouped_split": grouped_split,
    "kfold_sizes": kfold_sizes,
    "kfold_in_order": kfold_in_order,
    "time_series_blocks": time_series_blocks,
    "confusion": confusion,
    "class_metrics": class_metrics,
    "error_cost": error_cost,
    "class_ratio": class_ratio,
    "roc_auc": roc_auc,
    "avg_precision": avg_precision,
    "ks_stat": ks_stat,
    "best_threshold": best_threshold,
    "roc_pr_curves": roc_pr_curves,
    "log_loss": log_loss,
    "balanced_weights": balanced_weights,
    "best_family": best_family,
    "kmeans_assign_fixed": kmeans_assign_fixed,
    "cluster_means": cluster_means,
    "cluster_risk_rank": cluster_risk_rank,
    "cluster_high_risk": cluster_high_risk,
    "threshold_label": threshold_label,
    "kmeans_label": kmeans_label,
    "proxy_target": proxy_target,
    "risk_category": risk_category_query,
    "request_contract": request_contract,
    "score_batch": score_batch,
    "score_contract": score_contract,
    "score_stream": score_stream,
    "train_logistic": train_logistic,
    "train_forest": train_forest,
    "train_boosting": train_boosting,
    "train_stacking": train_stacking,
    "train_search": train_search,
    "train_families": train_families,
    "model_roundtrip": model_roundtrip,
    "run_metadata": run_metadata,
    "shapley": shapley,
    "score_customers": score_customers,
    "preprocess_columns": preprocess_columns,
    "feature_union": feature_union,
    "preprocess_data": preprocess_data,
    "preprocess_with_proxy": preprocess_with_proxy,
    "preprocess_unlabelled": preprocess_unlabelled,
    "transaction_dataset": transaction_dataset,
    "prepare_dataset": prepare_dataset,
}


def _scale_sql(shift: str, scale: str) -> str:
    s = ", ".join(f"{shift.format(c=c)} AS a_{c}, {scale.format(c=c)} AS b_{c}" for c in SCALED)
    return f"WITH s AS (SELECT {s} FROM lineitem) SELECT l_partkey, " + ", ".join(f"ROUND(({c} - a_{c}) / b_{c}, 6) + 0.0 AS {c}" for c in SCALED) + " FROM lineitem, s"


_DIRTY = """SELECT event_id AS TransactionId, CASE WHEN event_id % 3 <> 0 THEN value END AS a, CASE WHEN event_id % 5 <> 0 THEN value END AS b,
  CASE WHEN event_id % 4 <> 0 THEN event_type END AS c, CASE WHEN event_id % 4 <> 1 THEN event_type END AS d FROM events"""
_SIZES = """y AS (SELECT label, COUNT(*) AS n FROM src GROUP BY label), t AS (SELECT SUM(n) AS n, SUM(n) - CEIL(0.2 * SUM(n)) AS tr FROM y),
  q AS (SELECT label, y.n, FLOOR(y.n * tr / t.n) AS base, y.n * tr / t.n - FLOOR(y.n * tr / t.n) AS rest, tr FROM y, t),
  r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY rest DESC, label) AS k, tr - SUM(base) OVER () AS free FROM q),
  f AS (SELECT label, n, CAST(base + CASE WHEN k <= free THEN 1 ELSE 0 END AS BIGINT) AS train FROM r)"""
_RATE = {
    "accuracy": "(tp + tn) / (tp + tn + fp + fn)",
    "precision": "tp / (tp + fp)",
    "recall": "tp / (tp + fn)",
    "f1": "2 * tp / (2 * tp + fp + fn)",
    "f2": "5 * tp / (5 * tp + 4 * fn + fp)",
    "class_ratio": "(tp + fn) / (tp + tn + fp + fn)",
}

SQL = {
    "scale_standard": _scale_sql("AVG({c})", "STDDEV_POP({c})"),
    "scale_only": _scale_sql("0", "STDDEV_POP({c})"),
    "scale_minmax": _scale_sql("MIN({c})", "(MAX({c}) - MIN({c}))"),
    "scale_robust": _scale_sql("quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"),
    "impute_numeric_mode": """WITH d AS (SELECT l_orderkey * 10 + l_linenumber AS line, CASE WHEN (l_orderkey * 10 + l_linenumber) % 7 <> 0 THEN l_quantity END AS quantity,
      CASE WHEN (l_orderkey * 10 + l_linenumber) % 5 <> 0 THEN l_linenumber END AS number FROM lineitem)
      SELECT line, COALESCE(quantity, (SELECT quantity FROM d WHERE quantity IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)) AS quantity,
      COALESCE(number, (SELECT number FROM d WHERE number IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)) AS number FROM d""",
    "impute_strategies": f"""WITH d AS ({_DIRTY}), m AS (SELECT c AS top FROM d WHERE c IS NOT NULL GROUP BY c ORDER BY COUNT(*) DESC, c LIMIT 1)
      SELECT TransactionId, ROUND(COALESCE(a, (SELECT quantile_cont(a, 0.5) FROM d)), 6) AS a, ROUND(COALESCE(b, (SELECT AVG(b) FROM d)), 6) AS b,
        COALESCE(c, (SELECT top FROM m)) AS c, COALESCE(d, 'missing') AS d FROM d""",
    "onehot": """SELECT p_partkey, 'p_type_' || p_type AS feature, CAST(1 AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'p_brand_' || p_brand, 1 FROM part""",
    "onehot_infrequent": """WITH c AS (SELECT p_brand, COUNT(*) AS n FROM part GROUP BY p_brand)
      SELECT p_partkey, CASE WHEN n >= 0.04 * (SELECT COUNT(*) FROM part) THEN part.p_brand ELSE '__infrequent' END AS p_brand FROM part JOIN c ON part.p_brand = c.p_brand""",
    "variance_select": """SELECT "column", total FROM (SELECT 'l_quantity' AS "column", ROUND(SUM(l_quantity), 2) AS total, VAR_POP(l_quantity) AS v FROM lineitem
      UNION ALL SELECT 'l_discount', ROUND(SUM(l_discount), 2), VAR_POP(l_discount) FROM lineitem UNION ALL SELECT 'l_tax', ROUND(SUM(l_tax), 2), VAR_POP(l_tax) FROM lineitem
      UNION ALL SELECT 'fixed', 7.0 * COUNT(*), VAR_POP(7.0) FROM lineitem) WHERE v > 0""",
    "woe_fit": f"WITH {WOE_SQL} " + " UNION ALL ".join(f"""SELECT '{c}' AS "column", bin, good, bad, woe FROM {c}_w""" for c in WOE_COLUMNS),
    "woe_apply": f"""WITH {WOE_SQL} SELECT l_partkey, label, a.woe AS l_quantity, b.woe AS l_extendedprice, c.woe AS l_discount FROM (
        SELECT src.*, CAST(len(list_filter(q1.q[2:-2], lambda x: x < l_quantity)) AS INTEGER) AS b1, CAST(len(list_filter(q2.q[2:-2], lambda x: x < l_extendedprice)) AS INTEGER) AS b2,
          CAST(len(list_filter(q3.q[2:-2], lambda x: x < l_discount)) AS INTEGER) AS b3 FROM src, l_quantity_e q1, l_extendedprice_e q2, l_discount_e q3) t
      JOIN l_quantity_w a ON a.bin = b1 JOIN l_extendedprice_w b ON b.bin = b2 JOIN l_discount_w c ON c.bin = b3""",
    "woe_ratio": """WITH src AS (SELECT l_linestatus, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem)
      SELECT l_linestatus, CAST(SUM(label) AS BIGINT) AS good, COUNT(*) - CAST(SUM(label) AS BIGINT) AS bad,
        ROUND(LN(((SUM(label) + 0.5) / ((SELECT SUM(label) FROM src) + 1)) / ((COUNT(*) - SUM(label) + 0.5) / ((SELECT COUNT(*) - SUM(label) FROM src) + 1))), 6) + 0.0 AS woe
      FROM src GROUP BY l_linestatus""",
    "temporal_split": f"""SELECT TransactionId, CASE WHEN ROW_NUMBER() OVER (ORDER BY TransactionStartTime, TransactionId) <= (SELECT FLOOR(0.8 * COUNT(*)) FROM orders)
      THEN 'train' ELSE 'test' END AS part FROM ({ORDERS})""",
    "temporal_rates": f"""SELECT part, COUNT(*) AS n, ROUND(AVG(FraudResult), 6) AS fraud_rate FROM (SELECT FraudResult, CASE WHEN ROW_NUMBER() OVER (ORDER BY TransactionStartTime, TransactionId)
      <= (SELECT FLOOR(0.8 * COUNT(*)) FROM orders) THEN 'train' ELSE 'test' END AS part FROM ({ORDERS})) GROUP BY part""",
    "strat_split_sizes": f"""WITH src AS (SELECT FraudResult AS label FROM ({ORDERS})), {_SIZES}
      SELECT label AS FraudResult, 'train' AS part, train AS n FROM f UNION ALL SELECT label, 'test', n - train FROM f""",
    "grouped_split": f"""WITH src AS (SELECT CustomerId, CAST(SUM(FraudResult) >= 4 AS INTEGER) AS label FROM ({ORDERS}) GROUP BY CustomerId), {_SIZES}
      SELECT label, 'train' AS part, train AS customers FROM f UNION ALL SELECT label, 'test', n - train FROM f""",
    "kfold_sizes": f"""SELECT FraudResult, CAST(pos % 5 AS INTEGER) AS fold, COUNT(*) AS n FROM (SELECT FraudResult, ROW_NUMBER() OVER (ORDER BY FraudResult, TransactionId) - 1 AS pos
      FROM ({ORDERS})) GROUP BY 1, 2""",
    "kfold_in_order": f"""WITH o AS ({ORDERS}), p AS (SELECT FraudResult, (ROW_NUMBER() OVER (ORDER BY FraudResult, TransactionId) - 1) % 5 AS fold FROM o),
      s AS (SELECT FraudResult, fold, COUNT(*) AS n FROM p GROUP BY 1, 2), e AS (SELECT FraudResult, fold, SUM(n) OVER (PARTITION BY FraudResult ORDER BY fold) AS upto FROM s),
      r AS (SELECT TransactionId, FraudResult, ROW_NUMBER() OVER (PARTITION BY FraudResult ORDER BY TransactionId) AS k FROM o)
      SELECT TransactionId, CAST(MIN(fold) AS INTEGER) AS fold FROM r JOIN e ON r.FraudResult = e.FraudResult AND k <= upto GROUP BY TransactionId""",
    "time_series_blocks": f"""WITH r AS (SELECT TransactionId, ROW_NUMBER() OVER (ORDER BY TransactionStartTime, TransactionId) AS k, COUNT(*) OVER () AS n FROM ({ORDERS}))
      SELECT TransactionId, CAST(CASE WHEN k <= n - 5 * (n // 6) THEN 0 ELSE 1 + (k - (n - 5 * (n // 6)) - 1) // (n // 6) END AS INTEGER) AS block FROM r""",
    "confusion": f"WITH {CURVE_SQL} SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives FROM cm",
    "class_metrics": f"WITH {CURVE_SQL} SELECT " + ", ".join(f"ROUND({e}, 8) AS {n}" for n, e in _RATE.items()) + ", tp + tn + fp + fn AS n_samples FROM cm",
    "error_cost": f"WITH {CURVE_SQL} SELECT 10 * fn + 2 * fp AS cost_of_errors FROM cm",
    "class_ratio": f"WITH {CURVE_SQL} SELECT label, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM sc), 8) AS share FROM sc GROUP BY label",
    "roc_auc": f"WITH {CURVE_SQL} SELECT ROUND(SUM(neg * (tp - pos / 2)) / MAX(p * n), 8) AS roc_auc FROM pr",
    "avg_precision": f"WITH {CURVE_SQL} SELECT ROUND(SUM(pos / p * prec), 8) AS average_precision FROM pr",
    "ks_stat": f"WITH {CURVE_SQL} SELECT ROUND(GREATEST(0, MAX(tpr - fpr)), 8) AS ks_statistic FROM pr",
    "best_threshold": f"WITH {CURVE_SQL} SELECT score AS best_threshold, ROUND(f1, 8) AS best_f1 FROM pr ORDER BY f1 DESC, score LIMIT 1",
    "roc_pr_curves": f"WITH {CURVE_SQL} SELECT score AS threshold, tp, fp, ROUND(tpr, 8) AS tpr, ROUND(fpr, 8) AS fpr, ROUND(prec, 8) AS precision, ROUND(f1, 8) AS f1 FROM pr",
    "log_loss": f"""WITH {CURVE_SQL}, k AS (SELECT label, GREATEST(LEAST(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16) AS s FROM sc)
      SELECT ROUND(AVG(CASE WHEN label = 1 THEN -LN(s) ELSE -LN(1 - s) END), 8) AS log_loss FROM k""",
    "balanced_weights": f"""WITH {CURVE_SQL} SELECT label, ROUND((SELECT COUNT(*) FROM sc) / (2.0 * COUNT(*)), 8) AS weight, ROUND((SELECT COUNT(*) FROM sc) / CAST(2.0 AS DOUBLE), 4) AS total FROM sc GROUP BY label""",
    "best_family": """SELECT o_orderstatus AS model_name, ROUND(AVG(o_totalprice), 4) AS roc_auc FROM orders GROUP BY o_orderstatus ORDER BY 2 DESC LIMIT 1""",
    "kmeans_assign_fixed": f"WITH {CLUSTER_SQL} SELECT CustomerId, cluster FROM cl",
    "cluster_means": f"WITH {CLUSTER_SQL} SELECT cluster, ROUND(recency, 4) AS recency, ROUND(frequency, 4) AS frequency, ROUND(monetary, 4) AS monetary, ROUND(rfm_score, 4) AS rfm_score FROM cmean",
    "cluster_risk_rank": f"""WITH {CLUSTER_SQL}, rk AS (SELECT cluster, CAST(ROW_NUMBER() OVER (ORDER BY rfm_score, cluster) - 1 AS INTEGER) AS risk_rank FROM cmean)
      SELECT CustomerId, cl.cluster, risk_rank FROM cl JOIN rk ON cl.cluster = rk.cluster""",
    "cluster_high_risk": f"""WITH {CLUSTER_SQL}, sc AS (SELECT cluster, RANK() OVER (ORDER BY recency DESC) + RANK() OVER (ORDER BY frequency) + RANK() OVER (ORDER BY monetary) AS s FROM cmean)
      SELECT CustomerId, CAST(cluster = (SELECT cluster FROM sc ORDER BY s, cluster LIMIT 1) AS INTEGER) AS intended,
        CAST(cluster = (SELECT cluster FROM sc ORDER BY s DESC, cluster LIMIT 1) AS INTEGER) AS as_coded FROM cl""",
    "threshold_label": f"""WITH {CLUSTER_SQL}, r AS (SELECT CustomerId, 2 - cluster AS k FROM cl) SELECT CustomerId, CAST(k <= (SELECT quantile_cont(k, 0.2) FROM r) AS INTEGER) AS intended,
      CAST(k >= (SELECT quantile_cont(k, 0.8) FROM r) AS INTEGER) AS as_coded FROM r""",
    "risk_category": f"SELECT TransactionId, score, CASE WHEN score < 0.3 THEN 'LOW' WHEN score < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_category FROM ({SCORED})",
    "request_contract": f"""SELECT reason, COUNT(*) AS n FROM (SELECT concat_ws('; ', CASE WHEN no_id THEN 'customer_id is missing' END, CASE WHEN bad_amount THEN 'transaction_amount is not a double' END,
      CASE WHEN bad_days THEN 'days_since_last_transaction is not a long' END) AS reason FROM ({REQUESTS})) WHERE reason <> '' GROUP BY reason""",
    "score_batch": f"""SELECT customer_id, ROUND(s, 8) AS risk_score, {CATEGORY_SQL} AS risk_category, '1.0.0' AS model_version
      FROM (SELECT customer_id, {SCORE_SQL} AS s FROM ({REQUESTS}) WHERE NOT (no_id OR bad_amount OR bad_days))""",
    "score_contract": f"SELECT COUNT(*) AS violations FROM ({SCORED}) WHERE score * 1.5 > 1",
    "score_stream": f"""SELECT risk_category, COUNT(*) AS n FROM (SELECT CASE WHEN no_id OR bad_amount OR bad_days THEN 'REJECTED' ELSE {CATEGORY_SQL} END AS risk_category
      FROM (SELECT *, {SCORE_SQL} AS s FROM ({REQUESTS}))) GROUP BY risk_category""",
    "run_metadata": f"WITH {CURVE_SQL} SELECT 'fixed' AS model_name, 'fixed' AS model_type, CAST(MAX(p + n) AS DOUBLE) AS n_samples, ROUND(SUM(neg * (tp - pos / 2)) / MAX(p * n), 6) AS roc_auc FROM pr",
    "preprocess_columns": "WITH s AS (SELECT AVG(p_size) AS ma, STDDEV_POP(p_size) AS sa, AVG(p_retailprice) AS mb, STDDEV_POP(p_retailprice) AS sb FROM part) SELECT p_partkey, "
    + "ROUND((p_size - ma) / sa, 6) + 0.0 AS p_size, ROUND((p_retailprice - mb) / sb, 6) + 0.0 AS p_retailprice, "
    + ", ".join(f"CAST(p_type = '{t}' AS DOUBLE) AS p_type_{t}" for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))
    + " FROM part, s",
    "model_roundtrip": "SELECT CAST(0 AS BIGINT) AS changed, CAST(CEIL(0.2 * COUNT(DISTINCT o_custkey)) AS BIGINT) AS n FROM orders",
    "prepare_dataset": f"""SELECT part, COUNT(*) AS n, ROUND(AVG(FraudResult), 6) AS fraud_rate FROM (SELECT FraudResult, CASE WHEN ROW_NUMBER() OVER (ORDER BY TransactionStartTime, CAST(TransactionId AS VARCHAR))
      <= (SELECT FLOOR(0.8 * COUNT(*)) FROM orders) THEN 'train' ELSE 'test' END AS part FROM ({ORDERS})) GROUP BY part""",
}
