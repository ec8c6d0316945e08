import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallygrain.operators import grid_logistic, split, train, tree_shapley
from tallygrain.operators.encode import RareCategories
from tallygrain.plans.supervised import FeatureUnion
from tallygrain.session import scratch_path
from tallygrain.sources import artifacts, runs

NAMES = list("abcdef")


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 6)) * [1, 5, 0.2, 1, 1, 1] + [0, 3, 0, 0, 0, 0]
    y = (x @ [1, 0.3, 2, 0, 0, -1] + x[:, 0] * x[:, 3] + rng.normal(size=len(x)) > 2).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "k long, " + ", ".join(f"{c} double" for c in NAMES) + ", y int").cache()


@pytest.fixture(scope="module")
def folded(labelled):
    return split.stratified_folds(train.add_class_weight(labelled, "y"), "k", "y", 3, 42, "fold")


GRID = [{"C": c, "penalty": p} for c in (0.001, 0.1, 10) for p in ("l1", "l2")]


def test_all_models_at_once_are_the_single_ones(labelled, folded):
    n = float(labelled.count())
    head = train.standard_head(NAMES)
    rows, widths = grid_logistic.fold_rows(folded, head, "y", train.WEIGHT, "features", [0, 1, 2])
    betas = grid_logistic.fit_all(rows.where("not held"), widths, GRID, n)
    for fold, i in ((0, 1), (1, 2), (2, 3), (0, 4), (1, 5)):
        single = Pipeline(stages=[*head, train.classifier("logistic_regression", GRID[i], "y", "features", n)]).fit(folded.where(F.col("fold") != fold)).stages[-1]
        got = betas[fold][:, i]
        assert np.allclose(got, [single.intercept, *single.coefficients.toArray()], atol=2e-3)


def test_areas_are_those_of_single_fits(labelled, folded):
    n = float(labelled.count())
    got = grid_logistic.grid_areas(folded, train.standard_head(NAMES), GRID, "y", train.WEIGHT, "features", n, [0, 1, 2])
    tails = [train.classifier("logistic_regression", s, "y", "features", n) for s in GRID[2:4]]
    want = train.cross_validate(folded, train.standard_head(NAMES), tails, "y", [0, 1, 2])
    assert got[2:4] == pytest.approx(want, abs=2e-3)
    assert got[0] == pytest.approx(0.5)  # nothing is left of so strong an l1 penalty: all scores tie


def test_partial_sums_merged_by_tasks(labelled, folded, monkeypatch):
    rows, widths = grid_logistic.fold_rows(folded, train.standard_head(NAMES), "y", train.WEIGHT, "features", [0, 1])
    betas = {m: np.full((7, 2), 0.1) for m in (0, 1)}
    one = grid_logistic.one_pass(rows.repartition(7), betas, True, False)
    two = grid_logistic.one_pass(rows.repartition(7), betas, True, True)
    assert all(np.allclose(one[m], two[m]) for m in betas)


def test_gradient_steps_where_curvatures_are_too_many(labelled, folded, monkeypatch):
    monkeypatch.setattr(grid_logistic, "CURVATURE", 0)
    monkeypatch.setattr(grid_logistic, "PASSES", 6)
    rows, widths = grid_logistic.fold_rows(folded, train.standard_head(NAMES), "y", train.WEIGHT, "features", [0])
    slow = grid_logistic.fit_all(rows.where("not held"), widths, GRID[:4], 700.0)[0]
    monkeypatch.undo()
    fast = grid_logistic.fit_all(rows.where("not held"), widths, GRID[:4], 700.0)[0]
    assert np.abs(slow - fast).max() < 0.05


def test_classes_that_part_take_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 3)) * [1, 3, 0.5] + [0.4, 0, 2]
    x[:, 2] = 5.0  # a constant column has no part in it
    rows = [(i, *map(float, x[i]), int(x[i, 0] > 0.1)) for i in range(len(x))]
    df = train.add_class_weight(spark.createDataFrame(rows, "k long, a double, b double, c double, y int"), "y")
    table, widths = grid_logistic.fold_rows(split.stratified_folds(df, "k", "y", 2, 42, "fold"), train.standard_head(["a", "b", "c"]), "y", train.WEIGHT, "features", [0, 1])
    passes, one_pass = [], grid_logistic.one_pass
    monkeypatch.setattr(grid_logistic, "one_pass", lambda *a: passes.append(0) or one_pass(*a))
    grid = [{"C": c, "penalty": p} for c in (0.1, 10) for p in ("l1", "l2")]
    weight_sum = 1e6  # so weak a penalty that the coefficients get large
    betas = grid_logistic.fit_all(table.where("not held"), widths, grid, weight_sum)
    assert len(passes) < 30
    for m, beta in betas.items():  # and at the end no setting has a slope left
        sums = one_pass(table.where(f"not held and model = {m}"), {m: beta}, False, False)[m]
        slopes = (sums[1 + len(grid) :] / sums[0]).reshape(4, len(grid))
        for i, s in enumerate(grid):
            reg, b = 1 / (s["C"] * weight_sum), beta[1:, i]
            pull = np.sign(b) * reg if s["penalty"] == "l1" else reg * b
            free = b != 0
            assert np.abs(b).max() > 5 and abs(slopes[0, i]) < 5e-2 * reg * np.abs(b).max()
            assert np.abs(slopes[1:, i] + pull)[free].max() < 5e-2 * reg * (1 if s["penalty"] == "l1" else np.abs(b).max())
            assert (np.abs(slopes[1:, i])[~free] <= 1.01 * reg).all()


def test_steps_of_columns_that_go_along_with_the_intercept():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 5)) * [1e-3, 1, 1, 1, 1] + [0.5, 0, 0, 0, 0]])
    x[:, 3] = x[:, 2] + 1e-2 * x[:, 3]
    h, beta, gradient, bound = x.T @ x / 300, rng.normal(size=6), rng.normal(size=6) * [1, 0.5, 1, 1, 1, 1e-3], 0.05
    got = grid_logistic._proximal_steps(beta[None], gradient[None], h[None], np.array([bound]), np.array([0.0]))[0]
    slope = gradient + h @ (got - beta)
    free = got[1:] != 0
    assert abs(slope[0]) < 1e-4 and np.allclose(slope[1:][free], -bound * np.sign(got[1:][free]), atol=1e-4) and (np.abs(slope[1:][~free]) <= bound + 1e-4).all()


def test_areas_in_ranges_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(grid_logistic, "RANGE_ROWS", 40)
    monkeypatch.setattr(grid_logistic, "KEPT", 500)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=600) * 100, rng.integers(0, 3, 600)])
    rows = [(int(f), True, float(rng.random() < 0.4), 1.0, [float(v) for v in x[i]]) for f in (1, 2) for i in range(600)]
    df = spark.createDataFrame(rows, "model int, held boolean, y double, w double, x array<double>")
    blocks = None
    for f in (1, 2):
        part = df.where(f"model = {f}").drop("model").repartition(3).mapInArrow(grid_logistic._blocks, "held boolean, rows int, wide int, block binary").select(F.lit(f).alias("model"), "*")
        blocks = part if blocks is None else blocks.unionAll(part)
    # Margins far beyond 50, few different ones, and all the same.
    betas = {f: np.array([[0.0, 1.0, 3.0], [f, 0.0, 0.0], [0.5, 1.0, 0.0]]) for f in (1, 2)}
    ends = grid_logistic._range_ends(blocks, betas)
    assert len(ends[1][0]) > 10 and ends[1][0][0] < -50 and len(ends[1][1]) == 3 and list(ends[1][2]) == [3.0]
    got = grid_logistic.areas(blocks, betas, 3)
    for f in (1, 2):
        y = np.array([r[2] for r in rows if r[0] == f])
        for s in range(3):
            score = np.column_stack([np.ones(600), x]) @ betas[f][:, s]
            pos, neg = score[y == 1][:, None], score[y == 0][None]
            assert got[f, s] == pytest.approx(((pos > neg) + (pos == neg) / 2).mean(), abs=1e-12)
    assert got[1, 2] == 0.5


def test_search_in_time_never_looks_ahead(spark, labelled):
    timed = labelled.withColumn("t", F.timestamp_seconds(1_600_000_000 + F.col("k") * 60))
    for gap in (0, 7, 200):
        rows = split.time_series_plan(timed, "t", "k", 4, gap).select("k", "fold", "usable").collect()
        for fold in range(1, 5):
            trained, tested = [r.k for r in rows if r.usable <= fold], [r.k for r in rows if r.fold == fold]
            assert len(tested) == 140 and min(tested) == 700 - (5 - fold) * 140
            assert sorted(trained) == list(range(max(0, min(tested) - gap)))
    with pytest.raises(ValueError):
        split.time_series_plan(timed, "t", "k", 4, -1)
    run = train.search_model(timed, "logistic_regression", "y", "k", train.standard_head(NAMES), settings=GRID[2:4], folds=4, time="t", gap=5)
    trees = train.search_model(timed, "random_forest", "y", "k", train.standard_head(NAMES), settings=[{"n_estimators": 3, "max_depth": 3}], folds=4, time="t")
    assert 0.5 < run.cv_score <= 1 and 0.5 < trees.cv_score <= 1 and run.seconds > 0


@pytest.mark.parametrize("family, settings", [("gradient_boosting", {"n_estimators": 8, "max_depth": 4}), ("random_forest", {"n_estimators": 6, "max_depth": 9})])
def test_tree_attributions_against_all_feature_sets(labelled, family, settings):
    model = Pipeline(stages=[*train.standard_head(NAMES), train.classifier(family, settings, "y", "features")]).fit(train.add_class_weight(labelled, "y"))
    found = tree_shapley.leaves(model.stages[-1])
    scored = model.transform(labelled)
    x = np.array([r.features.toArray() for r in scored.orderBy("k").limit(3).collect()])

    def value(known, row):
        agrees = [leaf.agrees(row[None])[0] for leaf in found]
        return sum(leaf.value * np.prod([float(a[k]) if f in known else leaf.shares[k] for k, f in enumerate(leaf.features)]) for leaf, a in zip(found, agrees, strict=True))

    got = tree_shapley.attributions(x, found)
    for j in range(6):
        others, want = [f for f in range(6) if f != j], 0.0
        for size in range(6):
            for known in itertools.combinations(others, size):
                want += math.factorial(size) * math.factorial(5 - size) / 720 * (value({*known, j}, x[0]) - value(set(known), x[0]))
        assert got[0, j] == pytest.approx(want, abs=1e-9)
    rows = tree_shapley.tree_shapley(model, labelled, "k").groupBy("k").agg(F.sum("shapley").alias("s"), F.first("base").alias("b"), F.first("margin").alias("m"))
    raw = {r.k: (r.rawPrediction[1] if family == "gradient_boosting" else r.probability[1]) for r in scored.select("k", "rawPrediction", "probability").collect()}
    for r in rows.collect():
        assert r.s + r.b == pytest.approx(r.m, abs=1e-9) and r.m == pytest.approx(raw[r.k], abs=1e-9)


def test_trees_with_categories(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    rows = [(i, "abcde"[i % 5], float(i % 7), int(i % 5 in (0, 3) or i % 7 > 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, c string, v double, y int")
    model = Pipeline(stages=[
        StringIndexer(inputCol="c", outputCol="ci"), VectorAssembler(inputCols=["ci", "v"], outputCol="features"),
        RandomForestClassifier(labelCol="y", numTrees=4, maxDepth=4, seed=1),
    ]).fit(df)
    assert any(leaf.categories for leaf in tree_shapley.leaves(model.stages[-1]))
    wide = tree_shapley.tree_shapley(model, df, "k").groupBy("k").agg((F.sum("shapley") + F.first("base")).alias("s"))
    want = {r.k: r.probability[1] for r in model.transform(df).select("k", "probability").collect()}
    assert all(r.s == pytest.approx(want[r.k], abs=1e-9) for r in wide.collect())


def test_no_trees_no_attributions(labelled):
    model = Pipeline(stages=[*train.standard_head(NAMES), train.classifier("logistic_regression", {}, "y", "features", 700.0)]).fit(train.add_class_weight(labelled, "y"))
    with pytest.raises(ValueError):
        tree_shapley.leaves(model.stages[-1])


def test_stacked_model_is_saved_like_any_other(spark, labelled):
    model = train.train_stacking(labelled, "y", "k", train.standard_head(NAMES), {"rf_n_estimators": 4, "rf_max_depth": 4, "gb_n_estimators": 3}, folds=2)
    importance = train.feature_importance(model, model.head.transform(labelled))
    search = spark.createDataFrame([('{"a": [1, "x"]}', 0.5), ("b,c", 0.25)], "settings string, cv_score double")
    path = runs.save_model(model, scratch_path(spark, "models"), "stacking", {"auc": 0.5}, importance, search)
    want = [r.risk_score for r in train.predictions(model, labelled).orderBy("k").collect()]
    assert [r.risk_score for r in train.predictions(runs.load_model(path, train.Stacked), labelled).orderBy("k").collect()] == want
    inside = scratch_path(spark, "inside")
    PipelineModel([model]).write().save(inside)
    assert [r.risk_score for r in train.predictions(PipelineModel.load(inside), labelled).orderBy("k").collect()] == want
    saved = runs.load_results(spark, path)
    assert sorted(map(tuple, saved["cv_results"].collect())) == sorted(map(tuple, search.collect()))
    assert sorted(map(tuple, saved["feature_importances"].collect())) == sorted(map(tuple, importance.collect()))
    assert saved["metadata"].first()["metrics"] == {"auc": 0.5}
    bare = runs.load_results(spark, runs.save_model(model, scratch_path(spark, "models"), "stacking", {}))
    assert set(bare) == {"metadata"}


def test_saved_union_in_batch_and_stream(spark, transactions):
    plain = transactions.drop("FraudResult")
    union = FeatureUnion.fit(plain, ["Value"], ["ProductCategory", "ChannelId"])
    rows = union.transform(plain, keep=["TransactionId"]).join(transactions.select("TransactionId", (F.col("Amount") > 5000).cast("int").alias("y")), "TransactionId")
    model = train.search_model(rows, "logistic_regression", "y", "TransactionId", train.standard_head(union.names), settings=[{}], folds=1).model
    path = artifacts.FittedPipeline(union, model, ["TransactionId"]).save(scratch_path(spark, "pipeline"))
    again = artifacts.FittedPipeline.load(spark.newSession(), path)
    assert again.union.names == union.names
    want = {r.TransactionId: r.risk_score for r in train.predictions(artifacts.FittedPipeline(union, model, ["TransactionId"]), plain).collect()}
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    plain.write.parquet(arriving)
    fitted = artifacts.FittedPipeline.load(spark, path)
    stream = train.predictions(fitted, spark.readStream.schema(plain.schema).parquet(arriving)).select("TransactionId", "risk_score")
    query = stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "marks")).trigger(availableNow=True).start(out)
    assert query.awaitTermination(300) and {r.TransactionId: r.risk_score for r in spark.read.parquet(out).collect()} == want
    assert isinstance(fitted.union.rare, RareCategories)


def test_manifest_of_another_kind_or_version(spark, monkeypatch):
    path = scratch_path(spark, "manifest")
    artifacts.write_manifest(spark, path, "pipeline", {"x": 1})
    assert artifacts.read_manifest(spark, path, "pipeline")["x"] == 1
    with pytest.raises(ValueError):
        artifacts.read_manifest(spark, path, "feature union")
    monkeypatch.setattr(artifacts, "VERSION", 0)
    with pytest.raises(ValueError):
        artifacts.read_manifest(spark, path, "pipeline")
