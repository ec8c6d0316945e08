import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallygrain.operators import encode, eda, target, woe
from tallygrain.session import scratch_path


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, float(i % 20), 7.0, "abc"[i % 3], int(i % 20 > 12)) for i in range(400)] + [(400, None, 7.0, None, 0)]
    return spark.createDataFrame(rows, "id int, x double, same double, c string, y int")


def test_scalers_leave_constants_finite(mixed):
    for method, want in (("standard", 0.0), ("minmax", 0.0), ("robust", 0.0), ("scale_only", 7.0)):
        out = encode.Scale.using(columns=["same"], method=method).fit(mixed).transform(mixed)
        assert {r["same"] for r in out.select("same").collect()} == {want}
    z = encode.Scale.using(columns=["x"]).fit(mixed).transform(mixed)
    assert math.isclose(z.agg(F.stddev_pop("x")).first()[0], 1.0)


def test_constant_columns_are_dropped(mixed):
    assert encode.DropConstant.using(columns=["x", "same"]).fit(mixed).transform(mixed).columns == ["id", "x", "c", "y"]


def test_median_interpolates_and_empty_columns_go(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None), (None, None)], "a double, b double")
    out = encode.Fill.using(columns=["a", "b"], strategy="median").fit(df).transform(df)
    assert out.columns == ["a"] and sorted(r["a"] for r in out.collect()) == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_unknown_category_is_all_zeros(spark, mixed):
    model = encode.preprocessing(["x"], ["c"]).fit(mixed)
    out = model.transform(spark.createDataFrame([(1, 1.0, 7.0, "zzz", 0), (2, 1.0, 7.0, None, 0)], mixed.schema))
    assert encode.feature_names(out) == ["x", "c_a", "c_b", "c_c", "c_missing"]
    rows = [list(r["features"].toArray())[1:] for r in out.orderBy("id").collect()]
    assert rows == [[0, 0, 0, 0], [0, 0, 0, 1]]


def test_rare_and_unknown_categories_differ(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 38 + [("r1",), ("r2",)], "c string")
    rare = encode.RareCategories.fit(df, ["c"], 0.05)
    got = rare.transform(spark.createDataFrame([("a",), ("r1",), ("new",), (None,)], "c string"))
    assert sorted(str(r["c"]) for r in got.collect()) == ["None", "None", "__infrequent", "a"]


def test_evidence_weights(spark, mixed):
    model = woe.WeightOfEvidence.using(label="y", columns=["x", "same"], bins=4).fit(mixed)
    bins = model.configuration()["bins"]
    assert list(bins) == ["x"]
    good, bad = sum(bins["x"]["good"]), 401 - sum(bins["x"]["good"])
    g, b = bins["x"]["good"][0], bins["x"]["bad"][0]
    assert math.isclose(bins["x"]["woe"][0], math.log(((g + 0.5) / (good + 1)) / ((b + 0.5) / (bad + 1))))
    out = model.transform(spark.createDataFrame([(1, -100.0, 7.0, "a", 0), (2, 100.0, 7.0, "a", 0), (3, None, 7.0, "a", 0)], mixed.schema))
    got = [r["x"] for r in out.orderBy("id").collect()]
    assert got == [bins["x"]["woe"][0], bins["x"]["woe"][-1], bins["x"]["mean"]]
    flipped = woe.WeightOfEvidence.using(label="y", columns=["x"], bins=4).fit(mixed.withColumn("y", 1 - F.col("y")))
    assert all(math.isclose(a, -b) for a, b in zip(bins["x"]["woe"], flipped.configuration()["bins"]["x"]["woe"]))


def test_fitted_stages_survive_saving(spark, mixed):
    stages = [encode.Fill.using(columns=["x"], strategy="median"), encode.Scale.using(columns=["x"]), woe.WeightOfEvidence.using(label="y", columns=["x"])]
    model = Pipeline(stages=stages).fit(mixed)
    path = scratch_path(spark, "saved")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert model.transform(mixed).exceptAll(again.transform(mixed)).count() == 0


def test_high_risk_cluster_polarity(spark):
    means = spark.createDataFrame([(0, 5.0, 10.0, 100.0), (1, 90.0, 1.0, 5.0), (2, 40.0, 4.0, 30.0)], "cluster int, Recency double, Frequency double, Monetary double")
    assert target.high_risk_cluster(means) == 1
    assert target.high_risk_cluster(means, polarity=target.AS_CODED) == 0
    assert target.average_rank([3.0, 1.0, 3.0]) == [2.5, 1.0, 2.5]


def test_nearest_centroid_and_risk_ranker(spark):
    rows = [(i, float(r), float(f), float(m), float(s)) for i, (r, f, m, s) in enumerate([(1, 9, 90, 5), (2, 8, 80, 4.5), (50, 5, 40, 3), (99, 1, 2, 1), (95, 1, 5, 1.2)])]
    df = spark.createDataFrame(rows, "CustomerId int, recency double, frequency double, monetary double, rfm_score double")
    ranker = target.RiskRanker.fit(df, k=3, restarts=4)
    out = ranker.transform(df).orderBy("CustomerId").collect()
    assert [r["risk_rank"] for r in out] == [2, 2, 1, 0, 0]
    path = scratch_path(spark, "ranker")
    ranker.save(spark, path)
    assert target.RiskRanker.load(spark, path).transform(df).orderBy("CustomerId").collect() == out
    labels = target.threshold_label(ranker.transform(df), share=0.2).orderBy("CustomerId").collect()
    assert [r["is_high_risk"] for r in labels] == [0, 0, 0, 1, 1]


def test_negative_metrics_fail_before_clustering(spark):
    df = spark.createDataFrame([(-1.0,)], "Monetary double")
    with pytest.raises(Exception, match="negative Monetary"):
        target.log_features(df, ["Monetary"]).collect()


def test_profile_tables(spark, mixed):
    described = {r["column"]: r for r in eda.describe(mixed).collect()}
    assert described["x"]["count"] == 400 and described["x"]["p50"] == 9.5
    assert described["c"]["unique"] == 3 and described["c"]["top"] == "a" and described["c"]["freq"] == 134
    assert sum(r["n"] for r in eda.histogram(mixed, ["x"]).collect()) == 400
    assert [(r["column"], r["missing"]) for r in eda.missing_values(mixed).collect()] == [("c", 1), ("x", 1)]
    box = eda.box_statistics(mixed, ["x"]).first()
    assert box["median"] == 9.5 and box["outliers"] == 0
    assert {(r["a"], r["b"]) for r in eda.correlation(mixed, ["x", "y"]).collect()} == {("x", "x"), ("x", "y"), ("y", "x"), ("y", "y")}
