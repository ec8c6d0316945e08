import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.operators.binning import DuplicateEdges, Score, fit_scores
from tallygrain.operators import order_stats
from tallygrain.operators.split import stratified_folds
from tallygrain.operators.order_stats import cut_points, cuts_passed, exact_quantiles, rank_target

PROBS = [0.0, 0.01, 0.2, 0.5, 0.6, 0.8, 0.99, 1.0]
TUNINGS = [{}, {"accuracy": 100}, {"accuracy": 100, "limit": 300}, {"accuracy": 100, "limit": 10}]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of column b is one value; a has many ties; c has gaps."""
    df = spark.range(20_000).select(
        "id",
        F.round(F.rand(1) * 100, 1).alias("a"),
        F.when(F.rand(2) < 0.33, 5.0).otherwise(F.randn(3)).alias("b"),
        F.when(F.rand(4) < 0.2, None).when(F.rand(5) < 0.1, float("nan")).otherwise(F.randn(6)).alias("c"),
        F.concat(F.lit("C_"), (F.col("id") * 7919 % 20011).cast("string")).alias("name"),
    )
    return df.persist()


@pytest.mark.parametrize("tuning", TUNINGS)
def test_quantiles_match_numpy(skewed, tuning):
    local = skewed.toPandas()
    found = exact_quantiles(skewed, {c: PROBS for c in "abc"}, **tuning)
    for c in "abc":
        assert np.allclose(found[c], np.quantile(local[c].dropna(), PROBS), rtol=1e-15, atol=1e-12)


def test_quantiles_of_infinities_zeros_and_nothing(spark):
    df = spark.createDataFrame([(x, None) for x in (-math.inf, -0.0, 0.0, 1.0, math.inf)], "a double, b double")
    for tuning in ({}, {"accuracy": 100}):
        assert exact_quantiles(df, {"a": [0.25, 0.5, 0.75], "b": [0.5]}, **tuning) == {"a": [0.0, 0.0, 1.0], "b": [None]}


@pytest.mark.parametrize("tuning", [{}, {"accuracy": 100}, {"accuracy": 100, "limit": 200}])
def test_cuts_in_tied_text_order(skewed, tuning):
    """Ranks inside the large tied group come from one sort, as text cannot be sketched."""
    local = skewed.toPandas().sort_values(["b", "name"]).reset_index(drop=True)
    ranks = [1, 4000, 15000, 17000, 19999, 20000]
    targets = {0: [rank_target(r / 20000, lambda n, r=r: r) for r in ranks]}
    _, cuts = cut_points(skewed, F.col("b"), F.col("name"), targets, **tuning)
    passed = skewed.select("name", cuts_passed(cuts[0], F.col("b"), F.col("name")).alias("k")).toPandas()
    want = dict(zip(local["name"], [sum(i + 1 > r for r in ranks) for i in range(20000)]))
    assert all(want[n] == k for n, k in zip(passed["name"], passed["k"]))


def scores_of(spark, values, by, on_duplicate="error"):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "k int, v double")
    got = []
    for options in ({}, {"accuracy": 100}, {"accuracy": 100, "limit": 2}):
        expr = fit_scores(df, "k", [Score("v", "s", by)], on_duplicate=on_duplicate, **options)["s"]
        got.append([r["s"] for r in df.withColumn("s", expr).orderBy("k").collect()])
    assert got[0] == got[1] == got[2]
    return got[0]


def test_rank_scores_follow_first_occurrence(spark):
    assert scores_of(spark, range(7), "rank") == [1, 1, 2, 3, 4, 5, 5]
    assert scores_of(spark, [3, 3, 3, 3], "rank") == [1, 2, 4, 5]


def test_equal_values_share_a_score(spark):
    assert scores_of(spark, range(1, 11), "value") == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_repeated_edges_raise_or_merge(spark):
    values = [1, 2, 2, 2, 5, 7, 9]
    with pytest.raises(DuplicateEdges):
        scores_of(spark, values, "value")
    assert scores_of(spark, values, "value", "merge") == [1, 1, 1, 1, 3, 4, 4]


def test_scores_agree_on_skew_whatever_the_tuning(spark, skewed):
    scores = [Score("a", "by_value", "value", descending=True), Score("b", "by_rank", "rank")]
    small = skewed.withColumns(fit_scores(skewed, "name", scores))
    large = skewed.withColumns(fit_scores(skewed, "name", scores, accuracy=100, limit=500))
    columns = ["id", "by_value", "by_rank"]
    assert small.select(columns).exceptAll(large.select(columns)).count() == 0
    sizes = [r["n"] for r in small.groupBy("by_rank").agg(F.count("*").alias("n")).collect()]
    assert sizes == [4000] * 5


def test_a_value_on_a_decile_edge_is_scored_as_by_numpy(spark):
    """Interpolation that rounds otherwise puts 9607.78 above its own edge."""
    values = [*map(float, range(62)), 9560.39, 9607.78, *map(float, range(20_000, 20_027))]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v double")
    edges = [float(e) for e in np.quantile(values, [i / 10 for i in range(11)])]
    for tuning in ({}, {"accuracy": 50}, {"accuracy": 50, "limit": 5}):
        assert exact_quantiles(df, {"v": [i / 10 for i in range(11)]}, **tuning)["v"] == edges
        score = fit_scores(df, "k", [Score("v", "s")], 10, **tuning)["s"]
        got = {r["v"]: r["s"] for r in df.select("v", score.alias("s")).collect()}
        assert got == {v: 1 + sum(v > e for e in edges[1:-1]) for v in values}


def test_ranks_that_the_sketch_misses_are_found(spark, monkeypatch):
    """A sketch that is wrong altogether costs rounds, not exactness."""
    df = spark.range(5000).select((F.col("id") * 7 % 5000).cast("double").alias("v"))
    real = order_stats._sketch

    def wrong(source, targets, accuracy):
        totals, ranges = real(source, targets, accuracy)
        return totals, {s: [(10.0, 11.0)] for s in ranges}

    monkeypatch.setattr(order_stats, "_sketch", wrong)
    for tuning in ({}, {"accuracy": 100, "limit": 50}):
        assert exact_quantiles(df, {"v": [0.1, 0.5, 0.9]}, **tuning)["v"] == [float(np.quantile(range(5000), p)) for p in (0.1, 0.5, 0.9)]


def test_text_ties_of_all_classes_are_sorted_once(spark, monkeypatch):
    written = []
    real = order_stats.materialize
    monkeypatch.setattr(order_stats, "materialize", lambda df, label, *a: written.append(label) or real(df, label, *a))
    df = spark.range(3000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    folds = stratified_folds(df, "k", "y", 5, seed=None).groupBy("y", "fold").count().collect()
    assert written == ["sorted-ties"]
    assert sorted(r["count"] for r in folds) == [200] * 5 + [400] * 5
