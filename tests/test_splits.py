import pytest
from pyspark.sql import functions as F

from tallygrain.operators import split


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1003).select(
        "id", (F.col("id") % 9 == 0).cast("int").alias("y"), (F.col("id") % 50).alias("customer"),
        F.timestamp_seconds(F.floor(F.col("id") / 7)).alias("t"), (F.col("id") % 50 < 10).cast("int").alias("cy"),
    )


def test_quotas_use_largest_remainders():
    assert split.train_quotas([90, 10], 0.2) == [72, 8]
    assert split.train_quotas([7, 3], 0.25) == [5, 2]
    assert sum(split.train_quotas([5, 5, 1], 0.3)) == 11 - 4


@pytest.mark.parametrize("tuning", [{}, {"accuracy": 100, "limit": 50}])
def test_stratified_split_is_exact_and_disjoint(rows, tuning):
    train, test = split.stratified_split(rows, "id", "y", 0.2, **tuning)
    assert (train.count(), test.count()) == (802, 201)
    assert train.join(test, "id").count() == 0
    quota = split.train_quotas([rows.where("y = 0").count(), rows.where("y = 1").count()], 0.2)
    assert [train.where(f"y = {c}").count() for c in (0, 1)] == quota
    again, _ = split.stratified_split(rows.repartition(5), "id", "y", 0.2)
    assert again.exceptAll(train).count() == 0
    other, _ = split.stratified_split(rows, "id", "y", 0.2, seed=1)
    assert other.exceptAll(train).count() > 0


def test_grouped_split_keeps_customers_together(rows):
    train, test = split.grouped_split(rows, "customer", "cy")
    assert train.select("customer").intersect(test.select("customer")).count() == 0
    assert train.count() + test.count() == 1003
    assert test.select("customer").distinct().count() == 10 and test.where("cy = 1").select("customer").distinct().count() == 2
    with pytest.raises(ValueError, match="more than one label"):
        split.grouped_split(rows, "customer", "y")


def test_temporal_split_cuts_inside_equal_times(rows):
    train, test = split.temporal_split(rows, "t", "id")
    assert train.count() == 802 and train.agg(F.max("id")).first()[0] == 801 and test.agg(F.min("id")).first()[0] == 802


def test_folds_have_the_sizes_of_dealt_labels(rows):
    folds = split.stratified_folds(rows, "id", "y", 5)
    got = {(r["y"], r["fold"]): r["n"] for r in folds.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
    sizes = split.fold_sizes([rows.where("y = 0").count(), rows.where("y = 1").count()], 5)
    assert got == {(c, f): sizes[c][f] for c in (0, 1) for f in range(5)}


def test_time_series_folds_expand(rows):
    folds = split.time_series_folds(rows, "t", "id", 4)
    assert [te.count() for _, te in folds] == [200] * 4
    assert [tr.count() for tr, _ in folds] == [203, 403, 603, 803]
    assert all(tr.agg(F.max("id")).first()[0] < te.agg(F.min("id")).first()[0] for tr, te in folds)


def test_sample_has_the_wanted_size(rows):
    assert split.sample_rows(rows, "id", 100).count() == 100
    assert split.sample_rows(rows, "id", 5000).count() == 1003
