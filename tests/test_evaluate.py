import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.operators import evaluate


def brute(y, s):
    y, s = np.array(y), np.array(s)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    points = sorted(set(s), reverse=True)
    tpr = [(pos >= t).mean() for t in points]
    fpr = [(neg >= t).mean() for t in points]
    prec = [y[s >= t].mean() for t in points]
    ap = sum((r - q) * p for r, q, p in zip(tpr, [0] + tpr[:-1], prec))
    f1 = [2 * p * r / (p + r + 1e-10) for p, r in zip(prec, tpr)]
    best = max(f1)
    return auc, ap, max(0, max(a - b for a, b in zip(tpr, fpr))), min(t for t, f in zip(points, f1) if f == best), best


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(3000) < 0.3).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 3)
    rows = [(int(a), float(b), int(b >= 0.5)) for a, b in zip(y, s)]
    return spark.createDataFrame(rows, "y int, s double, p int"), y, s


@pytest.mark.parametrize("range_rows", [1_000_000, 37, 1])
def test_ranking_metrics_match_brute_force(scored, range_rows):
    df, y, s = scored
    row = evaluate.ranking_metrics(evaluate.score_table(df, "y", "s"), range_rows=range_rows).first()
    assert np.allclose(list(row), brute(y, s)), (list(row), brute(y, s))


def test_auc_mirrors_when_scores_are_negated(scored):
    df, _, _ = scored
    auc = evaluate.ranking_metrics(evaluate.score_table(df, "y", "s")).first()["roc_auc"]
    mirrored = evaluate.ranking_metrics(evaluate.score_table(df.withColumn("s", -F.col("s")), "y", "s")).first()["roc_auc"]
    assert math.isclose(auc, 1 - mirrored)


def test_class_metrics(scored):
    df, y, s = scored
    m = evaluate.evaluate(df, "y", "p", "s")
    p = s >= 0.5
    tp, fp, fn, tn = (y & p).sum(), ((1 - y) & p).sum(), (y & ~p).sum(), ((1 - y) & ~p).sum()
    assert (m["true_positives"], m["false_positives"], m["false_negatives"], m["true_negatives"]) == (tp, fp, fn, tn)
    assert m["cost_of_errors"] == 10 * fn + 2 * fp and m["n_samples"] == 3000
    assert math.isclose(m["f2"], 5 * tp / (5 * tp + 4 * fn + fp)) and math.isclose(m["class_ratio"], y.mean())
    clipped = np.clip(s, 2.220446049250313e-16, 1 - 2.220446049250313e-16)
    assert math.isclose(m["log_loss"], -(y * np.log(clipped) + (1 - y) * np.log(1 - clipped)).mean())


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    m = evaluate.class_metrics(evaluate.confusion(df, "y", "p")).first()
    assert m["precision"] == m["recall"] == m["f1"] == 0.0 and m["accuracy"] == 1.0
