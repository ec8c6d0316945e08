"""Exact splits, folds and samples that are filters on literals.

A split is the position of a row in a fixed order (a seeded hash of its key, or
time). Only the cut positions are computed; assigning rows is then a map.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrain.functions.timefeat import micros
from tallygrain.operators.order_stats import cut_points, cuts_passed, rank_target


def hash_order(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def class_counts(df: DataFrame, label: str | None) -> list[tuple[object, int]]:
    """Classes in sorted order with their row counts."""
    if label is None:
        return [(None, df.count())]
    rows = df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label).collect()
    if any(r[label] is None for r in rows):
        raise ValueError(f"column {label} has missing values")
    return [(r[label], r["n"]) for r in rows]


def class_series(label: str | None, classes: list[tuple[object, int]]) -> Column:
    if label is None:
        return F.lit(0)
    series = F.lit(None).cast("int")
    for i, (value, _) in enumerate(classes):
        series = F.when(F.col(label) == F.lit(value), F.lit(i)).otherwise(series)
    return series


def train_quotas(counts: list[int], test_size: float) -> list[int]:
    """Training rows per class: largest remainders, earlier classes first on ties."""
    n = sum(counts)
    train = n - math.ceil(test_size * n)
    if n == 0:
        return [0 for _ in counts]
    ideal = [c * train / n for c in counts]
    quota = [math.floor(x) for x in ideal]
    order = sorted(range(len(counts)), key=lambda i: (quota[i] - ideal[i], i))
    for i in order[: train - sum(quota)]:
        quota[i] += 1
    return quota


def stratified_membership(
    df: DataFrame, key: str, label: str | None = None, test_size: float = 0.2, seed: int = 42, **tuning
) -> Column:
    """True for training rows. Sizes are exact in total and per class."""
    classes = class_counts(df, label)
    counts = [n for _, n in classes]
    quota = train_quotas(counts, test_size)
    series = class_series(label, classes)
    order, tie = hash_order(key, seed), F.col(key)
    targets = {i: [rank_target(q / max(n, 1), lambda _, q=q: q)] for i, (q, n) in enumerate(zip(quota, counts))}
    _, cuts = cut_points(df, order, tie, targets, series=series, **tuning)
    train = F.lit(False)
    for i in range(len(counts)):
        train = F.when(series == i, cuts_passed(cuts[i], order, tie) == 0).otherwise(train)
    return train


def stratified_split(
    df: DataFrame, key: str, label: str | None = None, test_size: float = 0.2, seed: int = 42, **tuning
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; ``key`` must identify a row."""
    train = stratified_membership(df, key, label, test_size, seed, **tuning)
    return df.where(train), df.where(~train)


def customer_targets(df: DataFrame, customer: str, label: str) -> DataFrame:
    """Distinct (customer, label) pairs."""
    return df.select(customer, label).distinct()


def grouped_split(
    df: DataFrame, customer: str, label: str, test_size: float = 0.2, seed: int = 42, **tuning
) -> tuple[DataFrame, DataFrame]:
    """Split customers, stratified by their label; a customer is in one side only.

    Membership depends on the customer's hash and label alone, so rows are
    filtered directly instead of being joined with the chosen customers.
    """
    pairs = customer_targets(df, customer, label)
    mixed = pairs.groupBy(customer).agg(F.count("*").alias("n")).where(F.col("n") > 1).limit(1).count()
    if mixed:
        raise ValueError("a customer has more than one label")
    train = stratified_membership(pairs, customer, label, test_size, seed, **tuning)
    return df.where(train), df.where(~train)


def temporal_membership(df: DataFrame, time: str, key: str, share: float = 0.8, **tuning) -> Column:
    """True for the first ``int(share·n)`` rows in (time, key) order."""
    order, tie = micros(F.col(time)), F.col(key)
    _, cuts = cut_points(df, order, tie, {0: [rank_target(share, lambda n: int(share * n))]}, **tuning)
    return cuts_passed(cuts[0], order, tie) == 0


def temporal_split(
    df: DataFrame, time: str, key: str, share: float = 0.8, **tuning
) -> tuple[DataFrame, DataFrame]:
    train = temporal_membership(df, time, key, share, **tuning)
    return df.where(train), df.where(~train)


def fold_sizes(counts: list[int], k: int) -> list[list[int]]:
    """Rows per class and fold when the sorted labels are dealt out in turn."""
    sizes, start = [], 0
    for n in counts:
        sizes.append([max(0, (n - (i - start) % k + k - 1) // k) for i in range(k)])
        start += n
    return sizes


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int = 5, seed: int | None = 42, column: str = "fold", **tuning
) -> DataFrame:
    """Fold number 0..k-1 per row; with ``seed`` None the key's own order is used."""
    classes = class_counts(df, label)
    counts = [n for _, n in classes]
    sizes = fold_sizes(counts, k)
    series = class_series(label, classes)
    tie = F.col(key)
    if seed is not None:
        order = hash_order(key, seed)
    else:  # text keys are ordered by the tie column alone
        order = F.col(key) if isinstance(df.schema[key].dataType, T.NumericType) else F.lit(0)
    targets = {}
    for c, per_fold in enumerate(sizes):
        ends = [sum(per_fold[: i + 1]) for i in range(k - 1)]
        targets[c] = [rank_target(e / max(counts[c], 1), lambda _, e=e: e) for e in ends]
    _, cuts = cut_points(df, order, tie, targets, series=series, **tuning)
    fold = F.lit(None).cast("int")
    for c in range(len(counts)):
        fold = F.when(series == c, cuts_passed(cuts[c], order, tie)).otherwise(fold)
    return df.withColumn(column, fold)


def time_series_blocks(df: DataFrame, time: str, key: str, k: int = 5, column: str = "block", **tuning) -> DataFrame:
    """Block 0 is the first training window, blocks 1..k are the successive tests.

    Fold i trains on blocks below i and tests on block i. The last k blocks have
    n // (k + 1) rows each; the first block takes the remainder.
    """
    order, tie = micros(F.col(time)), F.col(key)

    def end(i: int):
        return lambda n: n - (k - i) * (n // (k + 1))

    targets = [rank_target((i + 1) / (k + 1), end(i)) for i in range(k)]
    _, cuts = cut_points(df, order, tie, {0: targets}, **tuning)
    return df.withColumn(column, cuts_passed(cuts[0], order, tie))


def time_series_folds(df: DataFrame, time: str, key: str, k: int = 5, **tuning) -> list[tuple[DataFrame, DataFrame]]:
    blocks = time_series_blocks(df, time, key, k, "_block", **tuning)
    return [
        (blocks.where(F.col("_block") < i).drop("_block"), blocks.where(F.col("_block") == i).drop("_block"))
        for i in range(1, k + 1)
    ]


def time_series_plan(df: DataFrame, time: str, key: str, k: int = 5, gap: int = 0, **tuning) -> DataFrame:
    """Adds fold (the block of ``time_series_blocks``) and usable, the first fold that may train on the row.

    Fold i (1 to k) is tested on block i and trains on all rows up to ``gap`` rows before it. The training
    parts grow, so one number says all: a row is in the training part of the folds from ``usable`` on.
    All cuts come from one search for order statistics; a row's numbers are comparisons with literals.
    """
    if gap < 0:
        raise ValueError("gap must not be negative")
    order, tie = micros(F.col(time)), F.col(key)

    def end(i: int, less: int):
        return lambda n: max(0, n - (k - i) * (n // (k + 1)) - less)

    plain = [rank_target((i + 1) / (k + 1), end(i, 0)) for i in range(k)]
    if not gap:
        _, cuts = cut_points(df, order, tie, {0: plain}, **tuning)
        passed = cuts_passed(cuts[0], order, tie)
        return df.withColumns({"fold": passed, "usable": passed + 1})
    early = [rank_target((i + 1) / (k + 1), end(i, gap)) for i in range(k)]
    _, cuts = cut_points(df, order, tie, {0: [*plain, *early]}, **tuning)
    return df.withColumns({"fold": cuts_passed(cuts[0][:k], order, tie), "usable": cuts_passed(cuts[0][k:], order, tie) + 1})


def fold_parts(folded: DataFrame, fold: int) -> tuple[Column, Column]:
    """(training rows, test rows) of a fold of ``stratified_folds`` or, if there is a column usable, ``time_series_plan``."""
    test = F.col("fold") == fold
    return (F.col("usable") <= fold if "usable" in folded.columns else ~test), test


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42, **tuning) -> DataFrame:
    """A repeatable sample of exactly n rows (all rows when there are fewer)."""
    total = df.count()
    if n >= total:
        return df
    order, tie = hash_order(key, seed), F.col(key)
    _, cuts = cut_points(df, order, tie, {0: [rank_target(n / total, lambda _: n)]}, **tuning)
    return df.where(cuts_passed(cuts[0], order, tie) == 0)
