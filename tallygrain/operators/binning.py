"""Quantile scores: by value (equal values share a score) and by first rank."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.operators.order_stats import (
    Columns,
    cuts_from,
    cuts_passed,
    interpolate,
    pick_ranks,
    quantile_target,
    rank_target,
)


class DuplicateEdges(ValueError):
    """Two quantile edges coincide, so fixed labels cannot be assigned."""


@dataclass(frozen=True)
class Score:
    """How one column is scored 1..q."""

    column: str
    output: str
    by: str = "value"  # 'value' or 'rank'
    descending: bool = False


def bin_by_edges(column: Column, inner_edges: list[float]) -> Column:
    """Right-closed bin number from 0: how many inner edges lie below the value."""
    total = F.lit(0)
    for edge in inner_edges:
        total = total + (column > F.lit(edge)).cast("int")
    return total


def check_edges(edges: list[float], name: str, on_duplicate: str = "error") -> list[float]:
    """Edges with repeats either raise or are merged."""
    unique = sorted(set(edges))
    if len(unique) < len(edges) and on_duplicate == "error":
        raise DuplicateEdges(f"quantile edges of {name} are not unique: {edges}")
    return unique


def _rank_target(k: int, q: int):
    # Rank r scores above k exactly when r > 1 + (n-1)·k/q.
    return rank_target(k / q, lambda n: math.floor((n - 1) * k / q) + 1)


def fit_scores(
    df: DataFrame,
    key: str,
    scores: list[Score],
    q: int = 5,
    *,
    on_duplicate: str = "error",
    **tuning,
) -> dict[str, Column]:
    """Score expressions 1..q for several columns of a one-row-per-key table.

    Rank scores break ties by ``key``, ascending.
    """
    probabilities = [k / q for k in range(q + 1)]
    edges, rank_bins = _fit(df, key, scores, q, probabilities, tuning)
    out: dict[str, Column] = {}
    for s in scores:
        value = F.col(s.column).cast("double")
        if s.by == "rank":
            bin_number = rank_bins[s.column]
        else:
            bin_number = bin_by_edges(value, check_edges(edges[s.column], s.column, on_duplicate)[1:-1])
        number = (F.lit(q) - bin_number) if s.descending else (bin_number + 1)
        out[s.output] = F.when(value.isNotNull(), number.cast("int"))
    return out


def _fit(df, key, scores, q, probabilities, tuning) -> tuple[dict, dict]:
    """All positions located together, ranks cut by literals."""
    columns = [s.column for s in scores]
    targets = {
        i: [quantile_target(p) for p in probabilities]
        if s.by == "value"
        else [_rank_target(k, q) for k in range(1, q)]
        for i, s in enumerate(scores)
    }
    counts, found = pick_ranks(Columns(df, columns), targets, **tuning)
    edges = {
        s.column: [interpolate(found, i, counts[i], p) for p in probabilities]
        for i, s in enumerate(scores)
        if s.by == "value"
    }
    ranked = [i for i, s in enumerate(scores) if s.by == "rank"]
    if not ranked:
        return edges, {}
    base = None
    for i in ranked:
        part = df.select(
            F.lit(i).alias("series"), F.col(columns[i]).cast("double").alias("v"), F.col(key).alias("t")
        )
        base = part if base is None else base.unionAll(part)
    cuts = cuts_from(base, {i: targets[i] for i in ranked}, counts, found, **tuning)
    return edges, {columns[i]: cuts_passed(cuts[i], F.col(columns[i]).cast("double"), F.col(key)) for i in ranked}
