"""Exact order statistics and quantiles without a global sort.

Spark's ``percentile`` keeps every distinct value of a column in one reducer
and ``row_number`` without a partition pulls all rows into one task. Here the
wanted ranks are located in two scans instead:

1. an approximate percentile sketch gives a narrow value range around each rank;
2. one aggregation counts what lies below, between and inside those ranges, and
   keeps individual values only inside them.

The counts are exact, so the answer is exact whatever the sketch error was: where it missed
a rank, the counts tell in which gap the rank lies, and that gap is searched. A value that a
third of all rows share becomes one counted row on the map side. Tables of all sizes go the
same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallygrain.session import materialize

ACCURACY = 10_000  # sketch accuracy: rank error of about n / ACCURACY
LIMIT = 2_000_000  # candidate rows per wanted rank before another narrowing round


@dataclass(frozen=True)
class Target:
    """A wanted position: its approximate fraction and its exact 1-based ranks."""

    fraction: float
    ranks: Callable[[int], list[int]]


@dataclass(frozen=True)
class Found:
    value: object
    before: int  # rows with a smaller value
    count: int  # rows with exactly this value


def quantile_target(p: float) -> Target:
    def ranks(n: int) -> list[int]:
        low = math.floor((n - 1) * p) + 1
        return [low, min(low + 1, n)]

    return Target(p, ranks)


def rank_target(fraction: float, rank: Callable[[int], int]) -> Target:
    return Target(fraction, lambda n: [rank(n)])


CHUNK = 8  # columns per scan branch, so that the generated code stays compilable


def value_boundaries(column: str, boundaries: list[float], output: str) -> Bucketizer:
    """Counts how many boundaries a value reaches: a binary search per row."""
    return Bucketizer(splits=[-math.inf, *boundaries, math.inf], inputCol=column, outputCol=output, handleInvalid="keep")


def just_above(value: float) -> float:
    return math.nextafter(value, math.inf)


_SUMMARY = ("n", "low", "high", "at")


def _summary(value: Column, points: list[float], accuracy: int) -> dict[str, Column]:
    parts = (F.count(value), F.min(value), F.max(value), F.percentile_approx(value, points, accuracy))
    return dict(zip(_SUMMARY, parts))


def compared(value: Column, spans: list[tuple] | None) -> Column:
    """Odd slots lie inside a range, even slots in the gaps; None means all inside."""
    if spans is None:
        return F.lit(1)
    slot = F.lit(0)
    for low, high in spans:
        slot = slot + (value >= F.lit(low)).cast("int") + (value > F.lit(high)).cast("int")
    return slot


class Columns:
    """Several numeric columns of one table, each a series numbered by position."""

    def __init__(self, df: DataFrame, columns: list[str]):
        # Adding 0.0 turns a negative zero into zero, as comparisons treat them alike.
        self.df = df.select(*[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(columns)])
        self.size = len(columns)

    def _stack(self, picks: dict[int, list[Column]], df_of) -> DataFrame:
        """Long form in branches of a few columns; every branch reads only its own."""
        out = None
        keys = list(picks)
        for start in range(0, len(keys), CHUNK):
            chunk = keys[start : start + CHUNK]
            entries = F.array(*[F.struct(F.lit(i).alias("series"), *picks[i]) for i in chunk])
            part = df_of(chunk).select(F.explode(entries).alias("p")).select("p.*")
            out = part if out is None else out.unionAll(part)
        return out

    def long(self) -> DataFrame:
        return self._stack({i: [F.col(f"c{i}").alias("v")] for i in range(self.size)}, lambda _: self.df)

    def summary(self, points: list[float], accuracy: int) -> list[dict]:
        """Count, ends and sketch of every series from one plain aggregate."""
        stats = []
        for i in range(self.size):
            c = F.nanvl(F.col(f"c{i}"), F.lit(None))
            stats += [part.alias(f"{name}{i}") for name, part in _summary(c, points, accuracy).items()]
        row = self.df.agg(*stats).first()
        return [{"series": i, **{k: row[f"{k}{i}"] for k in _SUMMARY}} for i in range(self.size)]

    def slotted(self, ranges: dict[int, list[tuple] | None]) -> DataFrame:
        bounds = {
            i: [x for low, high in spans for x in (low, just_above(high))] for i, spans in ranges.items() if spans is not None
        }
        searched = {i for i, xs in bounds.items() if all(math.isfinite(x) for x in xs)}

        def with_buckets(chunk: list[int]) -> DataFrame:
            df = self.df
            for i in searched.intersection(chunk):
                df = value_boundaries(f"c{i}", bounds[i], f"b{i}").transform(df)
            return df

        slot = {i: F.col(f"b{i}").cast("int") if i in searched else compared(F.col(f"c{i}"), r) for i, r in ranges.items()}
        return self._stack({i: [F.col(f"c{i}").alias("v"), slot[i].alias("slot")] for i in ranges}, with_buckets)


class Series:
    """A long table (series, v) of any sortable type with few wanted ranks."""

    def __init__(self, long: DataFrame):
        self.table = long

    def long(self) -> DataFrame:
        return self.table

    def summary(self, points: list[float], accuracy: int) -> list[dict]:
        stats = _summary(F.col("v"), points, accuracy)
        grouped = present(self.table).groupBy("series").agg(*[c.alias(name) for name, c in stats.items()])
        return [r.asDict() for r in grouped.collect()]

    def slotted(self, ranges: dict[int, list[tuple] | None]) -> DataFrame:
        slot = F.lit(None).cast("int")
        for i, spans in ranges.items():
            slot = F.when(F.col("series") == i, compared(F.col("v"), spans)).otherwise(slot)
        return self.table.withColumn("slot", slot).where(F.col("slot").isNotNull())


def present(df: DataFrame) -> DataFrame:
    """Rows with a value: neither NULL nor NaN."""
    df = df.where(F.col("v").isNotNull())
    if isinstance(df.schema["v"].dataType, (T.DoubleType, T.FloatType)):
        df = df.where(~F.isnan("v"))
    return df


def _merge(ranges: list[tuple]) -> list[tuple]:
    """Disjoint ranges in order; float ranges that touch become one."""
    merged: list[list] = []
    for low, high in sorted(ranges):
        if merged and low <= (just_above(merged[-1][1]) if isinstance(low, float) else merged[-1][1]):
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [tuple(r) for r in merged]


def _bounds_at(fraction: float, accuracy: int) -> list[float]:
    delta = 2.0 / accuracy
    return [max(0.0, fraction - delta), min(1.0, fraction + delta)]


def _sketch(source: Columns | Series, targets: dict[int, list[Target]], accuracy: int) -> tuple[dict, dict]:
    """Per series: the row count and a value range around every target."""
    points = sorted({p for ts in targets.values() for t in ts for p in _bounds_at(t.fraction, accuracy)})
    rows = source.summary(points, accuracy)
    totals, ranges = {}, {}
    for row in rows:
        if not row["n"]:
            totals[row["series"]] = 0
            continue
        at = dict(zip(points, row["at"]))
        totals[row["series"]] = row["n"]
        spans = []
        for t in targets[row["series"]]:
            below, above = _bounds_at(t.fraction, accuracy)
            spans.append(
                (row["low"] if below == 0.0 else at[below], row["high"] if above == 1.0 else at[above])
            )
        ranges[row["series"]] = _merge(spans)
    return totals, ranges


def _narrow(
    source: Columns | Series,
    ranges: dict[int, list[tuple]],
    wanted: dict[int, list[int]],
    accuracy: int,
    limit: int,
) -> dict[int, list[tuple]]:
    """Ranges that hold every wanted rank and ``limit`` rows at most, or one value.

    Each round counts the rows of all ranges and gaps. A rank in a gap makes the gap a range; a
    range with too many rows is sketched again. A sketch that doesn't shrink its range any more
    leaves values that are too alike to tell apart by it, and the range stays.
    """
    while True:
        slotted = present(source.slotted(ranges))
        parts = [F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]
        slots = {(r["series"], r["slot"]): r for r in slotted.groupBy("series", "slot").agg(*parts).collect()}
        kept: dict[int, list[tuple]] = {}
        asks: dict[tuple[int, int], list[float]] = {}
        moved = False
        for s, spans in ranges.items():
            kept[s] = []
            below = 0
            for slot in range(2 * len(spans) + 1):
                row = slots.get((s, slot))
                if row is None:
                    continue
                inside = [r for r in wanted[s] if below < r <= below + row["n"]]
                if inside:
                    span = (row["low"], row["high"])
                    moved = moved or slot % 2 == 0
                    if row["n"] > limit and row["low"] < row["high"]:
                        asks[(s, slot)] = [(r - below) / row["n"] for r in inside]
                    kept[s].append((slot, span))
                below += row["n"]
        inner: dict[tuple[int, int], dict] = {}
        if asks:
            points = sorted({p for ps in asks.values() for f in ps for p in _bounds_at(f, accuracy)})
            keep = F.lit(False)
            for s, slot in asks:
                keep = keep | ((F.col("series") == s) & (F.col("slot") == slot))
            sketched = slotted.where(keep).groupBy("series", "slot").agg(F.percentile_approx("v", points, accuracy).alias("at"))
            inner = {(r["series"], r["slot"]): dict(zip(points, r["at"])) for r in sketched.collect()}
        after: dict[int, list[tuple]] = {}
        for s, spans in kept.items():
            after[s] = []
            for slot, (low, high) in spans:
                at = inner.get((s, slot))
                if at is None:
                    after[s].append((low, high))
                    continue
                for f in asks[(s, slot)]:
                    below, above = _bounds_at(f, accuracy)
                    after[s].append((low if below == 0.0 else at[below], high if above == 1.0 else at[above]))
            after[s] = _merge(after[s])
        ranges = after
        if not moved and all(after[s] == _merge([span for _, span in spans]) for s, spans in kept.items()):
            return ranges


def _pick(source: Columns | Series, ranges: dict[int, list[tuple]], wanted: dict[int, list[int]]) -> dict:
    """Values at the wanted ranks: running counts within each range, shifted by what lies below it."""
    slotted = present(source.slotted(ranges))
    grouped = (
        slotted.select("series", "slot", F.when(F.col("slot") % 2 == 1, F.col("v")).alias("v"))
        .groupBy("series", "slot", "v")
        .agg(F.count("*").alias("n"))
    )
    lower = W.partitionBy("series").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)  # a row for each range and gap
    offsets = grouped.groupBy("series", "slot").agg(F.sum("n").alias("m")).select(
        "series", "slot", F.coalesce(F.sum("m").over(lower), F.lit(0)).alias("lower")
    )
    running = W.partitionBy("series", "slot").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = grouped.where(F.col("slot") % 2 == 1).withColumn("upto", F.sum("n").over(running))
    shifted = inside.join(F.broadcast(offsets), ["series", "slot"]).withColumn("upto", F.col("upto") + F.col("lower"))
    pairs = ", ".join(f"({s}, {r}L)" for s, ranks in wanted.items() for r in ranks)
    ranks = slotted.sparkSession.sql(f"SELECT * FROM VALUES {pairs} AS t(series, rank)")
    upto = shifted.withColumn("before", F.col("upto") - F.col("n"))
    hit = (F.col("before") < F.col("rank")) & (F.col("upto") >= F.col("rank"))
    # One row per wanted rank on the broadcast side.
    rows = upto.join(F.broadcast(ranks), "series").where(hit).select("series", "rank", "v", "before", "n").collect()
    return {(r["series"], r["rank"]): Found(r["v"], r["before"], r["n"]) for r in rows}


def pick_ranks(
    source: Columns | Series, targets: dict[int, list[Target]], *, accuracy: int = ACCURACY, limit: int = LIMIT
) -> tuple[dict[int, int], dict[tuple[int, int], Found]]:
    """Values at exact ranks of one or more series of numbers or times.

    Only the wanted values reach the driver.
    """
    totals, ranges = _sketch(source, targets, accuracy)
    wanted = {s: sorted({r for t in ts for r in t.ranks(totals[s])}) for s, ts in targets.items() if totals.get(s, 0) > 0}
    wanted = {s: ranks for s, ranks in wanted.items() if ranks}
    if not wanted:
        return totals, {}
    ranges = {s: ranges[s] for s in wanted}
    if any(totals[s] * 4 / accuracy > limit for s in ranges):
        ranges = _narrow(source, ranges, wanted, accuracy, limit)
    found = _pick(source, ranges, wanted)
    missing = {s: ranks for s, ranks in wanted.items() if any((s, r) not in found for r in ranks)}
    if missing:
        # The sketch missed its error bound: search the gaps that hold the ranks.
        found.update(_pick(source, _narrow(source, {s: ranges[s] for s in missing}, missing, accuracy, limit), missing))
    return totals, found


def interpolate(found: dict, series: int, n: int, p: float) -> float | None:
    """Linear interpolation between the two neighbouring order statistics."""
    if n == 0:
        return None
    position = (n - 1) * p
    low = math.floor(position)
    a = float(found[(series, low + 1)].value)
    if position == low:
        return a
    b = float(found[(series, min(low + 2, n))].value)
    part = position - low
    # From the nearer end, so that the result does not pass the other value by rounding.
    return a + (b - a) * part if part < 0.5 else b - (b - a) * (1 - part)


def exact_quantiles(df: DataFrame, probabilities: dict[str, list[float]], **tuning) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of several columns in one go."""
    columns = list(probabilities)
    targets = {i: [quantile_target(p) for p in probabilities[c]] for i, c in enumerate(columns)}
    totals, found = pick_ranks(Columns(df, columns), targets, **tuning)
    return {
        c: [interpolate(found, i, totals.get(i, 0), p) for p in probabilities[c]]
        for i, c in enumerate(columns)
    }


@dataclass(frozen=True)
class Cut:
    """A position in the order (key, tie). ``tie`` None: after all rows of ``key``."""

    key: object
    tie: object = None

    def before(self, key: Column, tie: Column) -> Column:
        """True for rows that lie strictly after the cut."""
        if self.tie is None:
            return key > F.lit(self.key)
        return (key > F.lit(self.key)) | ((key == F.lit(self.key)) & (tie > F.lit(self.tie)))


def _ranks_by_sort(ties: DataFrame, wanted: dict[int, list[int]]) -> dict[tuple[int, int], object]:
    """Order statistics of groups of strings (series, v): one distributed sort for all of them."""
    table, _ = materialize(
        ties.orderBy("series", "v").withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()),
        "sorted-ties",
    )
    # One row for each group and task of the sort.
    parts = table.groupBy("series", "part").agg(F.count("*").alias("n"), F.min("pos").alias("first")).orderBy("series", "part").collect()
    places = {}
    for s, ranks in wanted.items():
        before = 0
        for row in (p for p in parts if p["series"] == s):
            places.update({row["first"] + (r - before - 1): (s, r) for r in ranks if before < r <= before + row["n"]})
            before += row["n"]
    return {places[r["pos"]]: r["v"] for r in table.where(F.col("pos").isin(list(places))).select("pos", "v").collect()}


def cut_points(
    df: DataFrame,
    key: Column,
    tie: Column,
    targets: dict[int, list[Target]],
    *,
    series: Column | None = None,
    **tuning,
) -> tuple[dict[int, int], dict[int, list[Cut | None]]]:
    """Cuts behind the given ranks in the total order (key, tie).

    ``tie`` must make rows unique. The result has one cut per target, in order;
    a target whose rank is 0 gives None (everything lies after it).
    """
    base = df.select((series if series is not None else F.lit(0)).alias("series"), key.alias("v"), tie.alias("t"))
    non_zero = {
        s: [Target(t.fraction, lambda n, t=t: [r for r in t.ranks(n) if r > 0]) for t in ts]
        for s, ts in targets.items()
    }
    totals, found = pick_ranks(Series(base.select("series", "v")), non_zero, **tuning)
    return totals, cuts_from(base, targets, totals, found, **tuning)


def cuts_from(
    base: DataFrame, targets: dict[int, list[Target]], totals: dict[int, int], found: dict, **tuning
) -> dict[int, list[Cut | None]]:
    """Turn located key values into cuts; ``base`` has columns series, v and t."""
    wanted = {
        s: [(t.ranks(totals[s])[0] if totals.get(s, 0) else 0) for t in ts] for s, ts in targets.items()
    }
    # Ranks that fall inside a group of equal keys need the tie column as well.
    open_ties: dict[tuple, list[int]] = {}
    for s, ranks in wanted.items():
        for r in sorted({r for r in ranks if r > 0}):
            hit = found[(s, r)]
            if r - hit.before < hit.count:
                open_ties.setdefault((s, hit.value, hit.count), []).append(r - hit.before)

    resolved: dict[tuple, object] = {}
    if open_ties:
        groups = list(open_ties)
        label = F.lit(None).cast("int")
        for g, (s, value, _) in enumerate(groups):
            label = F.when((F.col("series") == s) & (F.col("v") == F.lit(value)), F.lit(g)).otherwise(label)
        ties = base.select(label.alias("series"), F.col("t").alias("v")).where(F.col("series").isNotNull())
        ranks = {g: open_ties[group] for g, group in enumerate(groups)}
        if isinstance(ties.schema["v"].dataType, T.NumericType):
            goals = {g: [rank_target(r / groups[g][2], lambda n, r=r: r) for r in rs] for g, rs in ranks.items()}
            hits = {at: hit.value for at, hit in pick_ranks(Series(ties), goals, **tuning)[1].items()}
        else:
            hits = _ranks_by_sort(ties, ranks)
        resolved = {(*groups[g], r): value for (g, r), value in hits.items()}

    cuts: dict[int, list[Cut | None]] = {}
    for s, ranks in wanted.items():
        cuts[s] = []
        for rank in ranks:
            if rank <= 0:
                cuts[s].append(None)
                continue
            hit = found[(s, rank)]
            inside = rank - hit.before
            tie = None if inside == hit.count else resolved[(s, hit.value, hit.count, inside)]
            cuts[s].append(Cut(hit.value, tie))
    return cuts


def cuts_passed(cuts: list[Cut | None], key: Column, tie: Column) -> Column:
    """How many of the cuts lie strictly before a row."""
    total = F.lit(0)
    for cut in cuts:
        total = total + (F.lit(1) if cut is None else cut.before(key, tie).cast("int"))
    return total
