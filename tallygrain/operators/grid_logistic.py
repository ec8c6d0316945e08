"""Cross validation of many logistic settings at once.

One pass over the rows gives the losses, gradients and curvatures of all models, those of every
setting and fold: in a batch, the margins of all settings are one matrix product, and so are the
gradients. Partial sums are added up per fold by Spark, so what reaches the driver does not grow
with the rows. The driver then takes one proximal Newton step for every model. A dozen passes fit
the whole grid (some 17 where a line parts the classes), where fits one by one take a job for each
step of each model.

The penalised loss is that of ``operators.train.classifier``: the weighted mean of the log loss plus
1 / (C * weight sum) times the norm of the coefficients; the intercept is free.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.cloudpickle import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.operators.split import fold_parts
from tallygrain.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a part of the written table, and doubles of curvature that a pass may carry.
PART_ROWS, CURVATURE = 100_000, 1 << 22
#: Partial sums of a fold that the driver adds up itself; more are merged by tasks first.
MERGED = 64
#: Bytes of a block of rows, rows that are computed at once, and columns up to which their products are kept for all settings.
BLOCK_BYTES, AT_ONCE, PRODUCTS = 1 << 14, 2048, 16
#: Held-out scores that a range should have, ranges at most, rows drawn for each to place their ends, scores a task keeps before it passes them on.
RANGE_ROWS, RANGES, DRAWN, KEPT = 200_000, 1024, 20, 1 << 22
PASSES, SWEEPS, POLISH, TOLERANCE = 100, 200, 5, 1e-8
#: Steps that came out shorter than this share of the way are followed by longer ones, up to so many times a Newton step.
SHORT, FURTHEST = 1.3, 4.0


def fold_rows(folded: DataFrame, head: list, label: str, weight: str, features: str, folds: list[int]) -> tuple[DataFrame, dict[int, int]]:
    """Every row and fold in blocks (model, held, rows, wide, block), as a written table, and the width of x by fold.

    A block is a matrix with the columns label, weight, 1 and x, so that passes take rows as they lie
    there. The preprocessing is fitted on the training rows of each fold; rows that a fold neither
    trains nor is tested on (``fold_parts``) have no part in it.
    """
    parts, fold = [], F.col("fold")
    for f in folds:
        fitted_on, tested_on = fold_parts(folded, f)
        prepared = Pipeline(stages=head).fit(folded.where(fitted_on))
        rows = prepared.transform(folded.where(fitted_on | tested_on))
        rows = rows.select((fold == f).alias("held"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), vector_to_array(features).alias("x"))
        parts.append(rows.mapInArrow(_blocks, "held boolean, rows int, wide int, block binary").select(F.lit(f).alias("model"), "*"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    table, _ = materialize(whole, "fold-rows")
    seen = table.groupBy("model").agg(F.max("wide").alias("wide"), F.sum("rows").alias("rows")).collect()
    # As many parts as the rows need: passes over small tables are not made of empty tasks.
    wanted = max(1, math.ceil(sum(r["rows"] for r in seen) / PART_ROWS))
    return (table.coalesce(wanted) if wanted < table.rdd.getNumPartitions() else table), {r["model"]: r["wide"] for r in seen}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (held, y, w, x) as blocks."""
    kept: dict[bool, np.ndarray] = {}

    def packed(cut: list[tuple[bool, np.ndarray]]) -> pa.RecordBatch:
        held, rows = zip(*cut, strict=True)
        return pa.RecordBatch.from_pydict({
            "held": pa.array(held, pa.bool_()), "rows": pa.array([len(r) for r in rows], pa.int32()),
            "wide": pa.array([r.shape[1] - 3 for r in rows], pa.int32()), "block": pa.array([r.tobytes() for r in rows], pa.binary()),
        })

    for batch in batches:
        if batch.column("held").null_count:
            batch = batch.filter(batch.column("held").is_valid())
        if not batch.num_rows:
            continue
        y, w, x = batch.column("y"), batch.column("w"), batch.column("x")
        if y.null_count or w.null_count:
            raise ValueError("a row has no label or no weight")
        values, offsets = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()
        wide = offsets[1] - offsets[0]
        every = np.column_stack([y.to_numpy(), w.to_numpy(), np.ones(len(y)), values[offsets[0] : offsets[-1]].reshape(-1, wide)])
        helds, cut = batch.column("held").to_numpy(zero_copy_only=False), []
        size = max(1, BLOCK_BYTES // (8 * every.shape[1]))
        for held in (False, True):
            rows = every[helds == held]
            rows = np.vstack([kept[held], rows]) if held in kept else rows
            whole = len(rows) // size * size
            cut += [(held, rows[k : k + size]) for k in range(0, whole, size)]
            kept[held] = rows[whole:].copy()
        if cut:
            yield packed(cut)
    if rest := [(held, rows) for held, rows in kept.items() if len(rows)]:
        yield packed(rest)


def _by_model(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(model, rows with a leading 1, label, weight) of a batch of blocks, for some rows at a time."""
    model, wide, block = batch.column("model").to_numpy(), batch.column("wide").to_numpy(), batch.column("block")
    ends = np.frombuffer(block.buffers()[1], np.int64 if pa.types.is_large_binary(block.type) else np.int32)[block.offset : block.offset + len(block) + 1]
    first = np.flatnonzero(np.r_[True, (model[1:] != model[:-1]) | (wide[1:] != wide[:-1])])
    for a, b in zip(first, [*first[1:], len(model)], strict=True):  # blocks of a model in a row are one matrix
        rows = np.frombuffer(block.buffers()[2], np.uint8)[ends[a] : ends[b]].view(np.float64).reshape(-1, wide[a] + 3)
        for k in range(0, len(rows), AT_ONCE):
            part = rows[k : k + AT_ONCE]
            yield int(model[a]), part[:, 2:], part[:, 0], part[:, 1]


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray, curved: bool) -> list[np.ndarray]:
    """Weight, losses (s), gradients (d, s) and curvatures (s, d, d) of the settings' coefficients beta (d, s)."""
    y, w = np.ascontiguousarray(y), np.ascontiguousarray(w)
    margin = beta.T @ x.T
    e = np.abs(margin)
    np.exp(np.negative(e, out=e), out=e)  # at most 1: nothing overflows, and small losses and curvatures keep their digits
    likely = 1 / (1 + e)
    other = e * likely
    away = np.where(margin >= 0, likely, other)
    away -= y
    away *= w
    loss = np.maximum(margin, 0)
    loss -= margin * y
    loss += np.log1p(e)
    out = [np.array([w.sum()]), loss @ w, (x.T @ away.T).ravel()]
    if curved:
        pull = other
        pull *= likely
        pull *= w
        s, d = beta.shape[1], x.shape[1]
        if d <= PRODUCTS:
            i, j = np.triu_indices(d)
            both = np.empty((s, d, d))
            both[:, i, j] = both[:, j, i] = pull @ (x[:, i] * x[:, j])
            out.append(both.ravel())
        else:
            out.append(np.concatenate([((x * pull[k][:, None]).T @ x).ravel() for k in range(s)]))
    return out


def one_pass(train: DataFrame, betas: dict[int, np.ndarray], curved: bool, many: bool) -> dict[int, np.ndarray]:
    """The sums of all models over all blocks of rows: one job. ``many``: tasks merge partial sums first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for m, x, y, w in _by_model(batch):
                    part = np.concatenate(_sums(x, y, w, betas[m], curved))
                    total[m] = total[m] + part if m in total else part
        yield pa.RecordBatch.from_pydict({"model": pa.array(list(total), pa.int32()), "sums": pa.array([t.tobytes() for t in total.values()], pa.binary())})

    def merged(rows: pa.Table) -> pa.Table:
        added = sum(np.frombuffer(s) for s in rows.column("sums").to_pylist())
        return pa.table({"model": rows.column("model")[:1], "sums": pa.array([added.tobytes()], pa.binary())})

    parts = train.select("model", "wide", "block").mapInArrow(run, "model int, sums binary")
    if many:
        parts = parts.groupBy("model", F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("at")).applyInArrow(merged, "model int, sums binary")
    out: dict[int, np.ndarray] = {}
    for r in parts.collect():
        part = np.frombuffer(r["sums"])
        out[r["model"]] = out[r["model"]] + part if r["model"] in out else part
    return out


def _proximal_steps(beta: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """Minima of local quadratic models with both penalties: (models, d), curvatures (models, d, d).

    Entry 0 is free of penalties. Without l1 the minimum is a linear system.
    """
    d = beta.shape[1]
    ridge = np.repeat(l2[:, None], d, axis=1)
    ridge[:, 0] = 0.0
    diagonal = np.arange(d)
    h = curvature.copy()
    h[:, diagonal, diagonal] += ridge + 1e-10 * np.maximum(h[:, diagonal, diagonal].max(axis=1, keepdims=True), 1e-20)
    slope = gradient + ridge * beta
    new = beta.copy()
    plain, sparse = np.flatnonzero(l1 == 0), np.flatnonzero(l1 > 0)
    if len(plain):
        new[plain] -= np.linalg.solve(h[plain], slope[plain][:, :, None])[:, :, 0]
    if len(sparse):
        new[sparse] = _sparse_steps(beta[sparse], slope[sparse], h[sparse], l1[sparse])
    return new


def _sparse_steps(beta: np.ndarray, slope: np.ndarray, h: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Minima of quadratic models (slope, h around beta) plus bound times the absolute entries after entry 0.

    Entry 0 takes its best value for whatever the others are, so it is eliminated first: in turns with
    them it would creep wherever a column goes along with it. Sweeps move the others in turn, all models
    side by side, and find which are zero; after each few, those that are not go to their joint minimum,
    or as far as the first of them that gets to zero. A sweep that then moves nothing is the end.
    """
    base, across = h[:, 0, 0], h[:, 0, 1:]
    inner = h[:, 1:, 1:] - across[:, :, None] * across[:, None, :] / base[:, None, None]
    own = np.maximum(np.diagonal(inner, axis1=1, axis2=2), 1e-12 * np.diagonal(h, axis1=1, axis2=2)[:, 1:])
    at = beta[:, 1:].copy()
    pull = slope[:, 1:] - across * (slope[:, :1] / base[:, None])
    first = None
    for turn in range(SWEEPS):
        largest = np.zeros(len(at))
        for j in range(at.shape[1]):
            z = at[:, j] * own[:, j] - pull[:, j]
            to = np.sign(z) * np.maximum(np.abs(z) - bound, 0.0) / own[:, j]
            move = to - at[:, j]
            at[:, j] = to
            pull += inner[:, :, j] * move[:, None]
            largest = np.maximum(largest, np.abs(move) * np.sqrt(own[:, j]))
        first = largest if first is None else first
        still = largest > np.maximum(1e-10, first / 10_000)
        if turn % POLISH == 1 and not still.any():
            break
        if turn % POLISH == 0:
            for i in np.flatnonzero(still | (turn == 0)):
                if len(live := np.flatnonzero(at[i])):
                    here = at[i, live]
                    step = np.linalg.lstsq(inner[i][np.ix_(live, live)], -(pull[i, live] + bound[i] * np.sign(here)), rcond=None)[0]
                    if len(crossed := np.flatnonzero((here + step) * here <= 0)):
                        shares = np.abs(here[crossed] / step[crossed])
                        step *= shares.min()
                        step[crossed[np.argmin(shares)]] = -here[crossed[np.argmin(shares)]]
                    at[i, live] += step
                    pull[i] += inner[i][:, live] @ step
    free = beta[:, 0] - (slope[:, 0] + (across * (at - beta[:, 1:])).sum(axis=1)) / base
    return np.hstack([free[:, None], at])


def fit_all(train: DataFrame, widths: dict[int, int], settings: list[dict], weight_sum: float) -> dict[int, np.ndarray]:
    """Coefficients (intercept first, a column for each setting) of every fold's models over (model, y, w, x).

    Newton steps where the curvatures of a pass are few enough, proximal gradient steps else (these are
    many and stop at about four digits). A step that does not lower the loss is halved; after one that
    the slope shows to be short, as all are while classes part, the next goes further. Models that stand
    still, or whose next step has nothing to gain, are left out of the passes for the others.
    """
    reg = np.array([1.0 / (s.get("C", 1.0) * weight_sum) for s in settings])
    l1 = np.array([r if s.get("penalty", "l2") == "l1" else 0.0 for r, s in zip(reg, settings, strict=True)])
    l2 = reg - l1
    n = len(settings)
    curved = sum((d + 1) ** 2 for d in widths.values()) * n <= CURVATURE
    state = {m: {"at": np.zeros((d + 1, n)), "try": np.zeros((d + 1, n)), "goal": np.zeros((d + 1, n)), "value": np.full(n, np.inf), "length": np.ones(n), "done": np.zeros(n, bool), "stiff": np.ones(n), "slope": np.zeros((d + 1, n)), "reach": np.ones(n)} for m, d in widths.items()}

    def penalty(beta: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return one * np.abs(beta[1:]).sum(axis=0) + two / 2 * (beta[1:] ** 2).sum(axis=0)

    many = train.rdd.getNumPartitions() > MERGED
    for _ in range(PASSES if curved else 10 * PASSES):
        live = {m: np.flatnonzero(~s["done"]) for m, s in state.items() if not s["done"].all()}
        if not live:
            break
        sums = one_pass(train.where(F.col("model").isin(list(live))), {m: state[m]["try"][:, i] for m, i in live.items()}, curved, many)
        ready: dict[int, list[tuple]] = {}
        for m, columns in live.items():
            s, d, k = state[m], widths[m] + 1, len(columns)
            if m not in sums:
                s["done"][:] = True  # a fold without training rows
                continue
            beta, rest = s["try"][:, columns], sums[m][1:] / sums[m][0]
            value = rest[:k] + penalty(beta, l1[columns], l2[columns])
            gradient = rest[k : k + d * k].reshape(d, k)
            for c, i in enumerate(columns):
                if np.isinf(s["value"][i]) and not np.isfinite(value[c]):
                    s["done"][i] = True  # the rows themselves have no finite sums
                    continue
                worse = value[c] > s["value"][i] + 1e-14 * abs(value[c]) or not np.isfinite(value[c])
                if worse and s["length"][i] > 1e-6:
                    s["length"][i] /= 2
                    s["stiff"][i] *= 2
                    s["reach"][i] = 1.0
                    s["try"][:, i] = s["at"][:, i] + s["length"][i] * (s["goal"][:, i] - s["at"][:, i])
                    continue
                gain = s["value"][i] - value[c]
                slope = gradient[:, c] + np.r_[0.0, l2[i] * beta[1:, c] + l1[i] * np.sign(beta[1:, c])]
                if not worse:
                    moved = beta[:, c] - s["at"][:, i]
                    before, after = s["slope"][:, i] @ moved, slope @ moved
                    reach = s["reach"][i] / (1 - after / before) if curved and s["length"][i] == 1 and before < min(0.0, after) else 1.0
                    s["reach"][i] = 1.0 if reach < SHORT else min(FURTHEST, reach)
                    s["at"][:, i], s["value"][i], s["slope"][:, i] = beta[:, c], value[c], slope
                s["length"][i] = 1.0
                if worse or gain < TOLERANCE * max(1e-3, abs(value[c])):
                    s["done"][i] = True
                    continue
                h = rest[k + d * k :].reshape(k, d, d)[c] if curved else np.diag(np.full(d, s["stiff"][i]))
                ready.setdefault(d, []).append((m, i, beta[:, c], gradient[:, c], h, l1[i], l2[i]))
        for rows in ready.values():
            owner, column, *parts = zip(*rows, strict=True)
            for m, i, goal, slope, h in zip(owner, column, _proximal_steps(*map(np.array, parts)), *parts[1:3], strict=True):
                s = state[m]
                step, at = goal - s["at"][:, i], s["at"][:, i]
                hoped = penalty(at, l1[i], l2[i]) - penalty(goal, l1[i], l2[i]) - slope @ step - step @ h @ step / 2
                if curved and hoped < TOLERANCE / 10 * max(1e-3, abs(s["value"][i])):
                    s["done"][i] = True
                    continue
                s["goal"][:, i] = s["try"][:, i] = np.where(goal == 0, 0.0, at + s["reach"][i] * step)
    return {m: s["at"] for m, s in state.items()}


def _range_ends(held: DataFrame, betas: dict[int, np.ndarray]) -> dict[int, list[np.ndarray]]:
    """Ends of about equal ranges of the scores of every (fold, setting), from rows drawn at random: they only say how the work is dealt."""
    counts = {r["model"]: r["n"] for r in held.groupBy("model").agg(F.sum("rows").alias("n")).collect()}
    ranges = {m: min(RANGES, math.ceil(n / RANGE_ROWS)) for m, n in counts.items()}
    ends = {m: [np.empty(0)] * betas[m].shape[1] for m in counts}
    share = {m: DRAWN * k / counts[m] for m, k in ranges.items() if k > 1}
    if not share:
        return ends

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                drawn = [(m, part.tobytes()) for m, x, _, _ in _by_model(batch) if len(part := x[random.random(len(x)) < share[m]])]
                if drawn:
                    model, rows = zip(*drawn, strict=True)
                    yield pa.RecordBatch.from_pydict({"model": pa.array(model, pa.int32()), "rows": pa.array(rows, pa.binary())})

    drawn: dict[int, list[np.ndarray]] = {}
    for r in held.where(F.col("model").isin(list(share))).select("model", "wide", "block").mapInArrow(draw, "model int, rows binary").collect():
        drawn.setdefault(r["model"], []).append(np.frombuffer(r["rows"]).reshape(-1, len(betas[r["model"]])))
    for m, parts in drawn.items():
        score = np.sort(np.vstack(parts) @ betas[m], axis=0)
        at = np.arange(1, ranges[m]) * len(score) // ranges[m]
        ends[m] = [np.unique(score[at, s]) for s in range(score.shape[1])]
    return ends


def areas(held: DataFrame, betas: dict[int, np.ndarray], settings: int) -> dict[tuple[int, int], float]:
    """Area under the ROC curve of every (fold, setting) over held-out blocks of rows; ties count half.

    Tasks sort their scores of either class and cut them at the ends of ranges; a range of a (fold,
    setting) is merged by one task, and shifted by the totals of those above, so no group has to be
    ranked as a whole. Scores that are an end are a range of their own, of which only the counts are
    sent, so many equal scores don't meet in a task.
    """
    ends = _range_ends(held, betas)

    def cut(m: int, score: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in range(settings):
            sides, found = [], {"range": [], "pos": [], "neg": [], "scores": []}
            for side in (y > 0.5, y <= 0.5):
                values = np.sort(score[side, s])
                at = np.column_stack([np.searchsorted(values, ends[m][s], "left"), np.searchsorted(values, ends[m][s], "right")]).ravel()
                sides.append((values, np.r_[0, at, len(values)]))
            (pos, a), (neg, b) = sides
            for k in np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0)):
                found["range"].append(k)
                found["pos"].append(a[k + 1] - a[k])
                found["neg"].append(b[k + 1] - b[k])
                found["scores"].append(b"" if k % 2 else pos[a[k] : a[k + 1]].tobytes() + neg[b[k] : b[k + 1]].tobytes())
            n = len(found["range"])
            yield pa.RecordBatch.from_pydict({
                "model": pa.array([m] * n, pa.int32()), "setting": pa.array([s] * n, pa.int32()), "range": pa.array(found["range"], pa.int32()),
                "pos": pa.array(found["pos"], pa.int64()), "neg": pa.array(found["neg"], pa.int64()), "scores": pa.array(found["scores"], pa.binary()),
            })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        many = 0
        for batch in batches:
            if batch.num_rows:
                for m, x, y, _ in _by_model(batch):
                    kept.setdefault(m, []).append((x @ betas[m], y.copy()))
                    many += len(x) * settings
                    if many >= KEPT:
                        for k, rows in kept.items():
                            yield from cut(k, *map(np.concatenate, zip(*rows, strict=True)))
                        kept, many = {}, 0
        for k, rows in kept.items():
            yield from cut(k, *map(np.concatenate, zip(*rows, strict=True)))

    def merged(rows: pa.Table) -> pa.Table:
        p, n = (rows.column(c).to_numpy() for c in ("pos", "neg"))
        pairs = p.sum() * n.sum() / 2  # of equal scores
        if rows.column("range")[0].as_py() % 2 == 0:
            parts = [np.frombuffer(b) for b in rows.column("scores").to_pylist()]
            pos = np.concatenate([b[:k] for b, k in zip(parts, p, strict=True)])
            neg = np.sort(np.concatenate([b[k:] for b, k in zip(parts, p, strict=True)]))
            pos.sort()
            pairs = (np.searchsorted(neg, pos, "left").sum() + np.searchsorted(neg, pos, "right").sum()) / 2
        sums = {"pairs": pa.array([float(pairs)]), "p": pa.array([float(p.sum())]), "n": pa.array([float(n.sum())])}
        return pa.table({c: rows.column(c)[:1] for c in ("model", "setting", "range")} | sums)

    one = ["model", "setting"]
    parts = held.select("model", "wide", "block").mapInArrow(run, "model int, setting int, range int, pos long, neg long, scores binary")
    ranges = parts.groupBy(*one, "range").applyInArrow(merged, "model int, setting int, range int, pairs double, p double, n double")
    above = Window.partitionBy(*one).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranges.withColumn("before", F.coalesce(F.sum("p").over(above), F.lit(0.0)))
    found = rows.groupBy(*one).agg(F.sum(F.col("pairs") + F.col("n") * F.col("before")).alias("pairs"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return {(r["model"], r["setting"]): r["pairs"] / (r["p"] * r["n"]) if r["p"] and r["n"] else float("nan") for r in found.collect()}


def grid_areas(folded: DataFrame, head: list, settings: list[dict], label: str, weight: str, features: str, weight_sum: float, folds: list[int]) -> list[float]:
    """Mean held-out area of each setting; ``folded`` has the column fold (and usable, for folds in time)."""
    rows, widths = fold_rows(folded, head, label, weight, features, folds)
    betas = fit_all(rows.where("not held"), widths, settings, weight_sum)
    found = areas(rows.where("held"), betas, len(settings))
    return [float(np.nanmean([found.get((f, s), float("nan")) for f in folds])) for s in range(len(settings))]
