"""Classifier training with Spark ML: families, search, stacking, importances."""

from __future__ import annotations

import itertools
import random
import time as clock
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.operators.encode import Scale, feature_names, preprocessing
from tallygrain.operators.evaluate import evaluate
from tallygrain.operators.grid_logistic import grid_areas
from tallygrain.operators.split import fold_parts, stratified_folds, time_series_plan
from tallygrain.session import materialize
from tallygrain.sources.runs import params_text

WEIGHT = "class_weight"
#: Rows of a part of a table that many small fits share.
ROWS_OF_A_PART = 100_000

# Search spaces of the model families.
LOGISTIC_SPACE = {"C": [0.001, 0.01, 0.1, 1, 10, 100], "penalty": ["l1", "l2"]}
FOREST_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [None, 10, 20, 30],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
}
BOOSTING_SPACE = {
    "n_estimators": [100, 200],
    "learning_rate": [0.01, 0.1, 0.2],
    "max_depth": [3, 5, 7],
    "min_samples_split": [2, 5],
    "min_samples_leaf": [1, 2],
}
SEARCH_SPACES = {
    "logistic_regression": LOGISTIC_SPACE,
    "random_forest": FOREST_SPACE,
    "gradient_boosting": BOOSTING_SPACE,
}
# The single-model trainer searches two more settings.
TRAINER_SPACES = {
    "logistic_regression": LOGISTIC_SPACE,
    "random_forest": {**FOREST_SPACE, "class_weight": ["balanced", "balanced_subsample", None]},
    "gradient_boosting": {**BOOSTING_SPACE, "subsample": [0.8, 1.0]},
    "stacking": {
        "rf_n_estimators": [100, 200],
        "rf_max_depth": [None, 10],
        "gb_n_estimators": [100, 200],
        "gb_learning_rate": [0.01, 0.1],
    },
}
MAX_DEPTH = 30  # the deepest tree Spark ML grows


def add_class_weight(df: DataFrame, label: str, column: str = WEIGHT) -> DataFrame:
    """Balanced weights n / (2·n_c) from one count per class."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label) == F.lit(value), F.lit(total / (2.0 * n))).otherwise(weight)
    return df.withColumn(column, weight)


def used_depth(settings: dict, default: int | None = None) -> int:
    """The depth a tree grows to at most; no limit means the deepest that Spark ML grows."""
    depth = settings.get("max_depth", default) or MAX_DEPTH
    if depth > MAX_DEPTH:
        raise ValueError(f"max_depth {depth} is above {MAX_DEPTH}, the deepest tree there is")
    return depth


def same_fit(settings: dict) -> tuple:
    """What the estimator sees: split and leaf limits together are one limit, no depth is the deepest."""
    rest = {k: v for k, v in settings.items() if k not in ("min_samples_leaf", "min_samples_split", "max_depth")}
    depth = used_depth(settings) if "max_depth" in settings else None
    return (*sorted((k, str(v)) for k, v in rest.items()), ("rows of a leaf", _split_size(settings)), ("depth", depth))


def draw_settings(space: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """n random combinations that are different fits (all of them when there are fewer)."""
    combined = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    every = list({same_fit(s): s for s in reversed(combined)}.values())[::-1]
    return every if n >= len(every) else random.Random(seed).sample(every, n)


def _split_size(settings: dict) -> int:
    # The smallest leaf that honours both limits of a split.
    return max(settings.get("min_samples_leaf", 1), (settings.get("min_samples_split", 2) + 1) // 2)


def classifier(family: str, settings: dict, label: str, features: str, weight_sum: float = 1.0, seed: int = 42):
    """A Spark ML estimator for one combination of settings.

    The penalty strength C maps to regParam = 1 / (C · Σ weights), as Spark averages
    the loss over the rows.
    """
    common = {"labelCol": label, "featuresCol": features}
    if family == "logistic_regression":
        return LogisticRegression(
            maxIter=settings.get("max_iter", 1000),
            regParam=1.0 / (settings.get("C", 1.0) * weight_sum),
            elasticNetParam=1.0 if settings.get("penalty", "l2") == "l1" else 0.0,
            standardization=False,
            weightCol=WEIGHT,
            **common,
        )
    if family == "random_forest":
        model = RandomForestClassifier(
            numTrees=settings.get("n_estimators", 100),
            maxDepth=used_depth(settings),
            minInstancesPerNode=_split_size(settings),
            seed=seed,
            **common,
        )
        return model if settings.get("class_weight", "balanced") is None else model.setWeightCol(WEIGHT)
    if family == "gradient_boosting":
        return GBTClassifier(
            maxIter=settings.get("n_estimators", 100),
            stepSize=settings.get("learning_rate", 0.1),
            maxDepth=used_depth(settings, 3),
            minInstancesPerNode=_split_size(settings),
            subsamplingRate=settings.get("subsample", 1.0),
            seed=seed,
            **common,
        )
    raise ValueError(f"unsupported model family: {family}")


@dataclass
class Trained:
    family: str
    model: PipelineModel
    cv_score: float | None
    best_settings: dict | None
    search: list[tuple[str, float]] = field(default_factory=list)
    test_metrics: dict[str, float] = field(default_factory=dict)
    train_metrics: dict[str, float] = field(default_factory=dict)
    seconds: float | None = None


def predictions(model: PipelineModel, df: DataFrame, score: str = "risk_score", label: str = "predicted") -> DataFrame:
    """Adds the positive-class probability and the predicted class."""
    out = model.transform(df)
    return out.withColumns(
        {score: vector_to_array("probability")[1], label: F.col("prediction").cast("int")}
    )


def search_model(
    train: DataFrame,
    family: str,
    label: str,
    key: str,
    head: list,
    features: str = "features",
    settings: list[dict] | None = None,
    folds: int = 5,
    seed: int | None = 42,
    parallelism: int = 4,
    time: str | None = None,
    gap: int = 0,
) -> Trained:
    """Cross-validated search over a list of settings, refit on all rows.

    Folds are exact stratified folds; with ``seed`` None they follow the key's order. With ``time``
    they follow time instead: each is tested on the block after its training rows, ``gap`` rows
    apart. All logistic settings and folds are fitted in the same passes over the rows.
    """
    begun = clock.monotonic()
    weighted = add_class_weight(train, label)
    weight_sum = float(weighted.count())  # balanced weights add up to the row count
    settings = settings or [{}]
    tails = [classifier(family, s, label, features, weight_sum, seed or 42) for s in settings]
    if family in ("random_forest", "gradient_boosting"):  # records say which depth was used
        settings = [s | {"max_depth": used_depth(s, 3 if family == "gradient_boosting" else None)} for s in settings]
    if len(settings) == 1 and folds < 2:
        return Trained(family, Pipeline(stages=[*head, tails[0]]).fit(weighted), None, settings[0], seconds=clock.monotonic() - begun)
    if time:
        folded, numbers = time_series_plan(weighted, time, key, folds, gap), list(range(1, folds + 1))
    else:
        folded, numbers = stratified_folds(weighted, key, label, folds, seed, "fold"), list(range(folds))
    if family == "logistic_regression":
        areas = grid_areas(folded, head, settings, label, WEIGHT, features, weight_sum, numbers)
    else:
        areas = cross_validate(folded, head, tails, label, numbers, parallelism)
    best = max(range(len(settings)), key=lambda i: areas[i])
    final = Pipeline(stages=[*head, tails[best]]).fit(weighted)
    return Trained(family, final, areas[best], settings[best], list(zip([params_text(s) for s in settings], areas)), seconds=clock.monotonic() - begun)


def cross_validate(
    folded: DataFrame, head: list, tails: list, label: str, folds: list[int], parallelism: int = 4
) -> list[float]:
    """Mean area under the ROC curve of every candidate.

    The preprocessing does not depend on the candidate, so it is fitted once per
    fold and its output is shared; the candidates of a fold are then fitted
    ``parallelism`` at a time, each as distributed jobs.
    """
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    totals = [0.0] * len(tails)
    for f in folds:
        trained, tested = fold_parts(folded, f)
        prepared = Pipeline(stages=head).fit(folded.where(trained))
        rows = prepared.transform(folded.where(trained | tested)).persist()
        fit_rows, held = rows.where(trained), rows.where(tested)
        try:
            rows.count()  # fill the cache once, before the candidates share it
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                areas = list(pool.map(lambda tail: evaluator.evaluate(tail.fit(fit_rows).transform(held)), tails))
        finally:
            rows.unpersist()
        totals = [t + a / len(folds) for t, a in zip(totals, areas)]
    return totals


def standard_head(numeric: list[str], features: str = "features") -> list:
    """Standardise numeric columns and assemble them."""
    return [
        Scale.using(columns=numeric, method="standard"),
        VectorAssembler(inputCols=numeric, outputCol=features, handleInvalid="keep"),
    ]


def preprocessed_head(numeric: list[str], categorical: list[str], features: str = "features") -> list:
    """Impute, scale and encode inside the cross validation."""
    return preprocessing(numeric, categorical, output=features).getStages()


def train_families(
    train: DataFrame,
    label: str,
    key: str,
    numeric: list[str],
    test: DataFrame | None = None,
    families: dict[str, dict] = SEARCH_SPACES,
    n_iter: int = 10,
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    head: list | None = None,
) -> dict[str, Trained]:
    """Random search per family and, with a test set, its metrics."""
    results = {}
    for family, space in families.items():
        chosen = draw_settings(space, n_iter, seed)
        stages = head if head is not None else standard_head(numeric)
        run = search_model(train, family, label, key, stages, settings=chosen, folds=folds, seed=None, parallelism=parallelism)
        run.train_metrics = evaluate(predictions(run.model, train), label, "predicted", "risk_score")
        if test is not None:
            run.test_metrics = evaluate(predictions(run.model, test), label, "predicted", "risk_score")
        results[family] = run
    return results


def best_family(results: dict[str, Trained], metric: str = "roc_auc") -> str:
    """The family with the highest test metric, the first on ties."""
    return max(results, key=lambda f: (results[f].test_metrics.get(metric, float("-inf"))))


def best_row(metrics: DataFrame, name: str = "model_name", metric: str = "roc_auc") -> DataFrame:
    """The same choice on a table of metrics."""
    return metrics.agg(F.max_by(name, metric).alias(name), F.max(metric).alias(metric))


def feature_importance(model, scored: DataFrame, features: str = "features") -> DataFrame:
    """(feature, importance), largest first: tree importances or absolute coefficients.

    A stacked model has the mean importances of its base models.
    """
    if isinstance(model, Stacked):
        parts = [feature_importance(PipelineModel([base]), scored, features) for base in model.bases]
        both = parts[0]
        for part in parts[1:]:
            both = both.unionAll(part)
        return both.groupBy("feature").agg((F.sum("importance") / len(parts)).alias("importance")).orderBy(F.desc("importance"), "feature")
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = [float(v) for v in last.featureImportances.toArray()]
    elif hasattr(last, "coefficientMatrix"):
        matrix = last.coefficientMatrix.toArray()
        values = [float(v) for v in abs(matrix).sum(axis=0)]
    else:
        raise ValueError("the model has neither feature importances nor coefficients")
    names = feature_names(scored, features)
    names = names if len(names) == len(values) else [f"feature_{i}" for i in range(len(values))]
    rows = list(zip(names, values))
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def top_features(importance: DataFrame, n: int | None = None) -> DataFrame:
    ordered = importance.orderBy(F.desc("importance"), "feature")
    return ordered if n is None else ordered.limit(n)


class Stacked(Model, MLWritable, MLReadable):
    """Forest and boosting under a logistic model on their probabilities; an ML model like any other."""

    def __init__(self, head: PipelineModel, bases: list, final: PipelineModel):
        super().__init__()
        self.head, self.bases, self.final = head, bases, final

    @property
    def stages(self) -> list:
        return [*self.head.stages, *self.bases, *self.final.stages]

    def _transform(self, df: DataFrame) -> DataFrame:
        rows = self.head.transform(df)
        for i, base in enumerate(self.bases):
            rows = _base_score(base, rows, f"stack_{i}")
        return self.final.transform(rows)

    def write(self) -> MLWriter:
        return _StackedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StackedReader()


class _StackedWriter(MLWriter):
    """Metadata, and all parts as pipelines below one folder."""

    def __init__(self, model: Stacked):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"bases": len(self.model.bases)})
        parts = {"head": self.model.head, "final": self.model.final} | {f"base-{i}": PipelineModel([b]) for i, b in enumerate(self.model.bases)}
        for name, part in parts.items():
            part.write().save(f"{path}/{name}")


class _StackedReader(MLReader):
    def load(self, path: str) -> Stacked:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        bases = [PipelineModel.load(f"{path}/base-{i}").stages[0] for i in range(metadata["bases"])]
        model = Stacked(PipelineModel.load(f"{path}/head"), bases, PipelineModel.load(f"{path}/final"))
        model._resetUid(metadata["uid"])
        return model


def _base_score(model, rows: DataFrame, name: str) -> DataFrame:
    scored = model.transform(rows)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def train_stacking(
    train: DataFrame,
    label: str,
    key: str,
    head: list,
    settings: dict | None = None,
    folds: int = 5,
    seed: int = 42,
    features: str = "features",
    parallelism: int = 8,
) -> Stacked:
    """The final model sees only out-of-fold probabilities of the base models.

    The base models of all folds, and those of all rows, are fitted side by side from one written
    table, which has as many parts as its rows need.
    """
    settings = settings or {}
    forest = {"n_estimators": settings.get("rf_n_estimators", 100), "max_depth": settings.get("rf_max_depth"), "class_weight": None}
    boosting = {"n_estimators": settings.get("gb_n_estimators", 100), "learning_rate": settings.get("gb_learning_rate", 0.1)}
    fitted_head = Pipeline(stages=head).fit(train)
    ready, seen = materialize(stratified_folds(fitted_head.transform(train), key, label, folds, None, "fold"), "stack", {"n": F.count(F.lit(1))})
    ready = ready.coalesce(max(1, -(-seen["n"] // ROWS_OF_A_PART))).persist()
    makers = [
        lambda: classifier("random_forest", forest, label, features, seed=seed),
        lambda: classifier("gradient_boosting", boosting, label, features, seed=seed),
    ]
    tasks = [(i, f) for i in range(len(makers)) for f in (*range(folds), None)]
    try:
        ready.count()  # fill the cache once, before the fits share it
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            fits = pool.map(lambda t: makers[t[0]]().fit(ready if t[1] is None else ready.where(F.col("fold") != t[1])), tasks)
            fitted = dict(zip(tasks, fits))
        parts = None
        for f in range(folds):
            held = ready.where(F.col("fold") == f)
            for i in range(len(makers)):
                held = _base_score(fitted[i, f], held, f"stack_{i}")
            parts = held if parts is None else parts.unionByName(held)
        assembler = VectorAssembler(inputCols=["stack_0", "stack_1"], outputCol="stack_features")
        stacked = add_class_weight(materialize(parts.select(label, "stack_0", "stack_1"), "stack-scores")[0], label)
        final = classifier("logistic_regression", {"C": 1.0, "max_iter": 100}, label, "stack_features", float(seen["n"]))
        final_model = Pipeline(stages=[assembler, final]).fit(stacked)
    finally:
        ready.unpersist()
    bases = [fitted[i, None] for i in range(len(makers))]
    return Stacked(fitted_head, bases, final_model)


def search_stacking(
    train: DataFrame, label: str, key: str, head: list, settings: list[dict], folds: int = 5, seed: int = 42
) -> Trained:
    """Cross-validated search over stacking settings, refit on all rows."""
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    outer = stratified_folds(train, key, label, folds, seed, "outer").persist()
    areas = []
    try:
        for chosen in settings:
            total = 0.0
            for f in range(folds):
                model = train_stacking(outer.where(F.col("outer") != f), label, key, head, chosen, folds, seed)
                total += evaluator.evaluate(model.transform(outer.where(F.col("outer") == f)))
            areas.append(total / folds)
    finally:
        outer.unpersist()
    best = max(range(len(settings)), key=lambda i: areas[i])
    final = train_stacking(train, label, key, head, settings[best], folds, seed)
    return Trained("stacking", final, areas[best], settings[best], list(zip([params_text(s) for s in settings], areas)))


FAMILY_OF = {
    "random_forest": "random_forest",
    "gradient_boosting": "gradient_boosting",
    "logistic": "logistic_regression",
    "stacking": "stacking",
}


def fit_model(
    train: DataFrame,
    model_type: str,
    label: str,
    key: str,
    numeric: list[str],
    categorical: list[str] = (),
    search: str = "random",
    n_iter: int = 20,
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    space: dict[str, list] | None = None,
) -> Trained:
    """One model with preprocessing: ``search`` is 'random', 'grid' or 'none'."""
    if model_type not in FAMILY_OF:
        raise ValueError(f"unsupported model type: {model_type}")
    if search not in ("random", "grid", "none"):
        raise ValueError(f"unknown search: {search}")
    family = FAMILY_OF[model_type]
    space = space or TRAINER_SPACES[family]
    head = preprocessed_head(list(numeric), list(categorical))
    if search == "none":
        plain = {"class_weight": None} if family == "random_forest" else {}
        if family == "stacking":
            return Trained(family, train_stacking(train, label, key, head, {}, folds, seed), None, None)
        return search_model(train, family, label, key, head, settings=[plain], folds=1, seed=seed)
    every = 1
    for values in space.values():
        every *= len(values)
    settings = draw_settings(space, every if search == "grid" else n_iter, seed)
    if family == "stacking":
        return search_stacking(train, label, key, head, settings, folds, seed)
    return search_model(train, family, label, key, head, settings=settings, folds=folds, seed=seed, parallelism=parallelism)
