"""Proxy risk labels from clusters of customers."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.operators.encode import Scale, ScaledColumns
from tallygrain.operators.joins import build_lookup, lookup_join
from tallygrain.operators.order_stats import exact_quantiles
from tallygrain.operators.rfm import target_rfm_table

INTENDED = "intended"  # the least engaged customers are high risk
AS_CODED = "as_coded"  # the opposite rank directions, kept as an option


def check_polarity(polarity: str) -> None:
    if polarity not in (INTENDED, AS_CODED):
        raise ValueError(f"polarity must be '{INTENDED}' or '{AS_CODED}'")


def log_features(table: DataFrame, columns: list[str]) -> DataFrame:
    """log1p of each column as ``log_<column>``; values below 0 fail with a clear message."""
    return table.withColumns(
        {
            f"log_{c}": F.when(F.col(c) >= 0, F.log1p(c)).otherwise(
                F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(
                    F.raise_error(F.concat(F.lit(f"negative {c}: "), F.col(c).cast("string"))).cast("double")
                )
            )
            for c in columns
        }
    )


def fit_kmeans(
    scaled: DataFrame, features: list[str], k: int, seed: int = 42, restarts: int = 10, parallelism: int = 4
) -> KMeansModel:
    """Best of several seeded runs by training cost, ``parallelism`` of them at a time.

    The assembled vectors are cached for the iterations and released afterwards.
    """
    vectors = VectorAssembler(inputCols=features, outputCol="_v").transform(scaled).select("_v").persist()

    def run(i: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + i, featuresCol="_v", predictionCol="cluster", maxIter=300, tol=1e-4).fit(vectors)

    try:
        vectors.count()  # fill the cache once, before the runs share it
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = list(pool.map(run, range(restarts)))
        return min(models, key=lambda m: m.summary.trainingCost)
    finally:
        vectors.unpersist()


def nearest_centroid(features: list[str], centroids: list[list[float]]) -> Column:
    """Index of the closest centroid, the first on ties."""
    distances = [
        sum((F.pow(F.col(f) - F.lit(float(x)), F.lit(2)) for f, x in zip(features, center)), F.lit(0.0))
        for center in centroids
    ]
    index = F.lit(0)
    best = distances[0]
    for i, d in enumerate(distances[1:], start=1):
        index = F.when(d < best, F.lit(i)).otherwise(index)
        best = F.least(best, d)
    return F.when(best.isNotNull(), index)


def cluster_means(table: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    return table.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])


def average_rank(values: list[float], ascending: bool = True) -> list[float]:
    ordered = sorted(values, reverse=not ascending)
    return [ordered.index(v) + 1 + (ordered.count(v) - 1) / 2 for v in values]


def high_risk_cluster(means: DataFrame, cluster: str = "cluster", polarity: str = INTENDED) -> int:
    """The cluster with high recency and low frequency and spend (k rows, one per cluster)."""
    check_polarity(polarity)
    rows = means.select(cluster, "Recency", "Frequency", "Monetary").orderBy(cluster).collect()
    total = [
        r + f + m
        for r, f, m in zip(
            average_rank([x["Recency"] for x in rows], ascending=False),
            average_rank([x["Frequency"] for x in rows]),
            average_rank([x["Monetary"] for x in rows]),
        )
    ]
    pick = min(total) if polarity == INTENDED else max(total)
    return rows[total.index(pick)][cluster]


def label_by_cluster(
    table: DataFrame, k: int = 3, seed: int = 42, restarts: int = 10, polarity: str = INTENDED
) -> DataFrame:
    """Customer path: log1p, standardise, cluster, flag one cluster. Adds ``is_high_risk``."""
    names = ["Recency", "Frequency", "Monetary"]
    logs = [f"log_{c}" for c in names]
    logged = log_features(table, names)
    scaled = Scale.using(columns=logs, method="standard").fit(logged).transform(logged)
    model = fit_kmeans(scaled, logs, k, seed, restarts)
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    clustered = scaled.withColumn("cluster", nearest_centroid(logs, centers)).drop(*logs)
    risky = high_risk_cluster(cluster_means(clustered, names), polarity=polarity)
    return clustered.withColumn("is_high_risk", (F.col("cluster") == risky).cast("int")).drop("cluster")


def cluster_risk_rank(means: DataFrame, score: str = "rfm_score", cluster: str = "cluster") -> dict[int, int]:
    """Cluster → rank of its mean score, 0 for the lowest (k rows on the driver)."""
    rows = means.select(cluster, score).orderBy(score, cluster).collect()
    return {r[cluster]: rank for rank, r in enumerate(rows)}


def map_values(column: Column, mapping: dict) -> Column:
    expr = F.lit(None)
    for key, value in mapping.items():
        expr = F.when(column == F.lit(key), F.lit(value)).otherwise(expr)
    return expr


@dataclass(frozen=True)
class RiskRanker:
    """Fitted target path: scaling, centroids and the risk rank of each cluster."""

    scaling: ScaledColumns
    centroids: list[list[float]]
    ranks: dict[int, int]

    FEATURES = ("recency", "frequency", "monetary")

    @classmethod
    def fit(cls, customers: DataFrame, k: int = 3, seed: int = 42, restarts: int = 10) -> RiskRanker:
        """``customers`` has recency, frequency, monetary and rfm_score."""
        names = list(cls.FEATURES)
        scaling = Scale.using(columns=names, method="standard").fit(customers)
        scaled = scaling.transform(customers)
        model = fit_kmeans(scaled, names, k, seed, restarts)
        centers = [[float(x) for x in c] for c in model.clusterCenters()]
        clustered = scaled.withColumn("cluster", nearest_centroid(names, centers))
        return cls(scaling, centers, cluster_risk_rank(cluster_means(clustered, ["rfm_score"])))

    def transform(self, customers: DataFrame) -> DataFrame:
        """Adds ``cluster`` and ``risk_rank``; the metrics keep their own scale."""
        shifts = self.scaling.configuration()["scales"]
        scaled = customers.withColumns(
            {f"_{c}": (F.col(c).cast("double") - F.lit(a)) / F.lit(b) for c, (a, b) in shifts.items()}
        )
        inner = [f"_{c}" for c in self.FEATURES]
        ranked = scaled.withColumn("cluster", nearest_centroid(inner, self.centroids))
        return ranked.withColumn("risk_rank", map_values(F.col("cluster"), self.ranks)).drop(*inner)

    def save(self, spark: SparkSession, path: str) -> None:
        self.scaling.write().save(os.path.join(path, "scaling"))
        rows = [(i, c, self.ranks[i]) for i, c in enumerate(self.centroids)]
        spark.createDataFrame(rows, "cluster int, centroid array<double>, risk_rank int").write.parquet(
            os.path.join(path, "clusters")
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RiskRanker:
        rows = spark.read.parquet(os.path.join(path, "clusters")).orderBy("cluster").collect()
        return cls(
            ScaledColumns.load(os.path.join(path, "scaling")),
            [list(r["centroid"]) for r in rows],
            {r["cluster"]: r["risk_rank"] for r in rows},
        )


def threshold_label(df: DataFrame, rank: str = "risk_rank", share: float = 0.2, polarity: str = INTENDED) -> DataFrame:
    """Flag rows by a quantile of the risk rank.

    intended: ranks up to the ``share`` quantile (0 is the riskiest rank).
    as_coded: ranks from the ``share`` quantile upwards.
    """
    check_polarity(polarity)
    edge = exact_quantiles(df, {rank: [share]})[rank][0]
    hit = F.col(rank) <= F.lit(edge) if polarity == INTENDED else F.col(rank) >= F.lit(edge)
    return df.withColumn("is_high_risk", hit.cast("int"))


def fallback_label(df: DataFrame, score: str = "rfm_score", share: float = 0.2) -> DataFrame:
    """Label 1 for scores up to the given quantile."""
    edge = exact_quantiles(df, {score: [share]})[score][0]
    return df.withColumn("is_high_risk", (F.col(score) <= F.lit(edge)).cast("int"))


def proxy_target(
    df: DataFrame,
    cols: TxColumns = DEFAULT,
    k: int = 3,
    share: float = 0.2,
    polarity: str = INTENDED,
    money_scale: int | None = None,
    on_duplicate: str = "error",
    restarts: int = 10,
) -> tuple[DataFrame, RiskRanker]:
    """Transactions with risk_rank, rfm_score and is_high_risk of their customer.

    intended: the quantile is taken over customers and ``share`` is the wanted
    high-risk share. as_coded: the quantile is taken over transaction rows and
    ``share`` is the percentile from which on ranks are flagged.
    """
    check_polarity(polarity)
    customers, _ = target_rfm_table(df, cols, money_scale=money_scale, on_duplicate=on_duplicate)
    ranker = RiskRanker.fit(customers, k, restarts=restarts)
    ranked = ranker.transform(customers).select(cols.customer, "risk_rank", "rfm_score", "frequency")
    if polarity == INTENDED:
        labelled = threshold_label(ranked, share=share, polarity=polarity)
        lookup = build_lookup(labelled, [cols.customer], "risk", "frequency")
        return lookup_join(df, lookup).drop("frequency"), ranker
    lookup = build_lookup(ranked, [cols.customer], "risk", "frequency")
    # Quantile over rows: each customer's rank counts once per transaction.
    edge = _weighted_rank_quantile(lookup.table, share)
    joined = lookup_join(df, lookup).drop("frequency")
    return joined.withColumn("is_high_risk", (F.col("risk_rank") >= F.lit(edge)).cast("int")), ranker


def _weighted_rank_quantile(customers: DataFrame, p: float) -> float:
    """Interpolated quantile of risk_rank over transactions, from at most k counts."""
    counts = customers.groupBy("risk_rank").agg(F.sum("frequency").alias("n")).orderBy("risk_rank").collect()
    total = sum(r["n"] for r in counts)

    def at(rank: int) -> float:
        seen = 0
        for r in counts:
            seen += r["n"]
            if rank <= seen:
                return float(r["risk_rank"])
        return float(counts[-1]["risk_rank"])

    position = (total - 1) * p
    low = int(position)
    a, b = at(low + 1), at(min(low + 2, total))
    return a + (b - a) * (position - low)

