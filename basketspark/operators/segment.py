"""Behavioural segmentation on recency, frequency and monetary value."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketspark.functions.joins import grid_product
from basketspark.functions.ranks import exact_quantiles, global_row_number, grouped_quantiles, rank_bucket, value_bucket
from basketspark.operators.features import RFM_COLUMNS

SEED = 42
RUNS_AT_ONCE = 8  # k-means runs, whose many short jobs would leave most cores idle one after the other

# Segment name -> guidance text.
GUIDANCE = {
    "Champions": "Highest value and recently active. Protect: early access, loyalty perks.",
    "At-risk high-value": "Spent real money, now gone quiet. Win back: this is the profitable list.",
    "New / Low-value": "Recent but small. Nurture: grow basket size before they lapse.",
    "Lapsed / One-off": "One purchase, long ago. Cheapest to ignore; reactivate only in bulk.",
}


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation of log1p(recency, frequency, monetary)."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]


def scaler_table(features: DataFrame) -> DataFrame:
    """Fitted scaler as rows: (feature, mean, scale)."""
    logs = {c: F.log1p(F.col(c).cast("double")) for c in RFM_COLUMNS}
    stats = features.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in logs.items()], *[F.stddev_pop(v).alias(f"s_{c}") for c, v in logs.items()]
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")).alias("scale"))
        for c in RFM_COLUMNS
    ])
    return stats.select(F.explode(rows).alias("r")).select("r.*")


def fit_scaler(features: DataFrame) -> Scaler:
    """Three means and three scales on the driver; reused, never re-fitted, when scoring."""
    rows = {r["feature"]: r for r in scaler_table(features).collect()}
    return Scaler(tuple(rows[c]["mean"] for c in RFM_COLUMNS), tuple(rows[c]["scale"] for c in RFM_COLUMNS))


def scaled(scaler: Scaler, columns: list[str] = RFM_COLUMNS) -> list[Column]:
    return [
        (F.log1p(F.col(c).cast("double")) - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, scaler.mean, scaler.scale)
    ]


def prepare(features: DataFrame, scaler: Scaler) -> DataFrame:
    """(customer_id, z_recency, z_frequency, z_monetary): a pure projection."""
    return features.select("customer_id", *[z.alias(f"z_{c}") for c, z in zip(RFM_COLUMNS, scaled(scaler))])


def raw_matrix(features: DataFrame) -> DataFrame:
    return features.select("customer_id", *[F.col(c).cast("double").alias(f"z_{c}") for c in RFM_COLUMNS])


Z_COLUMNS = [f"z_{c}" for c in RFM_COLUMNS]


def fit_kmeans(matrix: DataFrame, k: int = 4, n_init: int = 10, seed: int = SEED, max_iter: int = 300) -> KMeansModel:
    """Best of ``n_init`` seeded runs by within-cluster cost.

    Rows are hashed and sorted by customer so that repeated runs see the same
    layout and return the same clusters.
    """
    points = (
        matrix.repartition("customer_id").sortWithinPartitions("customer_id")
        .select(array_to_vector(F.array(*Z_COLUMNS)).alias("features")).persist()
    )
    try:
        points.count()  # so that the runs, which go on side by side, find them there
        run = inheritable_thread_target(points.sparkSession)(
            lambda i: KMeans(k=k, seed=seed + i, maxIter=max_iter, initMode="k-means||").fit(points))
        with ThreadPoolExecutor(RUNS_AT_ONCE) as pool:
            fits = list(pool.map(run, range(n_init)))
        return min(fits, key=lambda m: m.summary.trainingCost)
    finally:
        points.unpersist()


def centroids_of(model: KMeansModel) -> list[tuple[float, ...]]:
    return [tuple(float(x) for x in c) for c in model.clusterCenters()]


def squared_distances(centroids: list[tuple[float, ...]], coords: list[Column]) -> Column:
    """Array of squared distances to the few centroids, in segment order."""
    return F.array(*[
        sum(((z - F.lit(float(c))) * (z - F.lit(float(c))) for z, c in zip(coords[1:], cen[1:])),
            (coords[0] - F.lit(float(cen[0]))) * (coords[0] - F.lit(float(cen[0]))))
        for cen in centroids
    ])


def nearest(centroids: list[tuple[float, ...]], coords: list[Column]) -> tuple[Column, Column]:
    """(segment id, squared distance) of the nearest centroid; the first wins a tie."""
    d = squared_distances(centroids, coords)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int"), F.array_min(d)


def assign_labels(matrix: DataFrame, centroids: list[tuple[float, ...]]) -> DataFrame:
    seg, _ = nearest(centroids, [F.col(z) for z in Z_COLUMNS])
    return matrix.select("customer_id", *Z_COLUMNS, seg.alias("segment"))


def linear_silhouette(labelled: DataFrame) -> DataFrame:
    """Mean silhouette on squared Euclidean distances, in one pass: another number than :func:`silhouette`."""
    data = labelled.select(array_to_vector(F.array(*Z_COLUMNS)).alias("features"), "segment")
    value = ClusteringEvaluator(predictionCol="segment", distanceMeasure="squaredEuclidean").evaluate(data)
    return labelled.agg(F.lit("squared_euclidean").alias("metric"), F.lit(float(value)).alias("silhouette"))


def silhouette(labelled: DataFrame) -> DataFrame:
    """Mean Euclidean silhouette with the name of its distance, exact at every size.

    Blocked products return only per (row, cluster) sums; the work is quadratic in the rows. Where that is too
    much, choose :func:`linear_silhouette`.
    """
    return silhouettes(labelled, ["segment"]).select(F.lit("euclidean").alias("metric"), F.col("segment").alias("silhouette"))


def silhouettes(labelled: DataFrame, labels: list[str]) -> DataFrame:
    """One row with the mean Euclidean silhouette of every label column: a distance is computed once for all of them."""
    tally = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("cluster")) for c in labels])
    sizes = labelled.select(F.explode(tally).alias("t")).groupBy("t.label", "t.cluster").count().filter("cluster IS NOT NULL")
    places = sorted((labels.index(r["label"]), r["cluster"], r["count"]) for r in sizes.collect())  # a few clusters a label column
    if not places:
        return labelled.agg(*[F.avg(F.when(F.col(c).isNull(), 0.0)).alias(c) for c in labels])

    def block(rows: pd.DataFrame, cols: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or cols.empty:
            return pd.DataFrame({"customer_id": [], **{c: [] for c in labels}, "dist": []})
        a, b = rows[Z_COLUMNS].to_numpy(float), cols[Z_COLUMNS].to_numpy(float)
        held = np.stack([(cols[labels[i]] == c).to_numpy() for i, c, _ in places], axis=1)
        finite, weights = np.isfinite(a).all() and np.isfinite(b).all(), held.astype(float)
        dist = np.zeros((len(a), len(places)))
        for lo in range(0, len(a), 128):
            for at in range(0, len(b), 2048):
                own, part = slice(lo, lo + 128), slice(at, at + 2048)
                total = None
                for x, y in zip(a[own].T, b[part].T):
                    square = np.subtract.outer(x, y)
                    square *= square
                    total = square if total is None else np.add(total, square, out=total)
                near = np.sqrt(total, out=total)
                dist[own] += near @ weights[part] if finite else np.stack([near[:, h].sum(1) for h in held[part].T], axis=1)
        return rows[["customer_id", *labels]].assign(dist=list(dist))

    kinds = dict(labelled.dtypes)
    columns = ", ".join(f"{c} {kinds[c]}" for c in ("customer_id", *labels))
    sums = grid_product(labelled.select("customer_id", *Z_COLUMNS, *labels), labelled.select("customer_id", *Z_COLUMNS, *labels),
                        "customer_id", "customer_id", block, f"{columns}, dist array<double>", 4096, 1 << 16)
    per = sums.groupBy("customer_id", *labels).agg(*[F.sum(F.col("dist")[i]).alias(f"_d{i}") for i in range(len(places))])

    def of(i: int) -> Column:
        own = F.col(labels[i])
        mine = [(own == F.lit(c), F.col(f"_d{n}"), F.lit(size)) for n, (j, c, size) in enumerate(places) if j == i]
        if not mine:
            return F.lit(0.0)
        size = F.coalesce(*[F.when(here, n) for here, _, n in mine])
        a = F.coalesce(*[F.when(here, F.try_divide(d, n - 1)) for here, d, n in mine])
        b = F.array_min(F.array(*[F.when(~here, d / n) for here, d, n in mine]))
        s = F.when(size == 1, F.lit(0.0)).otherwise(F.try_divide(b - a, F.greatest(a, b)))
        return F.coalesce(s, F.lit(0.0))

    return per.agg(*[F.avg(of(i)).alias(c) for i, c in enumerate(labels)])


def choose_k(features: DataFrame, k_range=range(2, 9), n_init: int = 10, measure=silhouette) -> DataFrame:
    """Inertia, silhouette (``measure``) and smallest cluster per k (one row per k; k is a short driver list)."""
    spark = features.sparkSession
    matrix = prepare(features, fit_scaler(features)).persist()
    rows = []
    try:
        models = {k: fit_kmeans(matrix, k, n_init) for k in k_range}
        labelled = {k: assign_labels(matrix, centroids_of(m)) for k, m in models.items()}
        together = {}
        if measure is silhouette and models:  # the distances do not depend on k
            segments = [nearest(centroids_of(m), [F.col(z) for z in Z_COLUMNS])[0].alias(f"k{k}") for k, m in models.items()]
            together = silhouettes(matrix.select("*", *segments), [f"k{k}" for k in models]).first().asDict()
        for k, model in models.items():
            sil = {"metric": "euclidean", "silhouette": together[f"k{k}"]} if together else measure(labelled[k]).first()
            small = labelled[k].groupBy("segment").count().agg(F.min("count")).first()[0]
            rows.append((k, float(model.summary.trainingCost), sil["metric"], float(sil["silhouette"]), int(small)))
    finally:
        matrix.unpersist()
    return spark.createDataFrame(rows, "k int, inertia double, metric string, silhouette double, smallest_cluster bigint")


def scaling_comparison(features: DataFrame, k: int = 4, n_init: int = 10, measure=silhouette) -> DataFrame:
    """Raw versus prepared input: size, mean spend and overall silhouette per cluster."""
    out = None
    for name, matrix in (("raw", raw_matrix(features)), ("log_scaled", prepare(features, fit_scaler(features)))):
        matrix = matrix.persist()
        labelled = assign_labels(matrix, centroids_of(fit_kmeans(matrix, k, n_init)))
        sil = measure(labelled).first()
        part = (
            labelled.join(features.select("customer_id", "monetary"), "customer_id").groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"), F.avg("monetary").alias("mean_spend"))
            .select(F.lit(name).alias("input"), "segment", "customers", "mean_spend", F.lit(float(sil["silhouette"])).alias("silhouette"))
        )
        matrix.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def segment_profile(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Size, median R/F/M, revenue and shares (1 dp, half to even) per segment."""
    d = features.select("customer_id", *RFM_COLUMNS).join(labels.select("customer_id", "segment"), "customer_id")
    sizes = d.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("total_revenue"))
    pairs = F.array(*[F.struct(F.concat(F.col("segment").cast("string"), F.lit(f"|{c}")).alias("g"), F.col(c).cast("double").alias("v")) for c in RFM_COLUMNS])
    med = grouped_quantiles(d.select(F.explode(pairs).alias("s")).select("s.*"), "g", "v", [0.5]).select(
        F.split("g", r"\|")[0].cast("int").alias("segment"), F.split("g", r"\|")[1].alias("c"), "quantile"
    )
    wide = med.groupBy("segment").agg(*[F.max(F.when(F.col("c") == c, F.col("quantile"))).alias(f"median_{c}") for c in RFM_COLUMNS])
    whole = Window.partitionBy(F.lit(0))  # one row per segment
    return sizes.join(wide, "segment").select(
        "segment", "customers", *[f"median_{c}" for c in RFM_COLUMNS], "total_revenue",
        F.bround(100 * F.col("customers") / F.sum("customers").over(whole), 1).alias("pct_customers"),
        F.bround(100 * F.col("total_revenue") / F.sum("total_revenue").over(whole), 1).alias("pct_revenue"),
    )


def segment_names(profile: DataFrame) -> DataFrame:
    """Name each segment from ranks inside this profile (average rank on ties).

    Recent and valuable but infrequent falls through to the last name, and two
    segments may share a name: both follow the rule as given.
    """
    whole = Window.partitionBy(F.lit(0))

    def tied_rank(column: str, descending: bool) -> Column:
        order = F.desc(column) if descending else F.asc(column)
        peers = F.count(F.lit(1)).over(Window.partitionBy(column))
        return F.rank().over(Window.orderBy(order)) + (peers - 1) / 2

    half = F.count(F.lit(1)).over(whole) / 2
    ranked = profile.withColumns({
        "recent": tied_rank("median_recency", False) <= half,
        "valuable": tied_rank("median_monetary", True) <= half,
        "frequent": tied_rank("median_frequency", True) <= half,
    })
    recent, valuable, frequent = F.col("recent"), F.col("valuable"), F.col("frequent")
    return ranked.select("segment", (
        F.when(recent & valuable & frequent, "Champions")
        .when(recent & ~valuable, "New / Low-value")
        .when(~recent & valuable, "At-risk high-value")
        .otherwise("Lapsed / One-off")
    ).alias("segment_name"))


def rfm_quintiles(features: DataFrame) -> DataFrame:
    """R (reversed), F (rank first) and M quintile scores and their total.

    ``features`` needs ``first_purchase``: equal frequencies are ordered by
    first purchase, then customer.
    """
    probs = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
    r_edges = exact_quantiles(features, "recency", probs)
    m_edges = exact_quantiles(features, "monetary", probs)
    placed = global_row_number(
        features.select("customer_id", "first_purchase", *RFM_COLUMNS),
        [F.col("frequency"), F.col("first_purchase"), F.col("customer_id")],
    )
    return placed.select(
        "customer_id",
        (6 - value_bucket(F.col("recency"), r_edges)).cast("int").alias("r_score"),
        rank_bucket(F.col("rn"), F.col("rn_total"), 5).alias("f_score"),
        value_bucket(F.col("monetary"), m_edges).cast("int").alias("m_score"),
    ).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


SCORE_RANGE = list(range(3, 16))


def segment_crosstab(named: DataFrame) -> DataFrame:
    """Segment name x score counts; the score range is fixed, so the pivot needs no discovery pass."""
    return named.groupBy("segment_name").agg(*[
        F.count(F.when(F.col("rfm_score") == s, 1)).alias(f"score_{s}") for s in SCORE_RANGE
    ])


def segment_score_summary(named: DataFrame) -> DataFrame:
    return named.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("rfm_score").alias("mean_score"),
        F.min("rfm_score").alias("min_score"), F.max("rfm_score").alias("max_score"),
    )


def ambiguous_middle(named: DataFrame, low: int = 9, high: int = 13) -> DataFrame:
    """Per score: customers, distinct segments, and the share of the base in the middle band."""
    per = named.groupBy("rfm_score", "segment").agg(F.count(F.lit(1)).alias("c")).groupBy("rfm_score").agg(
        F.sum("c").alias("customers"), F.count("segment").alias("n_segments")
    )
    whole = Window.partitionBy(F.lit(0))  # at most 13 rows
    inside = F.col("rfm_score").between(low, high)
    return per.withColumn("middle_share", F.sum(F.when(inside, F.col("customers")).otherwise(0)).over(whole) / F.sum("customers").over(whole))


def segment_assign(requests: DataFrame, scaler: Scaler, centroids: list[tuple[float, ...]], names: list[str]) -> DataFrame:
    """Score any (recency, frequency, monetary): segment, name, distance, guidance, inputs echoed.

    A pure projection over literals, so it runs unchanged on a streaming frame.
    """
    seg, d2 = nearest(centroids, scaled(scaler))
    name = F.array(*[F.lit(n) for n in names])[F.col("segment_id")]
    guide = F.lit("")
    for n, text in GUIDANCE.items():
        guide = F.when(F.col("segment_name") == n, text).otherwise(guide)
    keep = [c for c in requests.columns if c not in RFM_COLUMNS]
    return (
        requests.select(
            *keep, seg.alias("segment_id"), F.round(F.sqrt(d2), 4).alias("distance_to_centroid"),
            F.col("recency").cast("double").alias("recency"), F.col("frequency").cast("double").alias("frequency"),
            F.round(F.col("monetary").cast("double"), 2).alias("monetary"),
        )
        .withColumn("segment_name", name).withColumn("interpretation", guide)
        .select(*keep, "segment_id", "segment_name", "distance_to_centroid", "interpretation", *RFM_COLUMNS)
    )


def segment_known(ids: DataFrame, features: DataFrame, scaler: Scaler, centroids: list[tuple[float, ...]], names: list[str]) -> DataFrame:
    """Segments for stored customers; an unknown id comes back with ``found`` false."""
    known = segment_assign(features.select("customer_id", *RFM_COLUMNS), scaler, centroids, names)
    return ids.join(known, "customer_id", "left").withColumn("found", F.col("segment_id").isNotNull())


def rfm_validate(requests: DataFrame) -> DataFrame:
    """Typed request values with a ``rejected_because`` reason, null when valid."""
    num = {c: F.col(c).cast("string").try_cast("double") for c in RFM_COLUMNS}
    bad = {c: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) for c, v in num.items()}
    reason = (
        F.when(bad["recency"], "recency is not a number")
        .when(bad["frequency"], "frequency is not a number")
        .when(bad["monetary"], "monetary is not a number")
        .when(num["recency"] < 0, "recency must be >= 0")
        .when(num["frequency"] <= 0, "frequency must be > 0")
        .when(num["monetary"] <= 0, "monetary must be > 0")
    )
    keep = [c for c in requests.columns if c not in RFM_COLUMNS]
    return requests.select(*keep, *[v.alias(c) for c, v in num.items()], reason.alias("rejected_because"))


def segment_params(spark: SparkSession, scaler: Scaler, centroids: list[tuple[float, ...]], names: list[str], trained_on: str) -> DataFrame:
    """What was learned, as rows: one per (segment, feature)."""
    rows = [
        (i, names[i], pos, f, float(centroids[i][pos]), float(scaler.mean[pos]), float(scaler.scale[pos]), trained_on)
        for i in range(len(centroids)) for pos, f in enumerate(RFM_COLUMNS)
    ]
    return spark.createDataFrame(
        rows, "segment int, segment_name string, position int, feature string, centroid double, mean double, scale double, trained_on_cutoff string"
    )


def segment_params_check(features: DataFrame, model: KMeansModel, scaler: Scaler) -> DataFrame:
    """Customers on which the projection and the fitted model disagree: must be zero."""
    matrix = prepare(features, scaler)
    theirs = model.transform(matrix.withColumn("features", array_to_vector(F.array(*Z_COLUMNS))))
    mine, _ = nearest(centroids_of(model), [F.col(z) for z in Z_COLUMNS])
    return theirs.agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(mine != F.col(model.getPredictionCol())).alias("disagreements")
    )
