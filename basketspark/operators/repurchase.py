"""Will a customer buy again in the label window? Baselines, model, calibration, reading."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.functions.hashing import hash_bucket
from basketspark.functions.isotonic import fit_isotonic, interpolate
from basketspark.functions.ranks import attach_by_score, grouped_quantiles, score_ranks
from basketspark.operators import boosting, metrics
from basketspark.operators.features import FEATURE_COLUMNS


def baseline_recency(features: DataFrame) -> DataFrame:
    """Minus recency as the score: recent buyers come back."""
    return features.withColumn("p", -F.col("recency").cast("double"))


def feature_medians(features: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> dict[str, float]:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    rows = grouped_quantiles(features.select(F.explode(pairs).alias("s")).select("s.*"), "feature", "value", [0.5]).collect()
    return {r["feature"]: r["quantile"] for r in rows}


def baseline_logistic(train: DataFrame, test: DataFrame, label: str = "repurchased") -> DataFrame:
    """Median-impute, standardise, logistic regression with unit ridge weight; ``p`` on the test rows."""
    medians = feature_medians(train)

    def filled(df: DataFrame) -> DataFrame:
        return df.withColumns({f"i_{c}": F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in FEATURE_COLUMNS})

    n = train.count()
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=[f"i_{c}" for c in FEATURE_COLUMNS], outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(labelCol=label, regParam=1.0 / n, maxIter=2000, standardization=False),
    ])
    fitted = pipe.fit(filled(train))
    return fitted.transform(filled(test)).withColumn("p", vector_to_array("probability")[1]).select(*test.columns, "p")


def fit_classifier(train: DataFrame, trees: int = 600):
    return boosting.fit_gbt_classifier(boosting.with_holdout(train), FEATURE_COLUMNS, F.col("repurchased"), trees)


def score(model, features: DataFrame) -> DataFrame:
    return boosting.predict_probability(model, features, FEATURE_COLUMNS)


def with_calibration_half(df: DataFrame, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Seeded half/half split of customers: reference rows fit the map, target rows are scored with it."""
    return df.withColumn("is_reference", hash_bucket(key, 2, seed) == 0)


def fit_calibration(reference: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Monotone map from score to observed rate, as blocks of scores: (lo, hi, value)."""
    return fit_isotonic(reference, F.col(y), F.col(p))


def apply_calibration(blocks: DataFrame, df: DataFrame, p: str = "p", out: str = "p_calibrated") -> DataFrame:
    """``df`` with the rate that the map gives its score, within 0 and 1; null for a null score."""
    mapped = interpolate(blocks, df, p, out)
    return mapped.withColumn(out, F.when(F.col(out).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(out))))).select(*df.columns, out)


def calibrate(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Target-half rows with ``p_calibrated`` learned on the reference half."""
    halves = with_calibration_half(scored)
    model = fit_calibration(halves.filter("is_reference"), y, p)
    return apply_calibration(model, halves.filter(~F.col("is_reference")), p).drop("is_reference")


def calibration_report(calibrated: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """All classification metrics before and after, with the gap between base rate and mean prediction."""
    parts = [
        metrics.classification_metrics(calibrated.select(F.col(y).alias("y"), F.col(c).alias("p"))).withColumn("stage", F.lit(name))
        for name, c in (("before", p), ("after", "p_calibrated"))
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("gap", F.col("base_rate") - F.col("mean_predicted")).select(
        "stage", "pr_auc", "roc_auc", "brier", "base_rate", "mean_predicted", "gap"
    )


def contender_table(contenders: dict[str, DataFrame], y: str = "y", p: str = "p") -> DataFrame:
    """One metrics row per contender, with PR-AUC relative to the base rate."""
    parts = [metrics.classification_metrics(df, y, p).withColumn("contender", F.lit(name)) for name, df in contenders.items()]
    return reduce(DataFrame.unionByName, parts).select(
        "contender", F.bround(F.try_divide(F.col("pr_auc"), F.col("base_rate")), 2).alias("vs_base"),
        "pr_auc", "roc_auc", "brier", "base_rate", "mean_predicted",
    )


def share_above_decile(last_rank: Column, n: Column) -> Column:
    """1 + floor(10 x rows scoring strictly higher / n), at most 10."""
    return F.least(F.lit(10), F.lit(1) + F.floor((n - last_rank) * 10 / n)).cast("int")


def score_decile(scored: DataFrame, p: str = "p") -> DataFrame:
    """Which tenth of the base each score falls in; equal scores share a decile."""
    per = score_ranks(scored.select(p), p)
    per = per.withColumn("decile", share_above_decile(F.col("last_rank"), F.col("n_rows")))
    return attach_by_score(scored, per, p, ["decile"]).select(*scored.columns, "decile")


def repurchase_scores(scored: DataFrame, contrib: DataFrame, as_of: str, train_rate: float, test_rate: float) -> DataFrame:
    """Probability, decile, five drivers, a reading and a caveat built from the measured base rates."""
    drivers = boosting.top_drivers(contrib, scored, FEATURE_COLUMNS)
    packed = drivers.groupBy("customer_id").agg(  # five rows per customer
        F.sort_array(F.collect_list(F.struct("rank", "feature", "value", "effect_log_odds", "direction"))).alias("top_drivers")
    )
    caveat = (
        f"Learned where {train_rate:.1%} of customers came back, applied where {test_rate:.1%} did, and not recalibrated: "
        "compare customers by rank and decile, and take the percentage as approximate."
    )
    return score_decile(scored.select("customer_id", "p")).join(packed, "customer_id").select(
        "customer_id", F.round("p", 4).alias("probability"), "decile",
        F.concat(F.format_number(F.bround(100 * F.col("p"), 0), 0), F.lit(f"% chance of purchasing within 90 days of {as_of}.")).alias("reading"),
        "top_drivers", F.lit(caveat).alias("caveat"),
    )
