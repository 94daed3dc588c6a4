"""Evaluation: classification, regression and ranking-list metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketspark.functions.ranks import attach_by_score, global_row_number, rank_bucket, score_ranks


def threshold_counts(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per distinct score: positives, rows, and both running from the lowest score up."""
    return score_ranks(scored.select(F.col(y).cast("bigint").alias("_y"), F.col(p).alias("score")), "score", {"pos": F.col("_y")}).select(
        "score", "ties", "pos", F.col("last_rank").alias("rows_cum"), "pos_cum", "n_rows", F.col("pos_cum_total").alias("n_pos"),
    )


def _ap_and_auc() -> tuple[Column, Column]:
    """Step-sum average precision and tie-aware rank AUC over ``threshold_counts`` rows."""
    tp = F.col("n_pos") - F.col("pos_cum") + F.col("pos")
    flagged = F.col("n_rows") - F.col("rows_cum") + F.col("ties")
    ap = F.sum(F.try_divide(F.col("pos"), F.col("n_pos")) * tp / flagged)
    neg = F.col("ties") - F.col("pos")
    neg_below = F.col("rows_cum") - F.col("pos_cum") - neg
    n_neg = F.col("n_rows") - F.col("n_pos")
    pairs = F.sum(F.col("pos") * (neg_below + neg / 2))
    auc = F.try_divide(pairs, F.max(F.col("n_pos").cast("double") * n_neg))
    return ap, auc


def average_precision(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return threshold_counts(scored, y, p).agg(_ap_and_auc()[0].alias("average_precision"))


def roc_auc(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return threshold_counts(scored, y, p).agg(_ap_and_auc()[1].alias("roc_auc"))


def _probability_guard(value: Column, p: str) -> Column:
    """Null unless every score is a probability."""
    return F.when((F.min(p) >= 0) & (F.max(p) <= 1), value)


def brier(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scored.agg(_probability_guard(F.avg(F.pow(F.col(p) - F.col(y), 2)), p).alias("brier"))


def base_and_mean(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scored.agg(F.avg(F.col(y).cast("double")).alias("base_rate"), _probability_guard(F.avg(p), p).alias("mean_predicted"))


def classification_metrics(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: pr_auc, roc_auc, brier, base_rate, mean_predicted.

    Brier and mean come from a sum over distinct (score, label) counts in the
    same pass as the ranking metrics.
    """
    ap, auc = _ap_and_auc()
    s = F.col("score")
    guard = (F.min(s) >= 0) & (F.max(s) <= 1)
    squared = F.sum(F.col("pos") * F.pow(1 - s, 2) + (F.col("ties") - F.col("pos")) * s * s) / F.max("n_rows")
    return threshold_counts(scored, y, p).agg(
        ap.alias("pr_auc"), auc.alias("roc_auc"), F.when(guard, squared).alias("brier"),
        (F.max("n_pos") / F.max("n_rows")).alias("base_rate"),
        F.when(guard, F.sum(s * F.col("ties")) / F.max("n_rows")).alias("mean_predicted"),
    )


def decile_rows(scored: DataFrame, p: str, tiebreak: str, n_bins: int) -> DataFrame:
    """Rows with their equal-count bucket, best score in bucket 1."""
    placed = global_row_number(scored, [F.desc(p), F.asc(tiebreak)])
    return placed.withColumn("decile", rank_bucket(F.col("rn"), F.col("rn_total"), n_bins))


def lift_table(scored: DataFrame, y: str = "y", p: str = "p", tiebreak: str = "customer_id", n_bins: int = 10) -> DataFrame:
    """Per decile: size, actual and predicted rate, lift over the base rate, cumulative capture."""
    per = decile_rows(scored.select(tiebreak, F.col(y).alias("y"), F.col(p).alias("p")), "p", tiebreak, n_bins).groupBy("decile").agg(
        F.count(F.lit(1)).alias("customers"), F.avg(F.col("y").cast("double")).alias("actual_rate"),
        F.avg("p").alias("mean_predicted"), F.sum("y").alias("repurchasers"),
    )
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # n_bins rows
    whole = Window.partitionBy(F.lit(0))
    base = F.sum("repurchasers").over(whole) / F.sum("customers").over(whole)
    return per.select(
        "decile", "customers", "actual_rate", "mean_predicted", "repurchasers",
        F.try_divide(F.col("actual_rate"), base).alias("lift"),
        F.try_divide(F.sum("repurchasers").over(upto), F.sum("repurchasers").over(whole)).alias("cumulative_capture"),
    )


def value_decile_table(scored: DataFrame, y: str = "y", p: str = "p", tiebreak: str = "customer_id", n_bins: int = 10) -> DataFrame:
    """Per predicted decile: size, mean predicted, mean and total actual, share of revenue (1 dp)."""
    per = decile_rows(scored.select(tiebreak, F.col(y).alias("y"), F.col(p).alias("p")), "p", tiebreak, n_bins).groupBy("decile").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("p").alias("predicted"), F.avg("y").alias("actual"), F.sum("y").alias("actual_total"),
    )
    whole = F.sum("actual_total").over(Window.partitionBy(F.lit(0)))
    return per.withColumn("share_of_revenue", F.bround(F.try_divide(100 * F.col("actual_total"), whole), 1))


def regression_metrics(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: MAE, RMSE, R2, Spearman, mean predicted, mean actual.

    Spearman is the correlation of average ranks and null for a constant prediction.
    """
    d = scored.select(F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"))
    basic = d.agg(
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("p"), 2))).alias("rmse"),
        (1 - F.try_divide(F.avg(F.pow(F.col("y") - F.col("p"), 2)), F.var_pop("y"))).alias("r2"),
        F.avg("p").alias("mean_pred"), F.avg("y").alias("mean_actual"),
    )
    return basic.select("mae", "rmse", "r2", spearman(d, "y", "p").scalar().alias("spearman"), "mean_pred", "mean_actual")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of two columns: collapse equal pairs, rank each side by distinct value."""
    pairs = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("w"))

    def ranked(frame: DataFrame, column: str, out: str) -> DataFrame:
        per = score_ranks(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(column), column)
        return attach_by_score(frame, per.withColumn(out, F.col("avg_rank")), column, [out])

    both = ranked(ranked(pairs, a, "ra"), b, "rb")
    w, ra, rb = F.col("w").cast("double"), F.col("ra"), F.col("rb")
    sums = both.agg(
        F.sum(w).alias("n"), F.sum(w * ra).alias("sa"), F.sum(w * rb).alias("sb"), F.sum(w * ra * ra).alias("saa"),
        F.sum(w * rb * rb).alias("sbb"), F.sum(w * ra * rb).alias("sab"),
    )
    cov = F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")
    va = F.col("n") * F.col("saa") - F.col("sa") * F.col("sa")
    vb = F.col("n") * F.col("sbb") - F.col("sb") * F.col("sb")
    return sums.select(F.when((va > 0) & (vb > 0), cov / (F.sqrt(va) * F.sqrt(vb))).alias("spearman"))


def rank_metrics(recommended: DataFrame, truth: DataFrame, k: int = 12) -> DataFrame:
    """Recall, precision, MAP and NDCG at k over every customer with a non-empty truth.

    ``recommended``: (customer_id, item_idx, rank); ``truth``: (customer_id,
    item_idx). Starts from truth, so a customer without a list scores zero.
    Precision divides by k, MAP by min(truth, k).
    """
    return rank_metrics_by(recommended.withColumn("contender", F.lit("only")), truth, ["only"], k).drop("contender")


def rank_metrics_by(recommended: DataFrame, truth: DataFrame, contenders: list[str], k: int = 12) -> DataFrame:
    """``rank_metrics`` for several tagged lists in one pass: truth is read once for all contenders."""
    key = ["contender", "customer_id"]
    listed = recommended.filter(F.col("rank") <= k).select(*key, "item_idx", "rank")
    hits = listed.join(truth.select("customer_id", "item_idx"), ["customer_id", "item_idx"])
    so_far = Window.partitionBy(*key).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)  # at most k rows
    scored = hits.withColumn("nth", F.row_number().over(so_far)).groupBy(*key).agg(
        F.count(F.lit(1)).alias("hits"), F.sum(F.col("nth") / F.col("rank")).alias("ap"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"),
    )
    sizes = truth.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_truth")).withColumn(
        "contender", F.explode(F.array(*[F.lit(c) for c in contenders]))
    )
    best = F.least(F.col("n_truth"), F.lit(k)).cast("int")
    ideal = F.aggregate(F.sequence(F.lit(1), best), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + F.lit(1)))
    got = F.coalesce(F.col("hits"), F.lit(0))
    return sizes.join(scored, key, "left").groupBy("contender").agg(
        F.avg(got / F.col("n_truth")).alias("recall"), F.avg(got / F.lit(k)).alias("precision"),
        F.avg(F.coalesce(F.col("ap") / best, F.lit(0.0))).alias("map"),
        F.avg(F.coalesce(F.col("dcg") / ideal, F.lit(0.0))).alias("ndcg"),
        F.count(F.lit(1)).alias("customers_scored"),
    )
