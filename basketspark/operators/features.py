"""One row per customer: thirteen features known at the cutoff, and the labels behind them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.functions.ranks import grouped_quantiles
from basketspark.operators.clean import return_features
from basketspark.operators.split import WINDOW_DAYS, moment

# Feature order (position-significant).
FEATURE_COLUMNS = [
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
    "tenure",
    "n_products",
    "n_items",
    "avg_basket_value",
    "avg_days_between_orders",
    "spend_last_90d",
    "orders_last_90d",
    "n_returns",
    "returned_value",
]
RFM_COLUMNS = ["recency", "frequency", "monetary"]
RECENT_DAYS = 90


def days_before(cutoff: datetime, column: str | Column) -> Column:
    """Whole elapsed 24-hour periods from ``column`` to the cutoff."""
    column = F.col(column) if isinstance(column, str) else column
    return F.timestamp_diff("DAY", column, moment(cutoff))


def customer_rollup(purchases: DataFrame, cutoff: datetime, window_end: datetime | None = None) -> DataFrame:
    """Order-grain then customer-grain aggregation of rows before the cutoff.

    Distinct orders are counted by aggregating to (customer, invoice) first:
    a customer with a third of all rows is spread over many tasks by invoice
    and arrives at the final aggregate already summed. With ``window_end`` the
    same pass also sums the label window.
    """
    end = window_end or cutoff
    at, money = F.col("invoice_date"), F.col("line_total")
    past = at < moment(cutoff)
    recent = past & (at >= moment(cutoff - timedelta(days=RECENT_DAYS)))
    orders = purchases.filter(at < moment(end)).groupBy("customer_id", "invoice").agg(
        F.count(F.when(past, 1)).alias("lines"),
        F.sum(F.when(past, money)).alias("value"),
        F.sum(F.when(past, F.col("quantity")).cast("bigint")).alias("units"),
        F.min(F.when(past, at)).alias("first_at"),
        F.max(F.when(past, at)).alias("last_at"),
        F.count(F.when(recent, 1)).alias("recent_lines"),
        F.sum(F.when(recent, money)).alias("recent_value"),
        F.sum(F.when(~past, money)).alias("future"),
    )
    return orders.groupBy("customer_id").agg(
        F.count(F.when(F.col("lines") > 0, 1)).alias("frequency"),
        F.sum("value").cast("double").alias("monetary"),
        F.sum("units").alias("n_items"),
        F.min("first_at").alias("first_purchase"),
        F.max("last_at").alias("last_purchase"),
        F.count(F.when(F.col("recent_lines") > 0, 1)).alias("orders_last_90d"),
        F.coalesce(F.sum("recent_value"), F.lit(0)).cast("double").alias("spend_last_90d"),
        F.coalesce(F.sum("future"), F.lit(0)).cast("double").alias("future_spend"),
    ).filter("frequency > 0")


def product_breadth(purchases: DataFrame, cutoff: datetime) -> DataFrame:
    return (
        purchases.filter(F.col("invoice_date") < moment(cutoff)).select("customer_id", "stock_code").distinct()
        .groupBy("customer_id").agg(F.count("stock_code").alias("n_products"))
    )


def recency_tenure(rollup: DataFrame, cutoff: datetime) -> DataFrame:
    return rollup.withColumns({
        "recency": days_before(cutoff, "last_purchase"), "tenure": days_before(cutoff, "first_purchase"),
    })


def order_ratios(df: DataFrame) -> DataFrame:
    """Money per order and units per order."""
    return df.withColumns({
        "avg_order_value": F.col("monetary") / F.col("frequency"),
        "avg_basket_value": F.col("n_items") / F.col("frequency"),
    })


def order_gap(df: DataFrame) -> DataFrame:
    """Tenure over the number of gaps; null for single-order customers."""
    gaps = F.col("frequency") - 1
    return df.withColumn("avg_days_between_orders", F.when(gaps > 0, F.col("tenure") / gaps))


def with_returns(df: DataFrame, returns: DataFrame, cutoff: datetime) -> DataFrame:
    return df.join(return_features(returns, cutoff), "customer_id", "left").withColumns({
        "n_returns": F.coalesce("n_returns", F.lit(0)), "returned_value": F.coalesce("returned_value", F.lit(0.0)),
    })


def customer_features(purchases: DataFrame, returns: DataFrame, cutoff: datetime,
                      window_days: int | None = None, keep_first_purchase: bool = False) -> DataFrame:
    """All thirteen features per eligible customer, in fixed order.

    With ``window_days`` the labels (``repurchased``, ``future_spend``) come
    out of the same pass. All three inputs end hashed on customer_id, so the
    final joins add no shuffle of their own.
    """
    end = cutoff + timedelta(days=window_days) if window_days else None
    rolled = recency_tenure(customer_rollup(purchases, cutoff, end), cutoff)
    full = with_returns(
        order_gap(order_ratios(rolled.join(product_breadth(purchases, cutoff), "customer_id"))), returns, cutoff
    )
    extra = ["first_purchase"] if keep_first_purchase else []
    if window_days:
        full = full.withColumn("repurchased", (F.col("future_spend") > 0).cast("int"))
        extra += ["repurchased", "future_spend"]
    return full.select("customer_id", *FEATURE_COLUMNS, *extra)


def feature_label_table(purchases: DataFrame, returns: DataFrame, cutoff: datetime,
                        window_days: int = WINDOW_DAYS, target: str | None = None) -> DataFrame:
    """Features with their target in the same row, so nothing has to be aligned later."""
    table = customer_features(purchases, returns, cutoff, window_days)
    targets = ["repurchased", "future_spend"] if target is None else [target]
    return table.select("customer_id", *FEATURE_COLUMNS, *targets)


def feature_summary(features: DataFrame) -> DataFrame:
    """Mean, median, min, max and null count per feature."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in FEATURE_COLUMNS]
    long = features.select(F.explode(F.array(*pairs)).alias("s")).select("s.*")
    stats = long.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
    )
    medians = grouped_quantiles(long, "feature", "value", [0.5]).select("feature", F.col("quantile").alias("median"))
    return stats.join(medians, "feature", "left").select("feature", "mean", "median", "min", "max", "n_missing")


def target_profile(labels: DataFrame, name: str) -> DataFrame:
    """Count, zero share, mean, median, max and bias-corrected skew of future spend."""
    y = F.col("future_spend")
    stats = labels.agg(
        F.count(y).alias("n"), F.avg((y == 0).cast("double")).alias("zero_share"), F.avg(y).alias("mean"),
        F.max(y).alias("max"), F.skewness(y).alias("g1"),
    )
    n = F.col("n").cast("double")
    median = grouped_quantiles(labels.select(F.lit(name).alias("snapshot"), "future_spend"), "snapshot", "future_spend", [0.5])
    return stats.withColumn("snapshot", F.lit(name)).join(median.select("snapshot", F.col("quantile").alias("median")), "snapshot").select(
        "snapshot", "n", "zero_share", "mean", "median", "max",
        F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
    )
