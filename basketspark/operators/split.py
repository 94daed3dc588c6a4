"""Point-in-time snapshots: what was known before a cutoff, and what happened after it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_DAYS = 90


def moment(t: datetime) -> Column:
    return F.lit(t).cast("timestamp_ntz")


def derive_cutoffs(last_date: datetime, window_days: int = WINDOW_DAYS) -> tuple[datetime, datetime]:
    """(train, test): midnight of the last day minus two windows and minus one."""
    midnight = datetime(last_date.year, last_date.month, last_date.day)
    test = midnight - timedelta(days=window_days)
    return test - timedelta(days=window_days), test


def cutoff_table(purchases: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Last date and both cutoffs as one row."""
    day = F.col("last_date").cast("date").cast("timestamp_ntz")
    return purchases.agg(F.max("invoice_date").alias("last_date")).select(
        "last_date",
        (day - F.expr(f"INTERVAL {2 * window_days} DAYS")).alias("train_cutoff"),
        (day - F.expr(f"INTERVAL {window_days} DAYS")).alias("test_cutoff"),
    )


@dataclass
class Snapshot:
    """One point-in-time view. ``observation`` never holds a row at or after ``cutoff``."""

    name: str
    cutoff: datetime
    window_days: int
    observation: DataFrame
    future: DataFrame
    purchases: DataFrame

    @property
    def window_end(self) -> datetime:
        return self.cutoff + timedelta(days=self.window_days)

    @property
    def labels(self) -> DataFrame:
        return snapshot_labels(self.purchases, self.cutoff, self.window_days)


def make_snapshot(purchases: DataFrame, cutoff: datetime | str, window_days: int = WINDOW_DAYS, name: str = "snapshot") -> Snapshot:
    if isinstance(cutoff, str):
        cutoff = datetime.fromisoformat(cutoff)
    end = cutoff + timedelta(days=window_days)
    return Snapshot(
        name, cutoff, window_days,
        observation=purchases.filter(F.col("invoice_date") < moment(cutoff)),
        future=purchases.filter((F.col("invoice_date") >= moment(cutoff)) & (F.col("invoice_date") < moment(end))),
        purchases=purchases,
    )


def train_test_snapshots(purchases: DataFrame, window_days: int = WINDOW_DAYS) -> tuple[Snapshot, Snapshot]:
    """Two out-of-time snapshots from the data's own last date (one small aggregate, then literals)."""
    last = purchases.agg(F.max("invoice_date").alias("m")).first()["m"]
    train, test = derive_cutoffs(last, window_days)
    return make_snapshot(purchases, train, window_days, "train"), make_snapshot(purchases, test, window_days, "test")


def eligible_customers(snap: Snapshot) -> DataFrame:
    return snap.observation.select("customer_id").distinct()


def snapshot_labels(purchases: DataFrame, cutoff: datetime, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Every customer seen before the cutoff with spend in the label window, zero when absent.

    One aggregate over rows before the window's end: the "seen" flag and the
    future sum share a single shuffle, so no join is needed.
    """
    end = cutoff + timedelta(days=window_days)
    at = F.col("invoice_date")
    return (
        purchases.filter(at < moment(end)).groupBy("customer_id")
        .agg(
            F.bool_or(at < moment(cutoff)).alias("seen"),
            F.sum(F.when(at >= moment(cutoff), F.col("line_total"))).alias("future"),
        )
        .filter("seen")
        .select(
            "customer_id",
            (F.coalesce(F.col("future"), F.lit(0)) > 0).cast("int").alias("repurchased"),
            F.coalesce(F.col("future"), F.lit(0)).cast("double").alias("future_spend"),
        )
    )


def snapshot_summary(snap: Snapshot) -> DataFrame:
    """Customers, observed rows and repurchase rate of one snapshot, from one aggregate."""
    at = F.col("invoice_date")
    per_customer = (
        snap.purchases.filter(at < moment(snap.window_end)).groupBy("customer_id")
        .agg(
            F.count(F.when(at < moment(snap.cutoff), 1)).alias("past_rows"),
            F.sum(F.when(at >= moment(snap.cutoff), F.col("line_total"))).alias("future"),
        )
        .filter("past_rows > 0")
    )
    return per_customer.agg(
        F.sum("past_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_customers"),
        F.avg((F.coalesce(F.col("future"), F.lit(0)) > 0).cast("double")).alias("repurchase_rate"),
    ).select(F.lit(snap.name).alias("snapshot"), moment(snap.cutoff).alias("cutoff"), "n_rows", "n_customers", "repurchase_rate")


def population_overlap(purchases: DataFrame, train: Snapshot, test: Snapshot) -> DataFrame:
    """Customers known to both snapshots, first seen between the cutoffs, and first seen after the later one."""
    first = purchases.groupBy("customer_id").agg(F.min("invoice_date").alias("first"))
    f = F.col("first")
    return first.agg(
        F.count(F.when(f < moment(train.cutoff), 1)).alias("in_both"),
        F.count(F.when((f >= moment(train.cutoff)) & (f < moment(test.cutoff)), 1)).alias("joined_between"),
        F.count(F.when(f >= moment(test.cutoff), 1)).alias("first_bought_after"),
    )


def customer_timeline(snap: Snapshot, customers: DataFrame | None = None, keep_past: int = 8) -> DataFrame:
    """One row per order tagged past / label / beyond; of the past only the last ``keep_past`` orders.

    ``n_past`` counts all past orders, so what was cut is visible. ``customers``
    restricts the output to given ids.
    """
    rows = snap.purchases if customers is None else snap.purchases.join(customers, "customer_id", "left_semi")
    orders = (
        rows.groupBy("customer_id", F.to_date("invoice_date").alias("order_date"), "invoice")
        .agg(F.sum("line_total").cast("double").alias("order_value"))
    )
    day = F.col("order_date").cast("timestamp_ntz")
    tagged = orders.withColumn(
        "period",
        F.when(day < moment(snap.cutoff), "past").when(day < moment(snap.window_end), "label").otherwise("beyond"),
    )
    # Ranking inside (customer, period) with a pushed-down limit keeps 8 rows per group before the sort.
    latest = Window.partitionBy("customer_id").orderBy(F.desc("order_date"), F.desc("invoice"))
    past = tagged.filter("period = 'past'").withColumn("rn", F.row_number().over(latest)).filter(F.col("rn") <= keep_past).drop("rn")
    counts = tagged.filter("period = 'past'").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_past"))
    return (
        past.unionByName(tagged.filter("period <> 'past'")).join(counts, "customer_id", "left")
        .withColumn("n_past", F.coalesce("n_past", F.lit(0)))
        .select("customer_id", "order_date", "invoice", "order_value", "period", "n_past")
    )


def timeline_candidates(snap: Snapshot, wanted: int = 1, low: int = 4, high: int = 12) -> DataFrame:
    """Customers with ``low``..``high`` past orders and the wanted repurchase label."""
    orders = (
        snap.observation.select("customer_id", "invoice").distinct()
        .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))
        .filter(F.col("n_orders").between(low, high))
    )
    return orders.join(snap.labels.filter(F.col("repurchased") == wanted), "customer_id").select(
        "customer_id", "n_orders", "repurchased", "future_spend"
    )
