"""Ledger cleaning: purchases, returns and an auditable report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketspark.session import shuffles_released
from basketspark.sources.ledger import LEDGER_COLUMNS, MONEY_TYPE, read_if_present

# Stock codes that are not products, compared in upper case.
NON_PRODUCT_CODES = [
    "POST",
    "DOT",
    "C2",
    "M",
    "BANK CHARGES",
    "B",
    "S",
    "D",
    "CRUK",
    "PADS",
    "TEST001",
    "TEST002",
    "AMAZONFEE",
    "GIFT_0001_10",
    "GIFT_0001_20",
    "GIFT_0001_30",
    "GIFT_0001_40",
    "GIFT_0001_50",
]

# Report labels, in step order.
STEP_LABELS = [
    "raw",
    "drop exact duplicates",
    "drop null date/qty/price",
    "drop non-product codes",
    "drop malformed stock codes",
    "drop rows with no customer",
    "split off returns/cancellations",
    "drop non-positive price",
]

PRODUCT_CODE_PATTERN = r"^\d{5}\w*$"


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed; nulls compare equal."""
    return df.select(*LEDGER_COLUMNS).dropDuplicates()


def has_required(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["invoice_date", "quantity", "price"])


def is_product_code() -> Column:
    """Not an administrative code. A null code passes here and fails the format rule."""
    return ~F.coalesce(F.upper("stock_code").isin(NON_PRODUCT_CODES), F.lit(False))


def is_well_formed() -> Column:
    return F.coalesce(F.col("stock_code").rlike(PRODUCT_CODE_PATTERN), F.lit(False))


def is_return() -> Column:
    """Three-valued on purpose: a null invoice with positive quantity is on neither side."""
    return F.upper("invoice").startswith("C") | (F.col("quantity") <= 0)


def line_total() -> Column:
    return (F.col("quantity") * F.col("price")).cast(MONEY_TYPE)


def kept_lines(raw: DataFrame) -> DataFrame:
    """Known-customer product lines of both sides, copies included."""
    returned = is_return()
    return raw.select(*LEDGER_COLUMNS).filter(
        F.col("invoice_date").isNotNull() & F.col("quantity").isNotNull() & F.col("price").isNotNull()
        & is_product_code() & is_well_formed() & F.col("customer_id").isNotNull()
        & (returned | (F.col("price") > 0))
    )


def valid_lines(raw: DataFrame) -> DataFrame:
    """Known-customer product lines of both sides, deduplicated, with ``is_return`` and ``line_total``.

    Row filters commute with exact deduplication, so they run first and reach
    the scan; only surviving rows are shuffled to be deduplicated.
    """
    return kept_lines(raw).dropDuplicates().withColumns({"is_return": is_return(), "line_total": line_total()})


def purchases_of(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("is_return")).select(*LEDGER_COLUMNS, "line_total")


def returns_of(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("is_return")).select(*LEDGER_COLUMNS, "line_total")


def clean_transactions(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(purchases, returns, report), all lazy."""
    lines = valid_lines(raw)
    return purchases_of(lines), returns_of(lines), cleaning_report(raw)


def purchases_sorted(purchases: DataFrame) -> DataFrame:
    """Purchases in date order. Internal consumers never need the order."""
    return purchases.orderBy("invoice_date", "invoice", "stock_code")


def first_failed_step() -> Column:
    """Step number (1-based, as in STEP_LABELS) that removes a distinct row; null when it survives."""
    return (
        F.when(F.col("invoice_date").isNull() | F.col("quantity").isNull() | F.col("price").isNull(), 3)
        .when(~is_product_code(), 4)
        .when(~is_well_formed(), 5)
        .when(F.col("customer_id").isNull(), 6)
        .when(F.coalesce(is_return(), F.lit(True)), 7)
        .when(F.col("price") <= 0, 8)
    )


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Rows before, after and removed per step, from one pass over the ledger.

    Copies of a row collapse to (row, copies) with map-side combining; each
    distinct row is tagged with the first step that removes it.
    """
    distinct_rows = raw.select(*LEDGER_COLUMNS).groupBy(*LEDGER_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    tally = (
        distinct_rows.select(first_failed_step().alias("step_no"), "copies")
        .groupBy("step_no").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"))
    )
    totals = tally.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_raw"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_distinct"),
        *[F.coalesce(F.sum(F.when(F.col("step_no") == s, F.col("rows"))), F.lit(0)).alias(f"r{s}") for s in range(3, 9)],
    )
    removed = [F.lit(0), F.col("n_raw") - F.col("n_distinct"), *[F.col(f"r{s}") for s in range(3, 9)]]
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(label).alias("step"), removed[i].cast("bigint").alias("removed"))
        for i, label in enumerate(STEP_LABELS)
    ])
    running = Window.orderBy("step_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        totals.select("n_raw", F.explode(steps).alias("s")).select("n_raw", "s.*")
        .withColumn("rows_after", F.col("n_raw") - F.sum("removed").over(running))
        .select("step_no", "step", (F.col("rows_after") + F.col("removed")).alias("rows_before"), "rows_after", "removed")
    )


def return_features(returns: DataFrame, as_of: datetime) -> DataFrame:
    """Distinct return invoices and returned value per customer, strictly before ``as_of``."""
    per_invoice = (
        returns.filter(F.col("invoice_date") < F.lit(as_of).cast("timestamp_ntz"))
        .groupBy("customer_id", "invoice").agg(F.sum("line_total").alias("value"))
    )
    return per_invoice.groupBy("customer_id").agg(
        F.count("invoice").alias("n_returns"), (-F.sum("value")).cast("double").alias("returned_value")
    )


def clean_summary(purchases: DataFrame) -> DataFrame:
    """Rows, customers, products and date range; distinct keys are counted after pre-aggregation."""
    customers = purchases.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows"), F.min("invoice_date").alias("lo"), F.max("invoice_date").alias("hi"))
    head = customers.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_customers"),
        F.min("lo").alias("first_date"), F.max("hi").alias("last_date"),
    )
    products = purchases.select("stock_code").distinct().agg(F.count("stock_code").alias("n_products"))
    return head.select("n_rows", "n_customers", products.scalar().alias("n_products"), "first_date", "last_date")


def laid_out(raw: DataFrame) -> DataFrame:
    """Both sides, deduplicated and sorted by date within ranges. Copies of a row lie in the same range, so the ledger is shuffled once for both."""
    return (
        kept_lines(raw)
        .withColumn("side", F.when(is_return(), "returns").otherwise("purchases"))
        .repartitionByRange("side", "invoice_date", "invoice", "stock_code").dropDuplicates()
        .withColumn("line_total", line_total()).select(*LEDGER_COLUMNS, "line_total", "side")
        .sortWithinPartitions("side", "invoice_date", "invoice", "stock_code")
    )


def write_clean_tables(raw: DataFrame, path: str) -> None:
    """Both sides in one pass, laid out by date so that date filters skip files and row groups."""
    with shuffles_released(raw.sparkSession):
        laid_out(raw).write.mode("overwrite").partitionBy("side").parquet(path)


def read_purchases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/side=purchases")


def load_returns(spark: SparkSession, path: str, raw: DataFrame) -> DataFrame:
    """The written returns side, building both sides when neither is there.

    A ledger without any return writes no returns folder; that is an empty table.
    """
    if read_if_present(spark, path) is None:
        write_clean_tables(raw, path)
    found = read_if_present(spark, f"{path}/side=returns")
    if found is not None:
        return found
    return read_purchases(spark, path).limit(0)
