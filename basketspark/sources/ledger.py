"""Reading, unioning, normalising and caching the raw ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source header -> ledger column.
HEADER_NAMES = {
    "Invoice": "invoice",
    "InvoiceNo": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "UnitPrice": "price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}

PRICE_TYPE = "decimal(12,4)"
MONEY_TYPE = "decimal(18,4)"

LEDGER_SCHEMA = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("price", T.DecimalType(12, 4)),
    T.StructField("customer_id", T.LongType()),
    T.StructField("country", T.StringType()),
])
LEDGER_COLUMNS = LEDGER_SCHEMA.fieldNames()
TEXT_COLUMNS = ["invoice", "stock_code", "description", "country"]
BLANKS = " \t\r\n\f\x0b"


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw CSV files as text columns under their own headers; types come from ``normalise``."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(paths)


def union_sheets(sheets: list[DataFrame]) -> DataFrame:
    """One ledger from yearly sheets, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), sheets)


def _number(name: str):
    """Text to double, unparsable or non-finite text to null."""
    x = F.btrim(F.col(name).cast("string"), F.lit(BLANKS)).try_cast("double")
    return F.when(~F.isnan(x), x)


def normalise(df: DataFrame) -> DataFrame:
    """Rename variant headers, insist on all eight columns, strip text, coerce types.

    Unparsable quantities, prices, ids and dates become null and are removed
    (and counted) by cleaning. So do numbers the ledger's types cannot hold:
    quantities are whole units, and a price must fit its decimal type without
    changing by more than a millionth. None is cut to another number;
    :func:`rejected_numbers` names how many there are.
    """
    df = df.withColumnsRenamed({k: v for k, v in HEADER_NAMES.items() if k in df.columns})
    missing = [c for c in LEDGER_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"ledger is missing expected columns: {missing}; got {df.columns}")
    text = {c: F.btrim(F.col(c).cast("string"), F.lit(BLANKS)) for c in TEXT_COLUMNS}
    stamp = F.btrim(F.col("invoice_date").cast("string"), F.lit(BLANKS))
    customer = F.btrim(F.col("customer_id").cast("string"), F.lit(BLANKS))
    return df.select(
        text["invoice"].alias("invoice"),
        text["stock_code"].alias("stock_code"),
        text["description"].alias("description"),
        _whole_quantity().alias("quantity"),
        F.coalesce(
            stamp.try_cast("timestamp_ntz"),
            F.try_to_timestamp(stamp, F.lit("M/d/yyyy H:mm")).cast("timestamp_ntz"),
        ).alias("invoice_date"),
        _exact_price().alias("price"),
        F.coalesce(customer.try_cast("bigint"), _number("customer_id").try_cast("bigint")).alias("customer_id"),
        text["country"].alias("country"),
    )


def _whole_quantity():
    q = _number("quantity")
    return F.when(q == F.floor(q), q.try_cast("int"))


def _exact_price():
    p, kept = _number("price"), F.btrim(F.col("price").cast("string"), F.lit(BLANKS)).try_cast(PRICE_TYPE)
    return F.when(F.abs(kept.cast("double") - p) <= 1e-6 * F.abs(p), kept)


def rejected_numbers(df: DataFrame) -> DataFrame:
    """One row: how many quantities and prices of a raw ledger are numbers that ``normalise`` cannot keep as they are."""
    df = df.withColumnsRenamed({k: v for k, v in HEADER_NAMES.items() if k in df.columns})
    return df.agg(
        F.count_if(_number("quantity").isNotNull() & _whole_quantity().isNull()).alias("rejected_quantities"),
        F.count_if(_number("price").isNotNull() & _exact_price().isNull()).alias("rejected_prices"),
    )


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem.getCondition()) or "UNABLE_TO_INFER" in str(problem.getCondition()):
            return None
        raise


def load_cached(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """The cached parquet table, building and writing it when absent or forced."""
    if not force:
        cached = read_if_present(spark, path)
        if cached is not None:
            return cached
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
