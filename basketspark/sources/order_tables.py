"""A ledger derived from order, line, part and customer tables.

Gives every ledger case a rule: cancellations, postage lines, malformed codes,
anonymous orders, zero prices, exact duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.sources.ledger import PRICE_TYPE


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ledger_tables(spark: SparkSession, folder: str) -> list[DataFrame]:
    """What :func:`ledger_from_orders` reads: lines, orders, parts, buyers, nations."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    buyers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    return [lines, orders, parts, buyers, nations]


def ledger_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem x orders x part x customer x nation as ledger rows. Catalyst picks the join types.

    Buyers are joined to the orders, before there is a row a line; parts, whose names are the widest column, come last.
    """
    lines, orders, parts, buyers, nations = ledger_tables(spark, folder)
    placed = orders.join(buyers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    key = F.col("l_partkey")
    cancelled = (F.col("l_returnflag") == "R") & (key % 4 == 0)
    code = (
        F.when(key % 40 == 0, F.lit("POST"))
        .when(key % 41 == 0, F.concat(F.lit("X"), key.cast("string")))
        .otherwise(F.concat(F.lpad(key.cast("string"), 5, "0"), F.when(key % 7 == 0, "A").otherwise("")))
    )
    units = F.col("l_quantity").cast("int")
    # Orders with key % 50 = 1 are entered twice, so exact duplicate rows exist.
    copies = F.when(F.col("o_orderkey") % 50 == 1, 2).otherwise(1)
    return joined.select(
        F.concat(F.when(cancelled, "C").otherwise(""), F.col("o_orderkey").cast("string")).alias("invoice"),
        code.alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(cancelled, -units).otherwise(units).alias("quantity"),
        F.expr("timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate)").cast("timestamp_ntz").alias("invoice_date"),
        F.when(key % 97 == 0, F.lit(0)).otherwise(F.col("p_retailprice")).cast("decimal(12,2)").cast(PRICE_TYPE).alias("price"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("country"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def vectors_from_embeddings(spark: SparkSession, folder: str, items: DataFrame) -> DataFrame:
    """A ready-made vector per indexed item: embedding number item_idx mod (number of embeddings)."""
    stored = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    n = stored.count()
    return items.select("item_idx", "stock_code", (F.col("item_idx") % n).cast("bigint").alias("vec_id")).join(stored, "vec_id").select(
        "item_idx", "stock_code", F.col("embedding").alias("raw")
    )
