"""Serving tables: what is written once per as-of date and looked up by join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.functions.ranks import global_row_number
from basketspark.operators.features import FEATURE_COLUMNS
from basketspark.operators.split import Snapshot


def customer_serving_table(features: DataFrame, snap: Snapshot) -> DataFrame:
    """Ids, thirteen features and the date they were measured (recency, frequency, monetary among them)."""
    return features.select("customer_id", *FEATURE_COLUMNS, F.lit(snap.cutoff.date()).alias("as_of"))


def clv_serving_table(predicted: DataFrame, snap: Snapshot) -> DataFrame:
    return predicted.select("customer_id", F.col("p").alias("expected_spend"), "p_alive", F.lit(snap.cutoff.date()).alias("as_of"))


def shap_serving_table(contrib: DataFrame, snap: Snapshot) -> DataFrame:
    return contrib.select("customer_id", "contributions", "base_value", F.lit(snap.cutoff.date()).alias("as_of"))


def recs_serving_table(listed: DataFrame, owned: DataFrame, snap: Snapshot) -> DataFrame:
    """One row per (customer, rank): item and whether it was bought before."""
    flag = owned.select("customer_id", "item_idx", F.lit(True).alias("bought_before"))
    return listed.join(flag, ["customer_id", "item_idx"], "left").select(
        "customer_id", "rank", "item_idx", F.coalesce("bought_before", F.lit(False)).alias("bought_before"), F.lit(snap.cutoff.date()).alias("as_of")
    )


def metrics_long(table: DataFrame, model: str, trained_on: str, scored_as_of: str) -> DataFrame:
    """(model, contender, metric, value, dates) from a table with one row per contender."""
    numeric = [c for c, t in table.dtypes if t in ("double", "bigint", "int")]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numeric])
    return table.select(F.lit(model).alias("model"), "contender", F.explode(pairs).alias("m")).select(
        "model", "contender", "m.metric", "m.value", F.lit(trained_on).alias("trained_on_cutoff"), F.lit(scored_as_of).alias("scored_as_of")
    )


def metrics_table(tables: dict[str, DataFrame], trained_on: str, scored_as_of: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [metrics_long(t, m, trained_on, scored_as_of) for m, t in tables.items()])


def write_serving(table: DataFrame, path: str) -> DataFrame:
    """Write partitioned by as-of date when the table has one, and read back."""
    writer = table.write.mode("overwrite")
    if "as_of" in table.columns:
        writer = writer.partitionBy("as_of")
    writer.parquet(path)
    return table.sparkSession.read.parquet(path)


DEEP_OFFSET = 100_000


def customer_page(features: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """One page of customers by id, at most 100 rows, with the total on every row.

    A shallow page is a top-k sort. A deep one would make every task keep
    ``offset`` rows, so it is cut by global row number instead.
    """
    limit = min(limit, 100)
    total = features.agg(F.count(F.lit(1))).scalar()
    columns = ["customer_id", "recency", "frequency", F.round("monetary", 2).alias("monetary")]
    if offset > DEEP_OFFSET:
        placed = global_row_number(features.select(*columns), [F.col("customer_id")])
        page = placed.filter((F.col("rn") > offset) & (F.col("rn") <= offset + limit)).drop("rn", "rn_total")
    else:
        page = features.select(*columns).orderBy("customer_id").offset(offset).limit(limit)
    return page.withColumn("total", total)
