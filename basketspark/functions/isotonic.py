"""Monotone regression by pooling adjacent violators over score ranges, and its evaluation by interpolation.

Each range of scores is pooled on its own. Two neighbouring blocks are separated for good where every block up to the
first has a smaller mean than every block from the second on: what pools on one side never reaches the other. Between
such cuts lie independent problems, mostly of a few blocks around the borders of ranges, and each is pooled in a task.
No block goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketspark.functions.ranks import attach_by_score, running_totals, score_ranks
from basketspark.session import cut_lineage

POOLED = "segment long, lo double, hi double, total double, w double"


def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of each segment, from blocks sorted by (segment, lo): neighbours merge while the earlier mean is not smaller."""
    stack: list[tuple] = []

    def emit() -> pd.DataFrame:
        return pd.DataFrame(stack, columns=["segment", "lo", "hi", "total", "w"])

    for batch in batches:
        for segment, lo, hi, total, w in zip(batch.segment, batch.lo, batch.hi, batch.total, batch.w):
            if stack and stack[-1][0] != segment:
                yield emit()
                stack.clear()
            while stack and stack[-1][3] * w >= total * stack[-1][4]:
                _, lo, _, t, v = stack.pop()
                total, w = total + t, w + v
            stack.append((segment, lo, hi, total, w))
    yield emit()


def fit_isotonic(rows: DataFrame, y: Column, p: Column) -> DataFrame:
    """lo, hi, value: the blocks of the increasing step function of ``p`` nearest to ``y`` in squares.

    Rows whose ``y`` or ``p`` is null or NaN take no part; equal scores count together. No rows give no blocks.
    """
    y, p = y.cast("double"), p.cast("double")
    scores = rows.select(y.alias("y"), p.alias("lo")).filter("NOT isnan(y) AND NOT isnan(lo) AND y IS NOT NULL AND lo IS NOT NULL")
    merged = scores.groupBy("lo").agg(F.sum("y").alias("total"), F.count(F.lit(1)).cast("double").alias("w"))
    merged = merged.select(F.lit(0).cast("long").alias("segment"), "lo", F.col("lo").alias("hi"), "total", "w")
    ranges = merged.repartitionByRange("lo").sortWithinPartitions("lo").mapInPandas(pool, POOLED)
    ranges = cut_lineage(ranges.drop("segment").select("*", F.spark_partition_id().alias("_part"), (F.col("total") / F.col("w")).alias("mean")))
    # Means rise within a range, so a range's extremes and the next block's mean are all that a cut depends on.
    sides = ranges.groupBy("_part").agg(F.min("mean").alias("least"), F.max("mean").alias("most"))
    order = Window.orderBy("_part")
    sides = sides.select(
        "_part", F.max("most").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.min("least").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    following = F.lead("mean").over(Window.partitionBy("_part").orderBy("lo"))
    cut = F.coalesce(F.greatest("mean", "_before") < F.least(following, "_after"), F.lit(False))
    cuts = ranges.join(F.broadcast(sides), "_part").withColumn("cut", cut.cast("long"))
    numbered = running_totals(cuts.select("lo", "hi", "total", "w", "cut"), [F.col("lo")], {"cuts": F.col("cut")})
    segments = numbered.select((F.col("cuts") - F.col("cut")).alias("segment"), "lo", "hi", "total", "w")
    pooled = segments.repartition("segment").sortWithinPartitions("segment", "lo").mapInPandas(pool, POOLED)
    return cut_lineage(pooled.select("lo", "hi", (F.col("total") / F.col("w")).alias("value")))


def interpolate(blocks: DataFrame, rows: DataFrame, p: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the blocks' value at ``p``, linear between blocks, constant beyond the first and last.

    Null where ``p`` is null or NaN, or where there are no blocks.
    """
    missing = F.col(p).isNull() | F.isnan(F.col(p).cast("double"))
    per_score = score_ranks(rows.filter(~missing).select(p), p).select(p, "ties", "n_rows")
    knots = blocks.select(F.explode(F.array("lo", "hi")).alias("at"), "value").distinct()
    both = per_score.select(F.col(p).cast("double").alias("at"), F.col(p).alias("score"), "ties", "n_rows").unionByName(knots, allowMissingColumns=True)
    points = both.groupBy("at").agg(F.max("value").alias("value"), F.max("score").alias("score"), F.max("ties").alias("ties"), F.max("n_rows").alias("n_rows"))
    points = points.withColumn("knot", F.when(F.col("value").isNotNull(), F.struct("at", "value")))
    points = cut_lineage(points.repartitionByRange("at").withColumn("_part", F.spark_partition_id()))
    sides = points.groupBy("_part").agg(F.min("knot").alias("first"), F.max("knot").alias("last"))
    order = Window.orderBy("_part")
    sides = sides.select(
        "_part", F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.min("first").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    local = Window.partitionBy("_part").orderBy("at")
    below = F.coalesce(F.max("knot").over(local.rowsBetween(Window.unboundedPreceding, 0)), F.col("_before"))
    above = F.coalesce(F.min("knot").over(local.rowsBetween(0, Window.unboundedFollowing)), F.col("_after"))
    placed = points.join(F.broadcast(sides), "_part").select("score", "at", "ties", "n_rows", below.alias("b"), above.alias("a")).filter("score IS NOT NULL")
    share = (F.col("at") - F.col("b.at")) / (F.col("a.at") - F.col("b.at"))
    value = F.when(F.col("a.at") > F.col("b.at"), F.col("b.value") + share * (F.col("a.value") - F.col("b.value"))).otherwise(F.coalesce("b.value", "a.value"))
    found = placed.select(F.col("score").alias(p), value.alias(out), "ties", "n_rows")
    known = attach_by_score(rows.filter(~missing), found, p, [out]).select(*rows.columns, out)
    return known.unionByName(rows.filter(missing).withColumn(out, F.lit(None).cast("double")))
