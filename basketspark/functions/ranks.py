"""Global ranks, running totals, exact quantiles and rank buckets without a one-task window.

An un-partitioned window sends every row to one task. Here rows are range
partitioned on a total order, each range is summed on its own, and the range
totals (one row per partition) become offsets. The range-partitioned frame is
written with its partition number as a column, so both passes read one fixed
layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketspark.session import cut_lineage


def running_totals(df: DataFrame, order: list[Column | str], measures: dict[str, Column]) -> DataFrame:
    """Inclusive running sum of each measure in ``order``, plus ``<name>_total``.

    ``order`` must end in a unique key so that equal values can be split over
    ranges and the result does not depend on the layout.
    """
    staged = cut_lineage(
        df.select("*", *[m.alias(f"_m_{k}") for k, m in measures.items()])
        .repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    per_part = staged.groupBy("_part").agg(*[F.sum(f"_m_{k}").alias(f"_s_{k}") for k in measures])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = per_part.select(
        "_part",
        *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in measures],
        *[F.sum(f"_s_{k}").over(everything).alias(f"{k}_total") for k in measures],
    )
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return staged.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        *[(F.sum(f"_m_{k}").over(local) + F.col(f"_o_{k}")).alias(k) for k in measures],
        *[F.col(f"{k}_total") for k in measures],
    )


def global_row_number(df: DataFrame, order: list[Column | str], rn: str = "rn") -> DataFrame:
    """1-based position of every row in a total order, and the row count as ``<rn>_total``."""
    return running_totals(df, order, {rn: F.lit(1).cast("bigint")})


def rank_bucket(rn: Column, n: Column, k: int) -> Column:
    """Equal-count bucket 1..k of position ``rn`` out of ``n``: ceil((rn-1)k/(n-1)), at least 1."""
    span = F.greatest(n - 1, F.lit(1))
    up = F.floor(((rn - 1) * F.lit(k) + span - 1) / span)
    return F.greatest(F.lit(1), up).cast("int")


def score_ranks(df: DataFrame, score: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct score with its count and its first, last and average rank (ascending).

    Equal scores are collapsed before anything is ordered, so a score shared by
    a third of the rows is a single row here. ``extra`` adds further sums,
    returned as ``<name>`` (this score) and ``<name>_cum`` (inclusive, ascending).
    """
    extra = extra or {}
    per_score = df.filter(F.col(score).isNotNull()).groupBy(score).agg(
        F.count(F.lit(1)).alias("ties"), *[F.sum(c).alias(k) for k, c in extra.items()]
    )
    out = running_totals(per_score, [F.col(score)], {"last_rank": F.col("ties"), **{f"{k}_cum": F.col(k) for k in extra}})
    return out.withColumns({
        "first_rank": F.col("last_rank") - F.col("ties") + 1,
        "avg_rank": F.col("last_rank") - (F.col("ties") - 1) / 2,
    }).withColumnRenamed("last_rank_total", "n_rows")


HOT_SHARE = 200


def attach_by_score(df: DataFrame, per_score: DataFrame, score: str, columns: list[str]) -> DataFrame:
    """Join per-score values back to rows, with heavy scores handled apart.

    A score holding more than 1/200 of all rows is hot; by counting there are
    fewer than 200 of them, so that side is always safe to broadcast. What is
    left has no heavy key and joins by shuffle.
    """
    hot_rule = F.col("ties") * HOT_SHARE > F.col("n_rows")
    hot = per_score.filter(hot_rule).select(score, *columns)
    cold = per_score.filter(~hot_rule).select(score, *columns)
    return (
        df.join(F.broadcast(hot), score)
        .unionByName(df.join(F.broadcast(hot.select(score)), score, "left_anti").join(cold, score))
    )


def grouped_quantiles(df: DataFrame, group: str, value: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles per group: (group, prob, quantile). Nulls are skipped.

    For a modest number of groups (features, segments) of any size. Values are
    collapsed to (group, value, count) and located by running position, so no
    group is ever held by one task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))
    placed = running_totals(counts, [F.col(group), F.col(value)], {"_cum": F.col("_c")})
    spans = placed.groupBy(group).agg(
        F.sum("_c").alias("_n"), F.min(F.col("_cum") - F.col("_c")).alias("_start")
    )
    wanted = spans.select(
        group, "_n", "_start", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    ).withColumn("_pos", F.col("prob") * (F.col("_n") - 1))
    first = F.col("_cum") - F.col("_c") - F.col("_start")
    last = F.col("_cum") - F.col("_start") - 1

    def at(edge: Column) -> Column:
        return F.max(F.when((edge >= first) & (edge <= last), F.col(value).cast("double")))

    lo, hi = F.floor("_pos"), F.ceil("_pos")
    return (
        placed.join(F.broadcast(wanted), group)
        .filter(((lo >= first) & (lo <= last)) | ((hi >= first) & (hi <= last)))
        .groupBy(group, "prob", "_pos").agg(at(lo).alias("_lo"), at(hi).alias("_hi"))
        .select(group, "prob", (F.col("_lo") + (F.col("_pos") - F.floor("_pos")) * (F.col("_hi") - F.col("_lo"))).alias("quantile"))
    )


def exact_quantiles(df: DataFrame, value: str, probs: list[float]) -> list[float]:
    """Exact quantiles of one column as plain numbers (one per requested probability)."""
    rows = grouped_quantiles(df.select(F.lit(1).alias("_g"), value), "_g", value, probs).collect()
    found = {r["prob"]: r["quantile"] for r in rows}
    return [found[float(p)] for p in probs if float(p) in found]


def value_bucket(value: Column, edges: list[float]) -> Column:
    """Right-closed value bucket 1..k for k+1 edges, lowest edge included. Repeated edges raise."""
    if len(set(edges)) != len(edges):
        raise ValueError(f"bucket edges must be distinct, got {edges}")
    out = F.lit(len(edges) - 1)
    for i in range(len(edges) - 2, 0, -1):
        out = F.when(value <= F.lit(edges[i]), F.lit(i)).otherwise(out)
    return out
