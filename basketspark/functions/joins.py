"""Join helpers: size-checked broadcast, salting by measured key weight, blocked products."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
PAIRS_PER_TASK = 50_000_000


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                small_rows: int | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a large table to a lookup table with one row per key.

    The lookup is broadcast only when its counted size is below the bound;
    otherwise the join shuffles, salted by how heavy each key is.
    """
    rows = small.count() if small_rows is None else small_rows
    if rows <= max_broadcast_rows:
        return big.join(F.broadcast(small), key, how)
    return salted_join(big, small, key, how, unique=True)


def salted_join(big: DataFrame, other: DataFrame, key: str, how: str = "inner",
                rows_per_salt: int = 500_000, pairs_per_task: int = PAIRS_PER_TASK, unique: bool = False) -> DataFrame:
    """Equi-join that splits heavy keys over several tasks, exactly.

    A key is heavy by its rows on either side or by the pairs it makes, and
    becomes a grid of tasks: its rows of ``big`` are hashed into bands, its rows
    of ``other`` into strips, and each band meets each strip once. Keys below
    the thresholds are joined as usual, so only heavy keys pay. A left join can
    only cut ``big``. ``unique`` says that ``other`` has one row per key, so it
    need not be counted. The heavy-key table is broadcast after a count.
    """
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_l"))
    if unique:
        counts = counts.withColumn("_r", F.lit(1).cast("bigint"))
    else:
        counts = counts.join(other.groupBy(key).agg(F.count(F.lit(1)).alias("_r")), key)
    made = F.col("_l").cast("double") * F.col("_r")
    side = float(pairs_per_task) ** 0.5

    def cuts(own: str, against: str):
        by_pairs = F.when(made > pairs_per_task, F.ceil(F.col(own) / F.greatest(F.lit(side), pairs_per_task / F.col(against))))
        return F.greatest(F.floor(F.col(own) / rows_per_salt) + 1, F.coalesce(by_pairs, F.lit(1))).cast("int")

    strips = cuts("_r", "_l") if how == "inner" and not unique else F.lit(1)
    heavy = counts.select(key, cuts("_l", "_r").alias("_bands"), strips.alias("_strips")).filter("_bands > 1 OR _strips > 1")
    n_heavy = heavy.limit(MAX_BROADCAST_ROWS + 1).count()
    if n_heavy == 0:
        return big.join(other, key, how)
    spread = F.broadcast(heavy) if n_heavy <= MAX_BROADCAST_ROWS else heavy
    bands, strips = F.coalesce(F.col("_bands"), F.lit(1)), F.coalesce(F.col("_strips"), F.lit(1))

    def placed(df: DataFrame, own: str, n, copied: str, m) -> DataFrame:
        row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        return df.join(spread, key, "left").withColumn(own, F.pmod(row_hash, n).cast("int")).withColumn(
            copied, F.explode(F.sequence(F.lit(0), m - 1))).drop("_bands", "_strips")

    left, right = placed(big, "_band", bands, "_strip", strips), placed(other, "_strip", strips, "_band", bands)
    return left.join(right, [key, "_band", "_strip"], how).drop("_band", "_strip")


def grid_product(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                 kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
                 left_chunk: int = 4096, right_chunk: int = 8192) -> DataFrame:
    """Dense product of two keyed tables as independent blocks of bounded size.

    Both sides are hashed into chunks and every (left chunk, right chunk) cell
    is one cogrouped task, so no side is broadcast, no task sees a whole table
    and the pairs are never materialised as rows: the kernel reduces its cell
    with numpy and returns only what must survive.
    """
    n_left, n_right = left.count(), right.count()
    parallel = left.sparkSession.sparkContext.defaultParallelism
    p = max(1, -(-n_left // left_chunk), min(parallel, n_left // 64))
    q = max(1, -(-n_right // right_chunk))
    rows = (
        left.withColumn("_p", F.pmod(F.xxhash64(left_id), F.lit(p)).cast("int"))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(q - 1))))
    )
    # Own names for the right side, so that a table can be multiplied with itself.
    names = {f"_r_{c}": c for c in right.columns}
    cols = (
        right.select(*[F.col(c).alias(r) for r, c in names.items()])
        .withColumn("_rq", F.pmod(F.xxhash64(f"_r_{right_id}"), F.lit(q)).cast("int"))
        .withColumn("_rp", F.explode(F.sequence(F.lit(0), F.lit(p - 1))))
    )

    def cell(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return kernel(a, b.rename(columns=names))

    return rows.groupBy("_p", "_q").cogroup(cols.groupBy("_rp", "_rq")).applyInPandas(cell, schema)
