"""Vector columns: dot product, unit length, weighted sums and exact blocked top-n."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketspark.session import written, written_batches

SIM_DECIMALS = 9


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(v: Column) -> Column:
    """Scale to length one; a zero vector stays zero.

    The length is bound once as a lambda variable: written inside the element
    lambda it would be recomputed for every element.
    """
    norm = F.sqrt(dot(v, v))
    safe = F.when(norm == 0, F.lit(1.0)).otherwise(norm)
    return F.get(F.transform(F.array(safe), lambda n: F.transform(v, lambda x: x.cast("double") / n)), F.lit(0))


def weighted_vector_sum(rows: DataFrame, key: str, weight: str, vector: str, dim: int, out: str = "vector") -> DataFrame:
    """Sum of weight x vector per key, kept as ``dim`` plain sums so partial aggregation applies."""
    sums = [F.sum(F.col(weight) * F.col(vector)[i].cast("double")).alias(f"_v{i}") for i in range(dim)]
    return rows.groupBy(key).agg(*sums).select(key, F.array(*[F.col(f"_v{i}") for i in range(dim)]).alias(out))


def vector_blocks(path: str, key: str, rows: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """From a task: the keys and vectors of a written table (key, vector) block by block; null components are not numbers."""
    for block in written_batches(path, [key, "vector"], rows):
        if block.num_rows:
            yield block.column(0).to_numpy(zero_copy_only=False), block.column(1).flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, -1)


def owned_vector_sums(rows: DataFrame, vectors: DataFrame, key: str, item: str, weight: str, out: str = "vector", rows_at_once: int = 100_000) -> DataFrame:
    """Sum of weight x item vector per key, as :func:`weighted_vector_sum` of the two tables' join, of which no row is ever shuffled.

    The vectors are written once; rows are dealt by key, and a task reads the vectors block by block beside the rows
    of whole keys. Null components add nothing, and a key of which no item has a vector has no row.
    """
    path = written(vectors.filter("vector IS NOT NULL").select(item, F.col("vector").cast("array<double>")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = rest[key].to_numpy()
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) >= rows_at_once else 0
            if last:
                yield sums(rest.iloc[:last])
                rest = rest.iloc[last:]
        if rest is not None and len(rest):
            yield sums(rest)

    def sums(part: pd.DataFrame) -> pd.DataFrame:
        keys, who = np.unique(part[key].to_numpy(), return_inverse=True)
        items, w = part[item].to_numpy(), part[weight].to_numpy(float)
        total, found = None, np.zeros(len(keys), bool)
        for names, m in vector_blocks(path, item):
            order = np.argsort(names, kind="stable")
            lo, hi = (np.searchsorted(names[order], items, side) for side in ("left", "right"))
            n = hi - lo
            total = np.zeros((len(keys), m.shape[1])) if total is None else total
            row = np.repeat(np.arange(len(items)), n)  # sorted by key, as the rows are
            if len(row):
                at = order[np.arange(len(row)) - np.repeat(np.cumsum(n) - n - lo, n)]
                own = who[row]
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                total[own[starts]] += np.add.reduceat(np.nan_to_num(m)[at] * w[row][:, None], starts, axis=0)
                found[own[starts]] = True
        return pd.DataFrame({key: keys[found], out: pd.Series(list(total[found]) if found.any() else [], dtype=object)})

    dealt = rows.select(key, item, weight).repartition(key).sortWithinPartitions(key)
    return dealt.mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {out} array<double>")


def top_n_by_similarity(left: DataFrame, right: DataFrame, left_id: str, right_id: str, n: int,
                        exclude_self: bool = False, left_chunk: int = 4096, right_chunk: int = 8192) -> DataFrame:
    """For every left row the ``n`` right rows with the largest dot product, best first.

    Exact. The right side is written once, and every task reads it block by block beside its own left rows and keeps
    their best ``n`` so far (ties by right id), so nothing but the left rows is shuffled and a task holds two blocks.
    Where left ids repeat, the lists of an id are merged. Returns (left_id, right_id, similarity, rank).
    """
    kinds = dict(left.dtypes)[left_id], dict(right.dtypes)[right_id]
    other = "_other" if left_id == right_id else right_id
    left, right = left.filter("vector IS NOT NULL"), right.filter("vector IS NOT NULL")
    path = written(right.select(right_id, F.col("vector").cast("array<double>")))
    n_left, parallel = left.count(), left.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-n_left // left_chunk), min(parallel, n_left // 64))
    repeated = not left.groupBy(left_id).count().filter("count > 1").isEmpty()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), left_chunk):
                yield nearest(batch[left_id].to_numpy()[lo:lo + left_chunk], np.stack(batch["vector"].to_numpy()[lo:lo + left_chunk]).astype(float))

    def nearest(ids: np.ndarray, vecs: np.ndarray) -> pd.DataFrame:
        row, item, sim = np.zeros(0, np.int64), None, np.zeros(0)
        floor = np.full(len(ids), -np.inf)  # the n-th best so far
        for names, m in vector_blocks(path, right_id, right_chunk):
            new = [better(ids, vecs, names, m, floor, lo) for lo in range(0, len(ids), 512)]
            row, sim = (np.concatenate([old, *(x[i] for x in new)]) for i, old in ((0, row), (2, sim)))
            item = np.concatenate([*([] if item is None else [item]), *(x[1] for x in new)])
            order = np.lexsort((item, -sim, row))
            row, item, sim = row[order], item[order], sim[order]
            place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
            row, item, sim, place = (x[place < n] for x in (row, item, sim, place))
            floor[row[place == n - 1]] = sim[place == n - 1]
        place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        return pd.DataFrame({left_id: ids[row], other: [] if item is None else item, "similarity": sim, "rank": (place + 1).astype(np.int32)})

    def better(ids: np.ndarray, vecs: np.ndarray, names: np.ndarray, m: np.ndarray, floor: np.ndarray, lo: int) -> tuple[np.ndarray, ...]:
        """Row, right id and similarity of the pairs of some rows with a block that may be among the best, all ties included."""
        own = slice(lo, lo + 512)
        sims = np.round(vecs[own] @ m.T, SIM_DECIMALS)
        sims[np.isnan(sims)] = -np.inf
        if exclude_self:
            sims[ids[own][:, None] == names[None, :]] = -np.inf
        least = floor[own]
        if len(names) > n and np.isneginf(least).any():  # the block's own n-th best, where there is no floor yet
            least = np.maximum(least, np.partition(sims, len(names) - n, axis=1)[:, len(names) - n])
        r, c = np.nonzero((sims >= least[:, None]) & np.isfinite(sims))
        return lo + r, names[c], sims[r, c]

    schema = f"{left_id} {kinds[0]}, {other} {kinds[1]}, similarity double, rank int"
    found = left.select(left_id, "vector").repartition(tasks, left_id).mapInPandas(run, schema)
    if not repeated:
        return found
    best = Window.partitionBy(left_id).orderBy(F.desc("similarity"), F.asc(other))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
