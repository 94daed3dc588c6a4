"""Growing second-order boosted trees over partitioned, binned rows.

Features become at most 255 bins; missing values have a bin of their own and go to the side of a split that gains more.
Rows lie in blocks of bounded size, kept between jobs with their margin, gradient and curvature. A round is one job a
level of the tree: every block sums gradients by (node, feature, bin), the sums are added up, and the driver picks the
splits from them; their size depends on nodes, features and bins, never on rows. The next round starts from the
margins that the blocks hold, so no round is fitted twice. Lineage is cut by a checkpoint every few rounds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.session import cut_lineage, scratch_dir

BINS = 255  # and one more for missing values
BLOCK = 1 << 15
ROWS_PER_TASK = 100_000
PARTS_ADDED = 32
ROUNDS_PER_CUT = 25
RIDGE = 1.0


@dataclass
class Block:
    """Rows of one task: bins (rows x features), label, held-out flag, sampling key, first row of each list, and the running state."""

    bins: np.ndarray
    y: np.ndarray
    held: np.ndarray
    key: np.ndarray
    lists: np.ndarray
    margin: np.ndarray
    slope: np.ndarray | None = None
    curve: np.ndarray | None = None
    kept: np.ndarray | None = None
    path: list[np.ndarray] = field(default_factory=list)  # held-out margins after each round since the last look


@dataclass
class Tree:
    """Nodes as arrays; ``left`` is -1 at leaves. A row goes left if its bin is at most ``cut``, a missing one if ``missing_left``."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for column, x in ((self.feature, -1), (self.cut, -1), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0), (self.cover, cover)):
            column.append(x)
        return len(self.left) - 1

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row of bins ends."""
        feature, cut, missing, left, right = (np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left, self.right))
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows := rows[left[node[rows]] >= 0]):
            at = node[rows]
            b = bins[rows, feature[at]]
            node[rows] = np.where(np.where(b == BINS, missing[at], b <= cut[at]), left[at], right[at])
        return node


# --- objectives: gradient and curvature of the loss at a block's margins ---------------------------

def logistic(block: Block) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-block.margin))
    return p - block.y, np.maximum(p * (1 - p), 1e-16)


def squared(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return block.margin - block.y, np.ones(len(block.y))


def list_positions(lists: np.ndarray, n: int, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's list, and its position from 0 there by falling margin, ties in stored order."""
    group = np.repeat(np.arange(len(lists)), np.diff(np.r_[lists, n]))
    order = np.lexsort((-margin, group))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n) - lists[group]
    return group, place


def ideal_gain(count: np.ndarray) -> np.ndarray:
    """Discounted gain of lists that have their relevant rows first."""
    return np.r_[0.0, np.cumsum(1 / np.log2(np.arange(2, count.max(initial=0) + 2)))][count]


def ndcg(block: Block, pairs: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Pairwise logistic slopes of relevant against other rows of a list, each weighed by what swapping the two changes in NDCG.

    Pairs exist in memory only, a bounded number at a time.
    """
    n = len(block.y)
    slope, curve = np.zeros(n), np.zeros(n)
    group, place = list_positions(block.lists, n, block.margin)
    discount = 1 / np.log2(place + 2)
    best = ideal_gain(np.bincount(group, block.y > 0, len(block.lists)).astype(np.int64))
    sizes = np.diff(np.r_[block.lists, n])
    relevant = np.flatnonzero(block.y > 0)
    ends = np.cumsum(sizes[group[relevant]])
    lo = 0
    while lo < len(relevant):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + pairs, "right")))
        own = relevant[lo:hi]
        n_own = sizes[group[own]]
        i = np.repeat(own, n_own)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n_own) - n_own, n_own) + block.lists[group[i]]
        ok = block.y[j] <= 0
        i, j = i[ok], j[ok]
        weight = np.abs(discount[i] - discount[j]) / best[group[i]]
        rho = 1 / (1 + np.exp(np.clip(block.margin[i] - block.margin[j], -50, 50)))
        push, bend = weight * rho, np.maximum(weight * rho * (1 - rho), 1e-16)
        slope += np.bincount(j, push, n) - np.bincount(i, push, n)
        curve += np.bincount(j, bend, n) + np.bincount(i, bend, n)
        lo = hi
    return slope, curve


# --- rows to blocks --------------------------------------------------------------------------------

def feature_array(columns: list[str]) -> Column:
    """The features of a row as doubles; null stays null and is read as missing."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def bin_edges(df: DataFrame, columns: list[str]) -> list[np.ndarray]:
    """Up to 254 upper bin edges a feature, all in one pass; they are values that occur."""
    shares = [k / BINS for k in range(1, BINS)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 20_000).alias(f"q{k}") for k, c in enumerate(columns)]).first()
    return [np.unique(np.array(q, float)) if q else np.zeros(0) for q in found]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of edges below each value; BINS where it is missing."""
    out = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.where(np.isnan(x[:, f]), BINS, np.searchsorted(e, x[:, f], "left"))
    return out


def blocks_of(df: DataFrame, columns: list[str], label: Column, start: float, edges: list[np.ndarray], group: str | None) -> RDD:
    """The rows of ``df`` (with ``is_val``) as blocks; with ``group`` every list lies whole in one block."""
    spark = df.sparkSession
    scratch_dir(spark)
    key = F.xxhash64(*df.columns).alias("key")
    by = F.col(group) if group else key
    rows = df.select(by.alias("list"), key, feature_array(columns).alias("x"), label.cast("double").alias("y"), F.col("is_val").alias("held"))
    tasks = max(1, -(-df.count() // ROWS_PER_TASK))
    sent = spark.sparkContext.broadcast(edges)

    def pack(batches):
        import pandas as pd

        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(batch) > BLOCK:
                change = np.flatnonzero(batch.list.to_numpy()[1:] != batch.list.to_numpy()[:-1]) + 1
                cut = change[change <= BLOCK]
                if not len(cut):
                    break
                yield one(batch.iloc[: cut[-1]])
                batch = batch.iloc[cut[-1] :].reset_index(drop=True)
            rest = batch
        if rest is not None and len(rest):
            yield one(rest)

    def one(part):
        import pandas as pd

        bins = binned(np.stack(part.x.to_numpy()).astype(float), sent.value)
        lists = part.list.to_numpy()
        first = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
        fields = (bins, part.y.to_numpy(np.float64), part.held.to_numpy(bool), part.key.to_numpy(np.int64), first.astype(np.int64))
        return pd.DataFrame({name: [x.tobytes()] for name, x in zip(("bins", "y", "held", "key", "lists"), fields)})

    dealt = rows.repartition(tasks, "list").sortWithinPartitions("list", "key")
    stored = cut_lineage(dealt.mapInPandas(pack, "bins binary, y binary, held binary, key binary, lists binary"))

    def opened(r) -> Block:
        y = np.frombuffer(r.y)
        return Block(np.frombuffer(r.bins, np.uint8).reshape(len(y), -1), y, np.frombuffer(r.held, bool), np.frombuffer(r.key, np.uint64),
                     np.frombuffer(r.lists, np.int64), np.full(len(y), start))

    return stored.rdd.map(opened)


# --- rounds ----------------------------------------------------------------------------------------

def sampled(key: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Whether a row takes part in a round: a hash of its key, so partitioning does not matter."""
    x = (key ^ np.uint64((seed * 1_000_003 + round_ + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / 2**53 < share


def added_up(parts: RDD) -> np.ndarray | None:
    """The sum of one array a partition, in the order of partitions so that it repeats exactly."""
    numbered = parts.mapPartitionsWithIndex(lambda k, xs: [(k, x) for x in xs])
    while parts.getNumPartitions() > PARTS_ADDED:
        groups = -(-parts.getNumPartitions() // PARTS_ADDED)
        parts = numbered.map(lambda kx: (kx[0] // PARTS_ADDED, kx)).groupByKey(groups).mapValues(lambda xs: sum(x for _, x in sorted(xs, key=lambda kx: kx[0])))
        numbered = parts
    found = sorted(numbered.collect(), key=lambda kx: kx[0])
    return sum(x for _, x in found) if found else None


def best_splits(sums: np.ndarray, columns: np.ndarray, widths: list[int], least: float) -> list[tuple | None]:
    """For every node the best (gain, feature, cut, missing left, left and right sums), or None.

    ``sums``: nodes x chosen features x (bins and missing) x (slope, curvature). Ties go to the first feature, the
    lowest cut, and missing values left.
    """
    below = np.cumsum(sums[:, :, :BINS], axis=2)
    missing = sums[:, :, BINS:, :]
    whole = below[:, :, -1:, :] + missing
    left = np.stack([below + missing, below], axis=3)  # nodes, features, cuts, missing left or right, 2
    right = whole[:, :, :, None, :] - left

    def worth(s: np.ndarray) -> np.ndarray:
        return s[..., 0] ** 2 / (s[..., 1] + RIDGE)

    gain = worth(left) + worth(right) - worth(whole)[:, :, :, None]
    real = np.arange(BINS)[None, :] < np.array(widths)[columns][:, None]
    ok = real[None, :, :, None] & (left[..., 1] >= least) & (right[..., 1] >= least)
    gain = np.where(ok, gain, -np.inf)
    out: list[tuple | None] = []
    for node in range(len(sums)):
        k = int(np.argmax(np.round(gain[node], 12)))
        f, cut, side = np.unravel_index(k, gain[node].shape)
        if gain[node, f, cut, side] > 1e-6:
            out.append((float(gain[node, f, cut, side]), int(columns[f]), int(cut), side == 0, left[node, f, cut, side], right[node, f, cut, side]))
        else:
            out.append(None)
    return out


class Grower:
    """Adds trees one round at a time; ``state`` holds the blocks after all trees so far."""

    def __init__(self, blocks: RDD, edges: list[np.ndarray], objective: Callable, depth: int, step: float, seed: int, share: float = 0.8, least: float = 5.0):
        self.edges, self.objective = edges, objective
        self.depth, self.step, self.seed, self.share, self.least = depth, step, seed, share, least
        self.trees: list[Tree] = []
        self.old: list[RDD] = []
        self.state, self.looked = blocks, True
        self._advance(None)

    def _advance(self, tree: Tree | None) -> None:
        """The blocks after a further tree, with slopes and curvatures for the next round; made with the next job."""
        step, objective, seed, share, round_, fresh = self.step, self.objective, self.seed, self.share, len(self.trees), self.looked
        value = None if tree is None else np.array(tree.value)

        def advance(b: Block) -> Block:
            margin = b.margin if tree is None else b.margin + step * value[tree.leaves_of(b.bins)]
            path = [] if tree is None else [*([] if fresh else b.path), margin[b.held]]
            out = Block(b.bins, b.y, b.held, b.key, b.lists, margin, path=path)
            out.slope, out.curve = objective(out)
            out.kept = ~b.held & sampled(b.key, round_, seed, share)
            return out

        self.old.append(self.state)
        self.state, self.looked = self.state.map(advance).persist(StorageLevel.MEMORY_AND_DISK), False
        if round_ and round_ % ROUNDS_PER_CUT == 0:
            self.state.checkpoint()

    def _made(self) -> None:
        """The present state has been made: what it came from is not needed any more."""
        for rdd in self.old:
            if rdd.is_cached:
                rdd.unpersist()
        self.old = []

    def grow(self) -> Tree:
        rng = np.random.default_rng([self.seed, len(self.trees)])
        n = len(self.edges)
        columns = np.sort(rng.choice(n, max(1, round(self.share * n)), replace=False))
        widths = [len(e) for e in self.edges]
        tree, open_ = Tree(), [0]
        for level in range(self.depth):
            sums = self._sums(tree, open_, columns)
            if level == 0:
                self._made()
                total = (0.0, 0.0) if sums is None else sums[0, 0].sum(axis=0)
                tree.add(-total[0] / (total[1] + RIDGE), float(total[1]))
            following = []
            for node, split in zip(open_, [] if sums is None else best_splits(sums, columns, widths, self.least)):
                if split:
                    tree.gain[node], tree.feature[node], tree.cut[node], tree.missing_left[node], *sides = split
                    tree.left[node], tree.right[node] = (tree.add(float(-s[0] / (s[1] + RIDGE)), float(s[1])) for s in sides)
                    following += [tree.left[node], tree.right[node]]
            if not (open_ := following):
                break
        self.trees.append(tree)
        self._advance(tree)
        return tree

    def _sums(self, tree: Tree, open_: list[int], columns: np.ndarray) -> np.ndarray | None:
        """Slopes and curvatures of the open nodes by feature and bin."""

        def local(blocks):
            slot = np.full(max(len(tree.left), 1), -1)
            slot[open_] = np.arange(len(open_))
            total, width = None, BINS + 1
            for b in blocks:
                rows = np.flatnonzero(b.kept)
                at = slot[tree.leaves_of(b.bins[rows])] if tree.left else np.zeros(len(rows), np.int64)
                rows, at = rows[at >= 0], at[at >= 0]
                own = np.empty((len(open_), len(columns), width, 2))
                for k, f in enumerate(columns):
                    cell = at * width + b.bins[rows, f]
                    for m, measure in enumerate((b.slope, b.curve)):
                        own[:, k, :, m] = np.bincount(cell, measure[rows], len(open_) * width).reshape(len(open_), width)
                total = own if total is None else total + own
            if total is not None:
                yield total

        return added_up(self.state.mapPartitions(local))

    def look(self) -> RDD:
        """The blocks with the held-out margins after each round since the last look."""
        self.looked = True
        return self.state

    def close(self) -> None:
        for rdd in (*self.old, self.state):
            if rdd.is_cached:
                rdd.unpersist()
