"""Boosted trees: fitting with a held-out stopping rule, scoring, importances and additive contributions."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.functions.hashing import hash_bucket
from basketspark.functions.ranks import running_totals
from basketspark.operators import growth

PATIENCE = 50
LOOK_EVERY = 25  # rounds between two looks at the held-out rows; the kept round does not depend on it
NDCG_AT = 12
MAX_ENSEMBLE_NODES = 500_000


@dataclass
class Ensemble:
    """A fitted model: nodes of all trees as columns, and how it was stopped.

    ``held_out`` has the measure after every round fitted (higher is better, errors are negative); the trees are the
    first ``n_trees`` of them. ``roots`` are the first nodes of the trees; children are node numbers.
    """

    columns: list[str]
    objective: str
    start: float
    roots: list[int]
    nodes: dict[str, np.ndarray]
    rounds_allowed: int
    held_out: list[float] = field(default_factory=list)

    @property
    def n_trees(self) -> int:
        return len(self.roots)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Summed tree values of rows of features (NaN is missing)."""
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        feature, threshold, missing, left, right, value = (self.nodes[c] for c in ("feature", "threshold", "missing_left", "left", "right", "value"))
        for root in self.roots:
            node, open_ = np.full(len(x), root), rows
            while len(open_ := open_[left[node[open_]] >= 0]):
                at = node[open_]
                v = x[open_, feature[at]]
                node[open_] = np.where(np.where(np.isnan(v), missing[at], v <= threshold[at]), left[at], right[at])
            out += value[node]
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and a one-row head as parquet."""
        tree = np.repeat(np.arange(self.n_trees), np.diff([*self.roots, len(self.nodes["left"])]))
        rows = zip(tree.tolist(), range(len(tree)), *(self.nodes[c].tolist() for c in NODE_COLUMNS))
        spark.createDataFrame(list(rows), NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = {"columns": self.columns, "objective": self.objective, "start": self.start, "roots": self.roots, "rounds_allowed": self.rounds_allowed, "held_out": self.held_out}
        spark.createDataFrame([(json.dumps(head),)], "head string").write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        head = json.loads(spark.read.parquet(f"{path}/head").first()["head"])
        rows = spark.read.parquet(f"{path}/nodes").orderBy("node").collect()
        return cls(nodes={c: np.array([r[c] for r in rows], t) for c, t in NODE_COLUMNS.items()}, **head)


NODE_COLUMNS = {"left": np.int64, "right": np.int64, "feature": np.int64, "threshold": float, "missing_left": bool, "value": float, "gain": float, "cover": float}
NODE_SCHEMA = "tree int, node int, left int, right int, feature int, threshold double, missing_left boolean, value double, gain double, cover double"


def ensemble_of(trees: list[growth.Tree], edges: list[np.ndarray], columns: list[str], objective: str, start: float, step: float, allowed: int, held_out: list[float]) -> Ensemble:
    """Trees over bins as one table of nodes over feature values; values include the step."""
    nodes: dict[str, list] = {c: [] for c in NODE_COLUMNS}
    roots = []
    for t in trees:
        base = len(nodes["left"])
        roots.append(base)
        for name in ("left", "right"):
            nodes[name] += [x + base if x >= 0 else -1 for x in getattr(t, name)]
        nodes["threshold"] += [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]
        for name in ("feature", "missing_left", "gain", "cover"):
            nodes[name] += getattr(t, name)
        nodes["value"] += [step * v for v in t.value]
    if len(nodes["left"]) > MAX_ENSEMBLE_NODES:
        raise ValueError("ensemble too large; reduce trees or depth")
    return Ensemble(columns, objective, start, roots, {c: np.array(v, NODE_COLUMNS[c]) for c, v in nodes.items()}, allowed, held_out)


def with_holdout(df: DataFrame, share: int = 20, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Repeatable ``is_val`` flag for ``share`` percent of keys; balanced over labels because the hash ignores them."""
    return df.withColumn("is_val", hash_bucket(key, 100, seed) < share)


# --- the measure after every round ------------------------------------------------------------

def average_precisions(blocks: RDD, spark: SparkSession) -> list[float]:
    """Exact average precision of the held-out rows after each round on the blocks' paths, all rounds in one pass."""
    parts = blocks.flatMap(lambda b: [(k, bytearray(m.tobytes()), bytearray(b.y[b.held].tobytes())) for k, m in enumerate(b.path)])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, margins, y in zip(batch["round"], batch.margins, batch.y):
                score, at = np.unique(np.frombuffer(margins), return_inverse=True)
                yield pd.DataFrame({"round": k, "score": score, "n": np.bincount(at), "pos": np.bincount(at, np.frombuffer(y) > 0, len(score)).astype(np.int64)})

    rows = spark.createDataFrame(parts, "round int, margins binary, y binary").mapInPandas(counted, "round int, score double, n long, pos long")
    counts = rows.groupBy("round", "score").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    placed = running_totals(counts, [F.col("round"), F.desc("score")], {"cum_n": F.col("n"), "cum_pos": F.col("pos")})
    per = placed.groupBy("round").agg(F.sum("n").alias("own_n"), F.sum("pos").alias("own_pos"))  # alike in all rounds
    own = placed.join(F.broadcast(per), "round")  # a row a round on the one side
    hits, flagged = F.col("cum_pos") - F.col("round") * F.col("own_pos"), F.col("cum_n") - F.col("round") * F.col("own_n")
    found = own.groupBy("round").agg(F.sum(F.try_divide(F.col("pos"), F.col("own_pos")) * hits / flagged).alias("ap")).collect()
    return [r["ap"] for r in sorted(found, key=lambda r: r["round"])]


def negative_errors(blocks: RDD, spark: SparkSession) -> list[float]:
    """Minus the root mean squared error after each round."""
    sums = blocks.map(lambda b: np.array([[((m - b.y[b.held]) ** 2).sum(), b.held.sum()] for m in b.path])).collect()
    total = sum(sums)
    return (-np.sqrt(total[:, 0] / total[:, 1])).tolist()


def list_gains(blocks: RDD, spark: SparkSession) -> list[float]:
    """Mean NDCG of the held-out lists that have a relevant row, after each round."""

    def of(b: growth.Block) -> np.ndarray:
        y, n = b.y[b.held], int(b.held.sum())
        own = np.repeat(np.arange(len(b.lists)), np.diff(np.r_[b.lists, len(b.y)]))[b.held]
        lists = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if n else np.zeros(0, np.int64)
        out = []
        for m in b.path:
            group, place = growth.list_positions(lists, n, m)
            gain = np.bincount(group, (y > 0) * (place < NDCG_AT) / np.log2(place + 2), len(lists))
            best = growth.ideal_gain(np.minimum(np.bincount(group, y > 0, len(lists)).astype(np.int64), NDCG_AT))
            out.append([(gain[best > 0] / best[best > 0]).sum(), (best > 0).sum()])
        return np.array(out, float).reshape(-1, 2)

    total = sum(blocks.map(of).collect())
    return [float(s / c) if c else math.nan for s, c in total]


OBJECTIVES = {"logistic": (growth.logistic, average_precisions), "squared": (growth.squared, negative_errors), "ndcg": (growth.ndcg, list_gains)}


def best_round(measures: list[float], patience: int) -> tuple[int, bool]:
    """The first of the best rounds (from 1) up to where ``patience`` rounds brought nothing better, and whether that was reached."""
    best, kept = -math.inf, 0
    for k, value in enumerate(measures, 1):
        if value > best:
            best, kept = value, k
        elif k - kept >= patience:
            return kept, True
    return kept, False


def fit(df: DataFrame, columns: list[str], label: Column, objective: str, trees: int, depth: int, step: float = 0.05, seed: int = 42,
        patience: int = PATIENCE, group: str | None = None) -> Ensemble:
    """Boosted trees on the rows without ``is_val``, kept up to the round that is best on the others.

    The measure (average precision, root mean squared error or NDCG of lists) is exact for every round. Fitting ends
    ``patience`` rounds after the best one; without held-out rows, or where the measure is undefined on them, all
    ``trees`` rounds are kept. Each round is fitted once, from the margins of the round before.
    """
    spark = df.sparkSession
    facts = df.filter(~F.col("is_val")).agg(F.avg(label.cast("double")).alias("mean")).first()
    mean = facts["mean"] if facts["mean"] is not None else 0.0
    odds = min(max(mean, 1e-6), 1 - 1e-6)
    start = {"logistic": math.log(odds / (1 - odds)), "squared": mean, "ndcg": 0.0}[objective]
    edges = growth.bin_edges(df.filter(~F.col("is_val")), columns)
    watched = not df.filter("is_val").isEmpty()
    slopes, measure = OBJECTIVES[objective]
    grower = growth.Grower(growth.blocks_of(df, columns, label, start, edges, group), edges, slopes, depth, step, seed)
    measures: list[float] = []
    try:
        while len(grower.trees) < trees:
            grower.grow()
            if watched and (len(grower.trees) % LOOK_EVERY == 0 or len(grower.trees) == trees):
                measures += [-math.inf if m is None or math.isnan(m) else m for m in measure(grower.look(), spark)]
                if best_round(measures, patience)[1]:
                    break
    finally:
        grower.close()
    kept = best_round(measures, patience)[0] or trees
    return ensemble_of(grower.trees[:kept], edges, columns, objective, start, step, trees, [m for m in measures if m > -math.inf])


def fit_gbt_classifier(df: DataFrame, columns: list[str], label: Column, trees: int = 600, depth: int = 4,
                       step: float = 0.05, seed: int = 42, patience: int = PATIENCE) -> Ensemble:
    """Boosted classifier, stopped by the average precision of the held-out rows (``is_val``)."""
    return fit(df, columns, label, "logistic", trees, depth, step, seed, patience)


def fit_gbt_regressor(df: DataFrame, columns: list[str], label: Column, trees: int = 2000, depth: int = 4,
                      step: float = 0.05, seed: int = 42, patience: int = PATIENCE) -> Ensemble:
    """Boosted regressor, stopped by the root mean squared error of the held-out rows."""
    return fit(df, columns, label, "squared", trees, depth, step, seed, patience)


def fit_listwise(df: DataFrame, columns: list[str], trees: int = 500, depth: int = 6, step: float = 0.05, seed: int = 42,
                 group: str = "customer_id", patience: int = 30) -> Ensemble:
    """Boosted ranker for one list a group: pairwise slopes weighed by the change of NDCG, stopped by the held-out NDCG.

    ``df``: group, item_idx, columns, label, is_val. Lists without a relevant row teach nothing and are left out.
    """
    alive = df.groupBy(group).agg(F.max("label").alias("n_pos")).filter("n_pos > 0").select(group)
    rows = df.join(alive, group).select(group, "item_idx", *[c for c in columns if c not in (group, "item_idx")], "label", "is_val")
    return fit(rows, columns, F.col("label"), "ndcg", trees, depth, step, seed, patience, group)


# --- scoring ----------------------------------------------------------------------------------

def with_margin(model: Ensemble, df: DataFrame, out: str) -> DataFrame:
    """``df`` with the summed tree values; the model, of bounded size, is broadcast."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def margin(x: pd.Series) -> pd.Series:
        return pd.Series(sent.value.margins(np.stack(x.to_numpy()).astype(float)) if len(x) else [])

    return df.withColumn(out, margin(growth.feature_array(model.columns)))


def predict_probability(model: Ensemble, df: DataFrame, columns: list[str], out: str = "p") -> DataFrame:
    return with_margin(model, df, out).withColumn(out, 1 / (1 + F.exp(-F.col(out)))).select(*df.columns, out)


def predict_value(model: Ensemble, df: DataFrame, columns: list[str], out: str = "p") -> DataFrame:
    return with_margin(model, df, out)


def predict_listwise(model: Ensemble, df: DataFrame, columns: list[str], out: str = "score") -> DataFrame:
    return with_margin(model, df, out)


# --- reading a model --------------------------------------------------------------------------

def importance_table(model: Ensemble, columns: list[str], spark) -> DataFrame:
    """Per feature: mean gain and cover per split, split count, and gain share (1 dp)."""
    splits_of = [(columns[int(f)], float(g), float(c)) for f, g, c, left in zip(*(model.nodes[n] for n in ("feature", "gain", "cover", "left"))) if left >= 0]
    nodes = spark.createDataFrame(splits_of, "feature string, gain double, cover double")
    splits = nodes.groupBy("feature").agg(F.avg("gain").alias("gain"), F.count(F.lit(1)).alias("weight"), F.avg("cover").alias("cover"))
    names = spark.createDataFrame([(c,) for c in columns], "feature string")
    total = splits.agg(F.sum("gain")).scalar()
    return names.join(splits, "feature", "left").select(
        "feature", F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("weight", F.lit(0)).alias("weight"),
        F.coalesce("cover", F.lit(0.0)).alias("cover"),
        F.coalesce(F.bround(100 * F.col("gain") / total, 1), F.lit(0.0)).alias("gain_pct"),
    )


def ensemble_leaves(model: Ensemble) -> list[tuple]:
    """Each leaf as (value, [(feature, low, high, takes missing, cover share)]), repeated features merged."""
    n = {c: v.tolist() for c, v in model.nodes.items()}
    leaves = []
    for root in model.roots:
        stack: list[tuple[int, dict]] = [(root, {})]
        while stack:
            node, path = stack.pop()
            if n["left"][node] < 0:
                leaves.append((n["value"][node], [(f, *v) for f, v in path.items()]))
                continue
            f, cut = n["feature"][node], n["threshold"][node]
            lo, hi, missing, share = path.get(f, (-math.inf, math.inf, True, 1.0))
            for side, (a, b) in (("left", (lo, min(hi, cut))), ("right", (max(lo, cut), hi))):
                child = n[side][node]
                own = missing and n["missing_left"][node] == (side == "left")
                stack.append((child, {**path, f: (a, b, own, share * n["cover"][child] / n["cover"][node])}))
    return leaves


def _leaf_effects(x: np.ndarray, leaves: list[tuple], n_features: int) -> tuple[np.ndarray, float]:
    """Exact path-dependent Shapley values summed over leaves, plus the base value.

    For one leaf with m features, feature i gets value x (o_i - z_i) x the
    Shapley-weighted sum over subsets of the others, read off the coefficients
    of prod_{j != i} (z_j + o_j t).
    """
    phi, base = np.zeros((len(x), n_features)), 0.0
    for value, path in leaves:
        m = len(path)
        on = [np.where(np.isnan(x[:, f]), missing, (x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, lo, hi, missing, _ in path]
        off = [z for *_, z in path]
        base += value * math.prod(off)
        for i, (f, *_rest) in enumerate(path):
            coef = [np.ones(len(x))] + [np.zeros(len(x)) for _ in range(m - 1)]
            for j in range(m):
                if j == i:
                    continue
                for s in range(m - 1, 0, -1):
                    coef[s] = coef[s] * off[j] + coef[s - 1] * on[j]
                coef[0] = coef[0] * off[j]
            weight = sum(coef[s] * (math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m)) for s in range(m))
            phi[:, f] += value * (on[i] - off[i]) * weight
    return phi, base


def contributions(model: Ensemble, df: DataFrame, columns: list[str], key: str = "customer_id") -> DataFrame:
    """(key, contributions array, base_value) in log-odds; base + sum equals the raw score."""
    sent = df.sparkSession.sparkContext.broadcast(ensemble_leaves(model))
    n, start = len(columns), model.start

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()).astype(float) if len(pdf) else np.zeros((0, n))
            phi, base = _leaf_effects(x, sent.value, n)
            yield pd.DataFrame({key: pdf[key], "contributions": list(phi), "base_value": base + start})

    kind = dict(df.dtypes)[key]
    return df.select(key, growth.feature_array(columns).alias("x")).mapInPandas(explain, f"{key} {kind}, contributions array<double>, base_value double")


def mean_absolute_effect(contrib: DataFrame, columns: list[str]) -> DataFrame:
    """Mean absolute contribution per feature, one aggregate."""
    means = contrib.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(c) for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_effect")) for c in columns])
    return means.select(F.explode(pairs).alias("r")).select("r.*")


def top_drivers(contrib: DataFrame, features: DataFrame, columns: list[str], n: int = 5, key: str = "customer_id") -> DataFrame:
    """The ``n`` largest effects per row with their feature values.

    Thirteen effects sit in one row, so they are sorted in place: no shuffle beyond the key join.
    """
    entries = F.array(*[
        F.struct(
            (-F.abs(F.col("contributions")[i])).alias("order"), F.lit(i).alias("position"), F.lit(c).alias("feature"),
            F.round(F.col(c).cast("double"), 2).alias("value"), F.col("contributions")[i].alias("effect"),
        ) for i, c in enumerate(columns)
    ])
    ranked = contrib.join(features.select(key, *columns), key).select(
        key, F.posexplode(F.slice(F.array_sort(entries), 1, n)).alias("i", "d")
    )
    return ranked.select(
        key, (F.col("i") + 1).alias("rank"), "d.feature", "d.value", F.round("d.effect", 4).alias("effect_log_odds"),
        F.when(F.col("d.effect") > 0, "raises").otherwise("lowers").alias("direction"),
    )
