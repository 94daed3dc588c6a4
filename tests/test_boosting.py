"""Boosted trees against plain versions: gradients, splits, whole trees, the stopping rule, storage."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.operators import boosting, growth, metrics
from basketspark.session import scratch_dir

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """900 rows whose label follows a and c, with missing values that mean something, ties, and a feature of one value."""
    rng = np.random.default_rng(11)
    out = []
    for i in range(900):
        a, c = float(rng.integers(0, 40)), None if rng.random() < 0.3 else float(rng.normal())
        p = 1 / (1 + math.exp(-(a - 20) / 6 - (1.5 if c is None else c)))
        out.append((i, a, 7.0, c, int(rng.random() < p), i % 5 == 0))
    return spark.createDataFrame(out, "customer_id bigint, a double, b double, c double, label int, is_val boolean").cache()


def block(y, margin, lists):
    n = len(y)
    return growth.Block(np.zeros((n, 1), np.uint8), np.array(y, float), np.zeros(n, bool), np.arange(n, dtype=np.uint64), np.array(lists), np.array(margin, float))


def plain_ndcg_slopes(y, margin, lists):
    slope, curve = np.zeros(len(y)), np.zeros(len(y))
    for lo, hi in zip(lists, [*lists[1:], len(y)]):
        order = sorted(range(lo, hi), key=lambda k: (-margin[k], k))
        place = {k: p for p, k in enumerate(order)}
        best = sum(1 / math.log2(p + 2) for p in range(sum(y[lo:hi])))
        for i in range(lo, hi):
            for j in range(lo, hi):
                if y[i] and not y[j]:
                    w = abs(1 / math.log2(place[i] + 2) - 1 / math.log2(place[j] + 2)) / best
                    r = 1 / (1 + math.exp(margin[i] - margin[j]))
                    slope[i] -= w * r
                    slope[j] += w * r
                    curve[i] += w * r * (1 - r)
                    curve[j] += w * r * (1 - r)
    return slope, curve


@pytest.mark.parametrize("pairs", [1 << 20, 5])
def test_ranking_slopes_equal_all_pairs(pairs):
    rng = np.random.default_rng(pairs)
    sizes = [1, 7, 12, 3, 20, 2]
    lists = np.cumsum([0, *sizes[:-1]])
    y = rng.integers(0, 2, sum(sizes))
    y[lists[3] : lists[3] + 3] = 0  # a list without a relevant row
    margin = np.round(rng.normal(size=sum(sizes)), 1)  # with ties
    got = growth.ndcg(block(y, margin, lists), pairs)
    for one, two in zip(got, plain_ndcg_slopes(y.tolist(), margin.tolist(), lists.tolist())):
        assert np.allclose(one, two, atol=1e-9)


def test_slopes_are_derivatives_of_the_loss():
    margin, y = np.array([-2.0, 0.3, 1.5]), np.array([0.0, 1.0, 1.0])
    loss = {growth.logistic: lambda m: np.log1p(np.exp(m)) - y * m, growth.squared: lambda m: (m - y) ** 2 / 2}
    for objective, f in loss.items():
        slope, curve = objective(block(y, margin, [0]))
        e = 1e-4
        assert np.allclose(slope, (f(margin + e) - f(margin - e)) / (2 * e), atol=1e-6)
        assert np.allclose(curve, (f(margin + e) - 2 * f(margin) + f(margin - e)) / e**2, atol=1e-5)


def plain_tree(x, g, h, edges, columns, depth, least):
    """Best splits by trying every edge and side on the raw rows; returns the value each row ends with."""
    out = np.empty(len(x))

    def grow(own, level):
        total = g[own].sum(), h[own].sum()
        best = (1e-6, None)
        if level < depth:
            for f in columns:
                for e in edges[f]:
                    for side in (True, False):
                        left = np.where(np.isnan(x[own, f]), side, x[own, f] <= e)
                        a, b = own[left], own[~left]
                        if h[a].sum() >= least and h[b].sum() >= least:
                            gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (a, b)) - total[0] ** 2 / (total[1] + 1)
                            if round(gain, 9) > round(best[0], 9):
                                best = gain, (a, b)
        if best[1]:
            for part in best[1]:
                grow(part, level + 1)
        else:
            out[own] = -total[0] / (total[1] + 1)

    grow(np.arange(len(x)), 0)
    return out


def test_a_tree_equals_plain_growth(spark, rows, monkeypatch):
    monkeypatch.setattr(growth, "BLOCK", 100)
    monkeypatch.setattr(growth, "ROWS_PER_TASK", 200)
    edges = growth.bin_edges(rows, COLUMNS)
    assert len(edges[0]) <= 40 and len(edges[1]) == 1
    grower = growth.Grower(growth.blocks_of(rows, COLUMNS, F.col("label"), 0.0, edges, None), edges, growth.logistic, 3, 1.0, 42, share=1.0)
    grower.grow()
    blocks = grower.look().collect()
    grower.close()
    assert sum(len(b.y) for b in blocks) == 900 and max(len(b.y) for b in blocks) <= 100
    data = rows.collect()
    x = np.array([[math.nan if r[c] is None else r[c] for c in COLUMNS] for r in data])
    y, own = np.array([r.label for r in data], float), np.array([not r.is_val for r in data])
    want = plain_tree(x[own], 0.5 - y[own], np.full(own.sum(), 0.25), edges, range(3), 3, 5.0)
    got = np.concatenate([b.margin[~b.held] for b in blocks])
    assert np.allclose(np.sort(got), np.sort(want))


def test_kept_round_is_the_best_by_average_precision(spark, rows, monkeypatch):
    """Each round once; the measures are those of the metrics operator on every prefix, and the kept one is the best."""
    monkeypatch.setattr(boosting, "LOOK_EVERY", 6)
    model = boosting.fit_gbt_classifier(rows, COLUMNS, F.col("label"), trees=20, depth=2, step=0.3, patience=8)
    whole = boosting.fit_gbt_classifier(rows, COLUMNS, F.col("label"), trees=20, depth=2, step=0.3, patience=100)
    held, best = rows.filter("is_val"), []
    for n in range(1, 21):
        prefix = boosting.Ensemble(whole.columns, whole.objective, whole.start, whole.roots[:n], whole.nodes, 20)
        if n <= whole.n_trees:
            scored = boosting.predict_probability(prefix, held, COLUMNS).withColumn("y", F.col("label"))
            best.append(metrics.average_precision(scored).first()[0])
    assert best == pytest.approx(whole.held_out[: len(best)])
    assert whole.n_trees == int(np.argmax(whole.held_out)) + 1 and len(whole.held_out) == 20
    kept = boosting.best_round(whole.held_out, 8)[0]
    assert model.n_trees == kept and model.held_out == pytest.approx(whole.held_out[: len(model.held_out)])
    assert max(model.held_out) > model.held_out[0]


@pytest.mark.parametrize("measures, patience, want", [([1, 3, 2, 2, 2, 9], 3, (2, True)), ([1, 3, 2, 2, 2, 9], 4, (6, False)), ([2, 2, 2], 5, (1, False)), ([], 5, (0, False))])
def test_best_round(measures, patience, want):
    assert boosting.best_round(measures, patience) == want


def test_model_does_not_depend_on_partitioning_and_can_be_stored(spark, rows, monkeypatch):
    one = boosting.fit_gbt_regressor(rows, COLUMNS, F.col("label"), trees=4)
    monkeypatch.setattr(growth, "BLOCK", 64)
    monkeypatch.setattr(growth, "ROWS_PER_TASK", 20)
    two = boosting.fit_gbt_regressor(rows.repartition(7), COLUMNS, F.col("label"), trees=4)
    assert one.n_trees == two.n_trees and (one.nodes["feature"] == two.nodes["feature"]).all() and np.allclose(one.nodes["value"], two.nodes["value"])
    path = f"{scratch_dir(spark)}/test-ensemble"
    one.save(spark, path)
    again = boosting.Ensemble.load(spark, path)
    assert again.held_out == one.held_out and again.columns == COLUMNS
    x = np.array([[1.0, 7.0, math.nan], [30.0, math.nan, 0.1]])
    assert again.margins(x).tolist() == one.margins(x).tolist()


def test_no_held_out_rows_or_no_rows_at_all(spark, rows):
    trained = rows.filter("NOT is_val")
    assert boosting.fit_gbt_classifier(trained, COLUMNS, F.col("label"), trees=3).n_trees == 3
    nothing = boosting.fit_gbt_classifier(rows.filter("false"), COLUMNS, F.col("label"), trees=2)
    assert np.allclose(nothing.margins(np.zeros((2, 3))), nothing.start)
    flat = boosting.fit_gbt_regressor(trained.withColumn("label", F.lit(3)), COLUMNS, F.col("label"), trees=2)
    assert np.allclose(flat.margins(np.zeros((1, 3))), 3.0)


def test_listwise_measure_is_ndcg(spark):
    rng = np.random.default_rng(4)
    data = [(c, i, float(rng.normal()) + (i == c % 15), float(rng.random()), int(i == c % 15 or rng.random() < 0.1), c % 4 == 0) for c in range(80) for i in range(15)]
    df = spark.createDataFrame(data, "customer_id bigint, item_idx int, a double, b double, label int, is_val boolean")
    model = boosting.fit_listwise(df, ["a", "b"], trees=6, depth=3, step=0.3)
    scored = boosting.predict_listwise(model, df.filter("is_val"), ["a", "b"]).collect()
    total, lists = 0.0, 0
    for c in {r.customer_id for r in scored}:
        own = [r for r in scored if r.customer_id == c]
        if any(r.label for r in own):
            by_score = sorted({r.score for r in own}, reverse=True)
            if len(by_score) < len(own):
                continue
            order = sorted(own, key=lambda r: -r.score)
            best = sum(1 / math.log2(k + 2) for k in range(min(12, sum(r.label for r in own))))
            total, lists = total + sum(r.label / math.log2(k + 2) for k, r in enumerate(order[:12])) / best, lists + 1
    assert max(model.held_out) >= model.held_out[0] and 0 < max(model.held_out) <= 1
    if lists == 20:
        assert total / lists == pytest.approx(model.held_out[model.n_trees - 1])
