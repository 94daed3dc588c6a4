"""Ranks, quantiles, joins and vector blocks against brute force, including heavy keys."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketspark.functions import joins, ranks, vectors
from basketspark.operators import metrics
from basketspark.session import cut_lineage


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 scores of which a third are equal."""
    rng = np.random.default_rng(1)
    values = np.where(np.arange(2000) % 3 == 0, 0.5, np.round(rng.random(2000), 2))
    return pd.DataFrame({"customer_id": np.arange(2000), "p": values, "y": (rng.random(2000) < values).astype(int)})


def test_global_row_number_equals_plain_window(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = ranks.global_row_number(df, [F.desc("p"), F.asc("customer_id")])
    want = F.row_number().over(Window.orderBy(F.desc("p"), F.asc("customer_id")))
    assert got.withColumn("w", want).filter((F.col("w") != F.col("rn")) | (F.col("rn_total") != 2000)).count() == 0


def test_score_ranks_and_attach(spark, skewed):
    df = spark.createDataFrame(skewed)
    per = ranks.score_ranks(df, "p")
    got = ranks.attach_by_score(df, per, "p", ["avg_rank", "first_rank"]).toPandas().sort_values("customer_id")
    assert len(got) == 2000
    assert np.allclose(got["avg_rank"], skewed["p"].rank())
    assert np.allclose(got["first_rank"], skewed["p"].rank(method="min"))


@pytest.mark.parametrize("n,k", [(1, 10), (2, 10), (10, 10), (11, 5), (1499, 10)])
def test_rank_bucket_matches_quantile_cut(spark, n, k):
    got = spark.range(1, n + 1).select(F.col("id"), ranks.rank_bucket(F.col("id"), F.lit(n), k).alias("b")).toPandas()["b"]
    edges = np.quantile(np.arange(1, n + 1), np.linspace(0, 1, k + 1)) if n > 1 else None
    want = [1] * n if n == 1 else [max(1, int(np.searchsorted(edges[1:] + 1e-9, r)) + 1) for r in range(1, n + 1)]
    assert list(got) == want


def test_grouped_quantiles(spark, skewed):
    df = spark.createDataFrame(skewed.assign(g=skewed["customer_id"] % 3))
    got = {(r["g"], r["prob"]): r["quantile"] for r in ranks.grouped_quantiles(df, "g", "p", [0.1, 0.5, 1.0]).collect()}
    want = skewed.groupby(skewed["customer_id"] % 3)["p"].quantile([0.1, 0.5, 1.0])
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()) and len(got) == 9


def test_value_bucket_rejects_repeated_edges():
    with pytest.raises(ValueError):
        ranks.value_bucket(F.col("x"), [0.0, 1.0, 1.0])


def test_salted_join_keeps_every_row_of_a_heavy_key(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    other = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        want = {tuple(r) for r in big.join(other, "k", how).select("k", "id", "v").collect()}
        got = joins.salted_join(big, other, "k", how, rows_per_salt=100).select("k", "id", "v").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    looked = joins.lookup_join(big, other, "k", max_broadcast_rows=5)
    assert looked.count() == big.join(other, "k").count()


def test_salted_join_splits_a_key_that_is_light_left_and_heavy_right(spark):
    big = spark.createDataFrame([(7, i) for i in range(12)] + [(8, 0), (9, 1)], "k int, id int")
    other = spark.range(3000).select(F.when(F.col("id") < 2900, 7).otherwise(8).cast("int").alias("k"), F.col("id").alias("v"))
    want = {tuple(r) for r in big.join(other, "k").select("k", "id", "v").collect()}
    for limits in ({"rows_per_salt": 500}, {"pairs_per_task": 1000}):
        joined = joins.salted_join(big, other, "k", **limits)
        got = [tuple(r) for r in joined.select("k", "id", "v").collect()]
        assert set(got) == want and len(got) == len(want)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "_band" in plan and "_strip" in plan
    assert joins.salted_join(big, other, "k", "left", rows_per_salt=5, unique=True).count() == len(want) + 1


@pytest.mark.parametrize("chunks", [(64, 50), (4096, 8192)])
def test_top_n_equals_brute_force_with_ties(spark, chunks):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(150, 8)), rng.normal(size=(120, 8))
    b[60:] = b[:60]  # every item has a twin
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "u int, vector array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "i int, vector array<double>")
    got = vectors.top_n_by_similarity(left, right, "u", "i", 7, False, *chunks).toPandas().sort_values(["u", "rank"])
    sims = np.round(a @ b.T, vectors.SIM_DECIMALS)
    want = np.array([np.lexsort((np.arange(120), -row))[:7] for row in sims])
    assert (got["i"].to_numpy().reshape(150, 7) == want).all()


def test_top_n_with_itself_excludes_self(spark):
    rows = [(i, [1.0, 0.1 * i]) for i in range(30)]
    df = vectors.top_n_by_similarity(*[spark.createDataFrame(rows, "i int, vector array<double>")] * 2, "i", "i", 5, True, 8, 8)
    assert df.count() == 150 and df.filter(F.col("i") == F.col("_other")).count() == 0


def test_unit_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>").select(vectors.unit(F.col("v")).alias("u"))
    assert [r["u"] for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_classification_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "y int, p double")
    m = metrics.classification_metrics(df).first()
    # thresholds 0.9: precision 1, recall 1/2; 0.8: precision 2/3, recall 1
    assert m["pr_auc"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert m["roc_auc"] == pytest.approx((2 + 1.5) / 4)
    assert m["brier"] == pytest.approx((0.01 + 0.64 + 0.04 + 0.01) / 4)
    neg = metrics.classification_metrics(df.withColumn("p", -F.col("p") * 10)).first()
    assert neg["brier"] is None and neg["roc_auc"] is not None


def test_lift_table_invariants(spark, skewed):
    t = metrics.lift_table(spark.createDataFrame(skewed)).toPandas().sort_values("decile")
    assert t["customers"].sum() == 2000 and t["cumulative_capture"].iloc[-1] == pytest.approx(1)
    assert t["actual_rate"].iloc[0] > t["actual_rate"].iloc[-1]


def test_regression_metrics_constant_and_order(spark):
    y = [0.0, 10.0, 200.0, 5.0]
    const = spark.createDataFrame([(v, 53.75) for v in y], "y double, p double")
    m = metrics.regression_metrics(const).first()
    assert m["spearman"] is None and m["r2"] == pytest.approx(0)
    m = metrics.regression_metrics(spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (5000.0, 5.0), (5.0, 5.0)], "y double, p double")).first()
    assert m["rmse"] >= m["mae"]


def test_spearman_with_heavy_ties(spark, skewed):
    df = spark.createDataFrame(skewed)
    want = skewed["p"].rank().corr(skewed["y"].rank())
    assert metrics.spearman(df, "p", "y").first()[0] == pytest.approx(want)


@pytest.mark.parametrize("recs,truth,k,want", [
    ([10, 11, 12, 13], [10, 12, 20, 21], 4, (0.5, 0.5, (1 + 2 / 3) / 4, 1.5 / sum(1 / np.log2(i) for i in range(2, 6)))),
    ([1, 2, 3], [1, 2, 3], 3, (1, 1, 1, 1)),
    ([7, 8, 9], [1, 2, 3], 3, (0, 0, 0, 0)),
])
def test_rank_metrics_by_hand(spark, recs, truth, k, want):
    r = spark.createDataFrame([(1, i, n + 1) for n, i in enumerate(recs)], "customer_id int, item_idx int, rank int")
    t = spark.createDataFrame([(1, i) for i in truth], "customer_id int, item_idx int")
    m = metrics.rank_metrics(r, t, k).first()
    assert (m["recall"], m["precision"], m["map"], m["ndcg"]) == pytest.approx(want) and m["customers_scored"] == 1


def test_rank_metrics_count_customers_without_a_list(spark):
    r = spark.createDataFrame([(1, 1, 1)], "customer_id int, item_idx int, rank int")
    t = spark.createDataFrame([(1, 1), (2, 5)], "customer_id int, item_idx int")
    m = metrics.rank_metrics(r, t, 1).first()
    assert m["customers_scored"] == 2 and m["recall"] == 0.5


def test_top_n_moves_the_left_side_only_and_merges_repeated_ids(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(150, 6)), rng.normal(size=(70, 6)).round(1)
    b[40:] = b[:30]  # ties
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "u long, vector array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "i int, vector array<double>")
    once = vectors.top_n_by_similarity(left, right, "u", "i", 9, False, 64, 16)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "CoGroup" not in plan and "Window" not in plan

    def best(ids):
        sims = np.round(np.concatenate([b @ a[i] for i in ids]), vectors.SIM_DECIMALS)
        items = np.concatenate([np.arange(len(b))] * len(ids))
        return [(int(items[j]), sims[j]) for j in np.lexsort((items, -sims))[:9]]

    got = {}
    for r in once.collect():
        got.setdefault(r["u"], []).append((r["rank"], r["i"], r["similarity"]))
    assert {u: [x[1:] for x in sorted(f)] for u, f in got.items()} == {u: best([u]) for u in range(150)}
    pairs = left.withColumn("u", F.floor(F.col("u") / 2))  # two rows an id: one list
    got = {}
    for r in vectors.top_n_by_similarity(pairs, right, "u", "i", 9, False, 64, 16).collect():
        got.setdefault(r["u"], []).append((r["rank"], r["i"], r["similarity"]))
    assert {u: [x[1:] for x in sorted(f)] for u, f in got.items()} == {u: best([2 * u, 2 * u + 1]) for u in range(75)}


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split(" ")

    before = set(files())
    kept = cut_lineage(spark.range(5000).repartition(7, "id"))
    until = time.time() + 20
    while (left := {f for f in set(files()) - before if "/shuffle_" in f}) and time.time() < until:
        time.sleep(0.2)
    assert kept.count() == 5000 and not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_owned_vector_sums_equal_the_join_without_shuffling_it(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(int(c), int(i), float(w)) for c, i, w in zip(rng.integers(0, 40, 900), rng.integers(0, 60, 900), rng.random(900))] + [(99, 999, 1.0)],
                                 "c long, i int, w double")
    held = [(i % 50, rng.normal(size=5).tolist()) for i in range(55)] + [(50, [1.0, None, 2.0, 3.0, 4.0]), (51, None)]  # five items twice
    items = spark.createDataFrame(held, "i int, vector array<double>")
    sums = vectors.owned_vector_sums(rows, items, "c", "i", "w", rows_at_once=100)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    got = {r["c"]: r["vector"] for r in sums.collect()}
    want = {r["c"]: r["vector"] for r in vectors.weighted_vector_sum(rows.join(items.filter("vector IS NOT NULL"), "i"), "c", "w", "vector", 5).collect()}
    assert set(got) == set(want) and 99 not in got and all(got[c] == pytest.approx(want[c]) for c in want)
