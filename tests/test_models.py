"""Segmentation, repurchase, value: known answers and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.operators import boosting, repurchase, segment, value
from basketspark.operators.features import FEATURE_COLUMNS, RFM_COLUMNS
from basketspark.streaming.scoring import score_requests
from verification.queries import FIXED_BUYING, FIXED_CENTROIDS, FIXED_NAMES


def test_prepared_columns_are_standardised(ws):
    z = segment.prepare(ws.features("train"), ws.scaler)
    row = z.agg(*[F.avg(c).alias(f"m{c}") for c in segment.Z_COLUMNS], *[F.stddev_pop(c).alias(f"s{c}") for c in segment.Z_COLUMNS]).first()
    for c in segment.Z_COLUMNS:
        assert abs(row[f"m{c}"]) < 1e-9 and abs(row[f"s{c}"] - 1) < 1e-9


def test_kmeans_is_repeatable_and_matches_the_projection(ws):
    z = segment.prepare(ws.features("train"), ws.scaler)
    one, two = (segment.centroids_of(segment.fit_kmeans(z, 4, 2)) for _ in range(2))
    assert np.allclose(sorted(one), sorted(two))
    check = segment.segment_params_check(ws.features("test"), ws.kmeans(), ws.scaler).first()
    assert check["disagreements"] == 0 and check["customers"] > 0


def test_silhouette_blocks_equal_brute_force(ws):
    labelled = ws.segment_labels(FIXED_CENTROIDS)
    pdf = labelled.toPandas()
    x, lab = pdf[segment.Z_COLUMNS].to_numpy(), pdf["segment"].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == o].mean() for o in set(lab) - {lab[i]})
        s.append((b - a) / max(a, b))
    got = segment.silhouette(labelled).first()
    assert got["metric"] == "euclidean" and got["silhouette"] == pytest.approx(np.mean(s))
    assert segment.linear_silhouette(labelled).first()["metric"] == "squared_euclidean"


def test_silhouettes_of_all_k_compute_a_distance_once(spark, ws, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, z), int(i % 2), int(i % 3) if i else 7, None if i == 5 else 1) for i, z in enumerate(rng.normal(size=(90, 3)))]
    labelled = spark.createDataFrame(rows, "customer_id long, z_recency double, z_frequency double, z_monetary double, two int, four int, gap int")
    got = segment.silhouettes(labelled, ["two", "four", "gap"]).first()
    for c in ("two", "four", "gap"):
        assert got[c] == pytest.approx(segment.silhouette(labelled.withColumnRenamed(c, "segment")).first()["silhouette"])
    assert got["gap"] == 0.0 and segment.silhouettes(labelled.filter("false"), ["two"]).first()["two"] is None
    products, product = [], segment.grid_product
    monkeypatch.setattr(segment, "grid_product", lambda *a: products.append(a) or product(*a))
    found = segment.choose_k(ws.features("train"), range(2, 5), n_init=2).collect()
    assert [r["k"] for r in found] == [2, 3, 4] and len(products) == 1
    labels = segment.assign_labels(segment.prepare(ws.features("train"), ws.scaler), segment.centroids_of(
        segment.fit_kmeans(segment.prepare(ws.features("train"), ws.scaler), 3, 2)))
    assert found[1]["silhouette"] == pytest.approx(segment.silhouette(labels).first()["silhouette"])


def test_profile_and_quintiles(ws):
    n = ws.features("train").count()
    prof = segment.segment_profile(ws.features("train"), ws.segment_labels(FIXED_CENTROIDS)).toPandas()
    assert prof["customers"].sum() == n and abs(prof["pct_customers"].sum() - 100) < 0.5
    q = segment.rfm_quintiles(ws.features("train")).agg(F.min("rfm_score"), F.max("rfm_score"), F.count(F.lit(1))).first()
    assert 3 <= q[0] <= q[1] <= 15 and q[2] == n


def test_segment_names_follow_the_rule(spark):
    prof = spark.createDataFrame(
        [(0, 10.0, 9.0, 900.0), (1, 300.0, 5.0, 700.0), (2, 20.0, 2.0, 50.0), (3, 400.0, 1.0, 20.0)],
        "segment int, median_recency double, median_frequency double, median_monetary double")
    got = {r[0]: r[1] for r in segment.segment_names(prof).collect()}
    assert got == {0: "Champions", 1: "At-risk high-value", 2: "New / Low-value", 3: "Lapsed / One-off"}


def test_requests_are_validated_and_scored_as_a_stream(spark, ws, tmp_path):
    rows = [(1, "5", "40", "50000"), (2, "-5", "1", "10"), (3, "10", "0", "10"), (4, "yesterday", "1", "10"), (5, "3", "1", None)]
    schema = "customer_id bigint, recency string, frequency string, monetary string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = score_requests(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ws.scaler, FIXED_CENTROIDS, FIXED_NAMES)
    q = stream.writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {r["customer_id"]: r for r in spark.table("scored").collect()}
    assert got[1]["rejected_because"] is None and got[1]["segment_id"] is not None
    assert all(got[i]["rejected_because"] and got[i]["segment_id"] is None for i in (2, 3, 4, 5))


def test_unknown_customers_are_reported(spark, ws):
    ids = spark.createDataFrame([(1,), (10**9,)], "customer_id bigint")
    got = {r["customer_id"]: r["found"] for r in segment.segment_known(ids, ws.features("test"), ws.scaler, FIXED_CENTROIDS, FIXED_NAMES).collect()}
    assert got == {1: True, 10**9: False}


@pytest.fixture(scope="module")
def learnable(spark):
    """600 customers whose label follows recency, with missing gaps and all thirteen columns."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        recency, freq = float(rng.integers(0, 400)), int(rng.integers(1, 12))
        bought = int(rng.random() < 1 / (1 + math.exp((recency - 120) / 30)))
        rest = [float(rng.random()) for _ in range(len(FEATURE_COLUMNS))]
        r = dict(zip(FEATURE_COLUMNS, rest), recency=recency, frequency=float(freq), tenure=recency + 100)
        r["avg_days_between_orders"] = None if freq == 1 else 50.0
        rows.append((i, *[r[c] for c in FEATURE_COLUMNS], bought, bought * (50.0 + 10 * freq)))
    schema = "customer_id bigint, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", repurchased int, future_spend double"
    return spark.createDataFrame(rows, schema).cache()


def test_boosting_explanations_add_up(spark, learnable):
    model = repurchase.fit_classifier(learnable, trees=8)
    scored = repurchase.score(model, learnable)
    assert scored.filter(F.col("p").isNull() | (F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    c = boosting.contributions(model, learnable, FEATURE_COLUMNS)
    total = F.aggregate("contributions", F.col("base_value"), lambda s, x: s + x)
    gap = c.join(scored, "customer_id").agg(F.max(F.abs(total - F.log(F.col("p") / (1 - F.col("p")))))).first()[0]
    assert gap < 1e-6
    effects = {r["feature"]: r["mean_abs_effect"] for r in boosting.mean_absolute_effect(c, FEATURE_COLUMNS).collect()}
    assert max(effects, key=effects.get) in ("recency", "tenure")
    imp = {r["feature"]: r for r in boosting.importance_table(model, FEATURE_COLUMNS, spark).collect()}
    assert set(imp) == set(FEATURE_COLUMNS) and abs(sum(r["gain_pct"] for r in imp.values()) - 100) < 1
    table = {r["contender"]: r for r in repurchase.contender_table({
        "rule": repurchase.baseline_recency(learnable).withColumn("y", F.col("repurchased")), "trees": scored.withColumn("y", F.col("repurchased"))}).collect()}
    assert table["trees"]["pr_auc"] > table["trees"]["base_rate"] and table["rule"]["brier"] is None


def test_contributions_equal_brute_force_shapley(spark, learnable):
    """Path-dependent Shapley values by enumerating feature subsets of a tiny ensemble."""
    model = repurchase.fit_classifier(learnable, trees=2)
    leaves = boosting.ensemble_leaves(model)
    x = np.array([[r[c] if r[c] is not None else math.nan for c in FEATURE_COLUMNS] for r in learnable.limit(5).collect()])
    phi, _ = boosting._leaf_effects(x, leaves, len(FEATURE_COLUMNS))
    used = sorted({f for _, path in leaves for f, *_ in path})

    def expectation(row, known):
        return sum(v * math.prod(float(missing if math.isnan(row[f]) else lo < row[f] <= hi) if f in known else share for f, lo, hi, missing, share in path) for v, path in leaves)

    from itertools import combinations
    for row, got in zip(x, phi):
        for f in used:
            others = [o for o in used if o != f]
            want = sum(
                math.factorial(len(s)) * math.factorial(len(others) - len(s)) / math.factorial(len(used))
                * (expectation(row, {*s, f}) - expectation(row, set(s))) for n in range(len(others) + 1) for s in combinations(others, n))
            assert got[f] == pytest.approx(want, abs=1e-9)


def test_calibration_is_monotone_and_helps(spark):
    rng = np.random.default_rng(3)
    p = rng.random(4000)
    df = spark.createDataFrame([(i, int(rng.random() < min(1, q * 0.5 + 0.3)), float(q)) for i, q in enumerate(p)], "customer_id bigint, y int, p double")
    report = {r["stage"]: r for r in repurchase.calibration_report(repurchase.calibrate(df)).collect()}
    assert report["after"]["brier"] < report["before"]["brier"] and abs(report["after"]["gap"]) < abs(report["before"]["gap"])
    assert abs(report["after"]["roc_auc"] - report["before"]["roc_auc"]) < 0.02


def test_repeat_order_value_drops_the_first_order(spark):
    from tests.test_clean_split_features import DAY, purchases_frame, row

    rows = [row("A", price="1000"), row("B", price="10", at=DAY(2011, 2, 1)), row("C", price="20", at=DAY(2011, 3, 1)), row("D", price="500", customer=2)]
    assert [tuple(r) for r in value.repeat_order_value(purchases_frame(spark, rows)).collect()] == [(1, 15.0)]


def test_purchase_fit_recovers_simulated_parameters(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(4000):
        rate, drop, horizon, t, x, last = rng.gamma(0.6, 1 / 47.0), rng.beta(0.3, 1.2), float(rng.integers(30, 560)), 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / rate)
            if t > horizon:
                break
            x, last = x + 1, t
            if rng.random() < drop:
                break
        rows.append((i, float(x), last, horizon))
    fit = value.fit_purchases(spark.createDataFrame(rows, "customer_id bigint, x double, t_x double, t_total double"), penalty=0.0)
    assert fit.r == pytest.approx(0.6, rel=0.15) and fit.alpha == pytest.approx(47, rel=0.25)
    assert fit.a / (fit.a + fit.b) == pytest.approx(0.2, abs=0.06)


def test_spend_fit_and_guard(spark):
    rng = np.random.default_rng(4)
    rows, means = [], []
    for i in range(3000):
        x, nu = int(rng.integers(1, 9)), rng.gamma(3.8, 1 / 544.0)
        rows.append((i, float(x), 0.0, 0.0))
        means.append((i, float(rng.gamma(1.9 * x, 1 / (nu * x)))))
    fit = value.fit_spend(spark.createDataFrame(rows, "customer_id bigint, x double, t_x double, t_total double"),
                          spark.createDataFrame(means, "customer_id bigint, repeat_value double"))
    assert fit.q > 1 and fit.population_mean == pytest.approx(544 * 1.9 / 2.8, rel=0.15)
    with pytest.raises(ValueError, match="mean does not exist"):
        value.SpendParams(1.0, 0.9, 10.0)


def test_value_prediction_invariants(ws):
    rows = value.clv_prediction(ws.features("test"), ws.test.observation, FIXED_BUYING, value.SpendParams(1.896, 3.82, 544.11))
    bad = F.col("p").isNull() | (F.col("p") < 0) | (F.col("p_alive") < 0) | (F.col("p_alive") > 1) | (F.col("was_undefined") & (F.col("x") > 0))
    assert rows.filter(bad).count() == 0


def test_hurdle_and_regressors_are_non_negative(learnable):
    clf, reg = value.fit_hurdle(learnable, 5, 5)
    assert value.predict_hurdle(clf, reg, learnable).filter(F.col("p").isNull() | (F.col("p") < 0)).count() == 0
    for log in (False, True):
        out = value.predict_regressor(value.fit_regressor(learnable, log, 5), learnable, log)
        assert out.filter(F.col("p").isNull() | (F.col("p") < 0)).count() == 0
