"""Recommender: the two-family fixture, huge baskets, candidates, lists, rankers."""

from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.operators import clean, recommend
from basketspark.sources.ledger import LEDGER_SCHEMA


@pytest.fixture(scope="module")
def families(spark):
    """80 baskets of six products, even ones from family A by customer 1, odd ones from B by customer 2; one rare item."""
    rng, rows, start = np.random.default_rng(0), [], datetime(2011, 1, 1)
    for b in range(80):
        fam = "A" if b % 2 == 0 else "B"
        for i in rng.choice(15, 6, replace=False):
            rows.append((f"{b}", f"{fam}{i:02d}", f"item {fam}{i}", 1, start + timedelta(days=b), Decimal("2.5"), 1 if fam == "A" else 2, "UK"))
    rows.append(("0", "RARE", "rare", 1, start, Decimal("1"), 1, "UK"))
    return spark.createDataFrame(rows, LEDGER_SCHEMA).withColumn("line_total", clean.line_total()).cache()


@pytest.fixture(scope="module")
def items(families):
    return recommend.item_index(families).cache()


def test_rare_items_have_no_index(items):
    assert items.filter("stock_code = 'RARE'").count() == 0
    assert sorted(r[0] for r in items.select("item_idx").collect()) == list(range(items.count()))


def test_item2vec_separates_families_and_repeats(families, items):
    vec = recommend.item2vec(recommend.baskets(families), items, dim=16, epochs=20)
    again = recommend.item2vec(recommend.baskets(families), items, dim=16, epochs=20)
    a, b = vec.toPandas().sort_values("item_idx"), again.toPandas().sort_values("item_idx")
    m = np.stack(a["vector"])
    assert np.allclose(m, np.stack(b["vector"])) and np.allclose((m**2).sum(1), 1)
    fam = a["stock_code"].str[0].to_numpy()
    sims, same = m @ m.T, fam[:, None] == fam[None]
    off = ~np.eye(len(m), dtype=bool)
    assert sims[same & off].mean() > sims[~same].mean()


def test_copurchase_matches_brute_force_and_splits_huge_baskets(families, items):
    code = {r["item_idx"]: r["stock_code"] for r in items.collect()}
    held = {}
    for r in families.select("invoice", "stock_code").distinct().collect():
        held.setdefault(r[0], set()).add(r[1])
    for cell in (512, 2):  # 2 forces every basket through the group-of-groups join
        got = {(code[r["item_i"]], code[r["item_j"]]): r["n_baskets"] for r in recommend.copurchase(families, items, cell=cell).collect()}
        assert all(k[0][0] == k[1][0] for k in got)
        assert all(n == sum(a in s and b in s for s in held.values()) for (a, b), n in got.items())
        assert sum(got.values()) == sum(len(s - {"RARE"}) * (len(s - {"RARE"}) - 1) // 2 for s in held.values())


def test_large_baskets_come_out_in_parts(families):
    parts = recommend.baskets(families, part_size=3)
    whole = recommend.baskets(families)
    assert whole.agg(F.max("n_parts")).first()[0] == 1
    lines = lambda d: d.agg(F.sum(F.size("items"))).first()[0]
    assert lines(parts) == lines(whole) == families.count() and parts.agg(F.max("n_parts")).first()[0] > 1


def test_decay_weight(spark):
    cut = datetime(2011, 4, 1)
    rows = [(str(n), code, "d", 1, at, Decimal("1"), 1, "UK") for code, at in (("A", datetime(2011, 3, 31)), ("B", datetime(2010, 10, 2))) for n in range(10)]
    obs = spark.createDataFrame(rows, LEDGER_SCHEMA)
    w = {r["item_idx"]: r["weight"] for r in recommend.purchase_weights(obs, recommend.item_index(obs), cut).collect()}
    assert 0.2 < w[1] / w[0] < 0.3


def test_owned_copurchase_broadcast_and_shuffle_paths_agree(families, items, monkeypatch):
    w = recommend.purchase_weights(families, items, datetime(2011, 6, 1)).cache()
    pairs = recommend.copurchase(families, items).cache()
    small = {tuple(r) for r in recommend.owned_copurchase(w, pairs).collect()}
    monkeypatch.setattr(recommend, "PAIR_BROADCAST_ROWS", 0)
    assert {tuple(r) for r in recommend.owned_copurchase(w, pairs).collect()} == small


@pytest.mark.parametrize("chunk, cells, products", [(40, 1 << 22, 1 << 22), (2_000_000, 1 << 22, 7), (2_000_000, 20, 1 << 22)])
def test_wanted_copurchase_keeps_the_best_and_the_asked_scores(spark, families, items, chunk, cells, products, monkeypatch):
    monkeypatch.setattr(recommend, "TILE_CELLS", cells)
    monkeypatch.setattr(recommend, "TILE_PRODUCTS", products)
    w = recommend.purchase_weights(families, items, datetime(2011, 6, 1)).cache()
    w = w.filter("item_idx % 3 > 0").unionByName(w.limit(1).withColumn("customer_id", F.lit(3).cast("bigint"))).cache()
    pairs = recommend.copurchase(families, items).cache()
    full = {(r["customer_id"], r["item_idx"]): r["co_score"] for r in recommend.owned_copurchase(w, pairs).collect()}
    own = {(r["customer_id"], r["item_idx"]) for r in w.collect()}
    asked = spark.range(1, 4).select(F.col("id").alias("customer_id"), F.explode(F.array(*[F.lit(i) for i in range(0, 30, 4)])).alias("item_idx"))
    rows = recommend.wanted_copurchase(w, pairs, asked, k=4, pairs_per_chunk=chunk).collect()
    got = {(r["customer_id"], r["item_idx"]): r["co_score"] for r in rows}
    assert len(got) == len(rows) and all(full[key] == n for key, n in got.items())
    assert {(r[0], r[1]) for r in asked.collect()} & full.keys() <= got.keys()
    for c in (1, 2, 3):
        for left_out in (set(), own):
            best = sorted((key for key in full if key[0] == c and key not in left_out), key=lambda x: (-full[x], x[1]))[:4]
            assert set(best) <= got.keys()
    assert recommend.wanted_copurchase(w, pairs.limit(0)).count() == 0 == recommend.wanted_copurchase(w.limit(0), pairs).count()


def test_item_bought_ten_years_ago_is_still_owned(spark):
    cut = datetime(2011, 4, 1)
    rows = [(str(n), code, "d", 1, at, Decimal("1"), 1, "UK") for code, at in (("A", datetime(2001, 4, 1)), ("B", datetime(2001, 3, 1)), ("C", datetime(2011, 3, 1))) for n in range(5)]
    obs = spark.createDataFrame(rows, LEDGER_SCHEMA)
    items = recommend.item_index(obs)
    w = recommend.purchase_weights(obs, items, cut)
    assert all(r["weight"] > 0 for r in w.collect())
    code = {r["item_idx"]: r["stock_code"] for r in items.collect()}
    assert [code[r["item_idx"]] for r in recommend.baseline_repeat(w).orderBy("rank").collect()] == ["C", "A", "B"]
    none = spark.createDataFrame([], "customer_id bigint, item_idx int, similarity double")
    best = spark.createDataFrame([(0, 1)], "item_idx int, rank int")
    kept = recommend.candidate_history(recommend.build_candidates(w, none, best))
    assert kept.count() == kept.filter("bought_before = 1").count() == 3


def test_candidates_hold_everything_once(ws):
    c = ws.candidates("test", "external")
    assert c.count() == c.select("customer_id", "item_idx").distinct().count()
    assert ws.weights("test").join(c, ["customer_id", "item_idx"], "left_anti").count() == 0
    labelled = recommend.label_candidates(c, ws.truth("test"))
    assert labelled.agg(F.sum("label")).first()[0] == c.join(ws.truth("test"), ["customer_id", "item_idx"]).count()


def test_copurchase_lists_are_full_and_respect_ownership(families, items):
    w = recommend.purchase_weights(families, items, datetime(2011, 6, 1)).cache()
    scores = recommend.owned_copurchase(w, recommend.copurchase(families, items))
    n = items.count()
    every = recommend.baseline_copurchase(w, scores, n, k=12)
    assert {r["count"] for r in every.groupBy("customer_id").count().collect()} == {12}
    fresh = recommend.baseline_copurchase(w, scores, n, k=12, exclude_own=True)
    assert fresh.join(w, ["customer_id", "item_idx"]).count() == 0
    assert fresh.select("customer_id", "item_idx").distinct().count() == fresh.count() > 0


def test_top_k_and_strip_owned(spark):
    scored = spark.createDataFrame([(1, 5, .1), (1, 6, .9), (1, 7, .5)], "customer_id int, item_idx int, score double")
    best = recommend.top_k(scored, 2)
    assert [(r["item_idx"], r["rank"]) for r in best.orderBy("rank").collect()] == [(6, 1), (7, 2)]
    owned = spark.createDataFrame([(1, 6)], "customer_id int, item_idx int")
    assert [tuple(r) for r in recommend.recs_new_only(best, owned, 2).collect()] == [(1, 7, 1)]


def test_final_recall_stays_below_the_ceiling(ws):
    from basketspark.operators import metrics

    ceiling = recommend.candidate_ceiling(ws.candidates("test", "external"), ws.truth("test")).first()["recall"]
    assert metrics.rank_metrics(recommend.baseline_repeat(ws.weights("test")), ws.truth("test")).first()["recall"] <= ceiling


def test_listwise_ranker_learns_the_useful_signal(spark):
    from basketspark.operators import boosting

    rng, rows = np.random.default_rng(1), []
    for c in range(120):
        good = rng.integers(0, 10)
        for i in range(10):
            rows.append((c, i, float(i == good) + rng.normal(0, .2), float(rng.random()), int(i == good), c % 5 == 0))
    df = spark.createDataFrame(rows, "customer_id bigint, item_idx int, a double, b double, label int, is_val boolean")
    model = boosting.fit_listwise(df, ["a", "b"], trees=4, depth=2)
    top = recommend.top_k(boosting.predict_listwise(model, df, ["a", "b"]), 1).join(df, ["customer_id", "item_idx"])
    assert top.agg(F.avg("label")).first()[0] > 0.9
