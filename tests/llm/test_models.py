"""Language model, neighbour search, near-duplicates and the pipeline against brute force."""

import itertools
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketspark.llm import decontaminate, language_model, near_duplicates, neighbours, queries
from basketspark.llm.common import words
from basketspark.llm.components import components

SMALL = "/root/testdata/sf0.001"


def given(name, *columns, folder=SMALL):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{folder}/{name}.parquet'").fetchall()


def tokens_of(text):
    return [*words(text), None]


def test_base_and_counts_equal_brute_force(spark):
    texts = dict(given("documents", "doc_id", "text"))
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(t for d, x in texts.items() if not held[d] for t in tokens_of(x))
    n, v = sum(counts.values()), len(counts)
    rows = queries.op4_language_model(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens_of(texts[r.doc_id])
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(counts[t] > 0 for t in own), n)
        assert r.base_score == pytest.approx(base)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 1.02 * sum(r.base_score for r in out)  # both are negative: less likely under the base


def test_mixture_equals_brute_force(spark):
    texts = {1: "a b a b c", 2: "a b B d", 3: None, 4: "e a b", 5: "c a a b z", 6: ""}
    learn = {k for k in texts if k != 5}
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language_model.score_documents(docs, F.col("doc_id") != 5, tokens_per_block=4, tokens_per_shard=3).collect()}
    runs = {k: [0, *tokens_of(t)] for k, t in texts.items()}
    count = lambda ks, n: Counter(tuple(runs[k][i : i + n]) for k in ks for i in range(len(runs[k]) - n + 1))
    cells = Counter()
    for k in learn:
        uni, bi = count(learn - {k}, 1), count(learn - {k}, 2)
        rest = sum(len(runs[d]) - 1 for d in learn - {k})
        for a, b in itertools.pairwise(runs[k]):
            before = uni[(a,)]
            cells[(int(language_model.bucket(np.array(before))), *(int(language_model.cell(np.array(p))) for p in (bi[(a, b)] / before if before else 0, uni[(b,)] / rest)))] += 1
    import pandas as pd

    uni, bi = count(learn, 1), count(learn, 2)
    n, v = sum(len(runs[d]) - 1 for d in learn), len(uni) - 1
    weights = language_model.mixture_weights(pd.DataFrame([(*c, k) for c, k in cells.items()], columns=["bucket", "pair_cell", "word_cell", "n"]), v)
    for k, run in runs.items():
        want = 0
        for a, b in itertools.pairwise(run):
            w = weights[int(language_model.bucket(np.array(uni[(a,)])))]
            want += math.log10(w[0] * (bi[(a, b)] / uni[(a,)] if uni[(a,)] else 0) + w[1] * uni[(b,)] / n + w[2] / (v + 1))
        assert got[k].score == pytest.approx(want)
    assert np.allclose(weights.sum(axis=1), 1) and got[5].n_known == 5


def test_language_model_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (7, None), (7, "x " * 50_000), (-1, "")], "doc_id long, text string")
    rows = language_model.score_documents(docs, F.lit(True), tokens_per_block=10_000).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 3, 50_001] and sum(r.doc_id is None for r in rows) == 1
    assert all(r.score <= 0 for r in language_model.score_documents(docs, F.lit(False)).collect())
    assert language_model.score_documents(docs.filter("false"), F.lit(True)).count() == 0


def brute_neighbours(vectors, asked, k=20):
    out = {}
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float64)
    for q in asked:
        s = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), s[i]) for i in order]
    return out


def test_neighbour_recall(spark):
    folder = "/root/testdata/sf0.1"
    vectors = given("embeddings", "vec_id", "embedding", folder=folder)
    want = brute_neighbours(vectors, [i for i, _ in vectors if i % 20 == 0])
    got = {}
    for r in queries.op3_neighbours(spark, folder).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(f) == list(range(1, 21)) for f in got.values())
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = {(q, v): s for q in want for v, s in want[q]}
    assert all(s == pytest.approx(exact[(q, v)], abs=1e-12) for q in got for v, s in got[q].values() if (q, v) in exact)


def test_neighbour_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(40)]
    rows += [(100 + i, [3.0] * 8) for i in range(60)]
    odd = [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [float("inf")] + [0.0] * 7), (280, [1.0, None] + [0.0] * 6), (300, [1.0]), (320, [])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, label int")
    clean = [(i, np.float32(v).astype(float)) for i, v in rows]
    got = {}
    for r in neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = brute_neighbours(clean, [i for i, _ in rows if i % 20 == 0])
    assert {q: [v for _, v in sorted(f)] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items()}
    few = neighbours.nearest(vectors.filter("vec_id < 5"), F.col("vec_id") == 0).collect()
    assert [r.rank for r in sorted(few, key=lambda r: r.rank)] == [1, 2, 3, 4]
    assert neighbours.nearest(vectors.filter("false"), F.lit(True)).count() == 0


def test_rows_of_the_query_s_own_id_take_no_place_in_its_list(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(60, 8))
    twice = [(i, x.tolist()) for i, x in enumerate(v) for _ in range(2)]  # every row twice
    many = [(1000, (10 + rng.normal(size=8)).tolist()) for _ in range(300)]  # one id, many vectors, all long and alike
    copies = [(2000, v[0].tolist())] * 50 + [(2000 + i, v[0].tolist()) for i in range(1, 5)]
    vectors = spark.createDataFrame(twice + many + copies, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(vectors, F.col("vec_id").isin(0, 20, 1000, 2000)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = brute_neighbours(twice + many + copies, [20])
    assert sorted(got[20]) == sorted([*enumerate((i for i, _ in want[20]), 1)] * 2)  # asked twice
    assert all(i != q for q, found in got.items() for _, i in found)
    assert {r for r, _ in got[0]} == {r for r, _ in got[1000]} == {r for r, _ in got[2000]} == set(range(1, 21))


def test_all_namers_of_a_node_meet_its_neighbours_in_small_groups(spark):
    near = {i: [0, 1 + i % 7, 8 + i % 5] for i in range(20, 600)}
    near |= {i: [20 + i, 40 + i, 60 + i] for i in range(20)}
    rows = [(i, np.array(a, np.int64).tobytes(), np.ones(3, np.float32).tobytes()) for i, a in near.items()]
    groups = {}
    for r in neighbours.meetings(spark.createDataFrame(rows, neighbours.GRAPH), 8).collect():
        groups.setdefault(r["group"], set()).add(r["member"])
    shared = {(a, b) for g in groups.values() for a in g for b in g}
    assert all((i, other) in shared for i, a in near.items() for c in a for other in near[c])
    assert max(map(len, groups.values())) < 40  # node 0 is named by 580


def test_codes_keep_direction_and_length_over_many_orders():
    x = np.random.default_rng(4).normal(size=(50, 16)) * np.logspace(-200, 200, 50)[:, None]
    direction, length = neighbours.stacked(pd.Series(neighbours.coded(x, np.abs(x).max())))
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert np.allclose(direction, unit, atol=1e-3) and (np.diff(length) >= 0).all() and np.isfinite(length).all()
    assert len(neighbours.products(direction[0], pd.Series([], dtype=object))) == 0


def test_neighbour_recall_with_unequal_norms(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4000, 32))
    v = v / np.linalg.norm(v, axis=1)[:, None] * rng.lognormal(0, 0.5, 4000)[:, None]
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(vectors, F.col("vec_id") % 40 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_neighbours(list(enumerate(v)), range(0, 4000, 40))
    hits = sum(len(got[q] & {v for v, _ in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * 20 * len(want)


def test_neighbour_recall_without_structure(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(6000, 128))
    v /= np.linalg.norm(v, axis=1)[:, None]
    vectors = spark.createDataFrame(pd.DataFrame({"vec_id": range(6000), "embedding": list(v)}))
    got = {}
    for r in neighbours.nearest(vectors, F.col("vec_id") % 40 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_neighbours(list(enumerate(v)), range(0, 6000, 40))
    hits = sum(len(got[q] & {v for v, _ in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.99 * 20 * len(want)


def test_exact_check_finds_all_above_the_floor(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SENT_BYTES", 300)
    v = np.random.default_rng(6).integers(-2, 3, size=(700, 6)).astype(float)
    nodes = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "node long, v array<double>").repartition(3)
    asked = nodes.filter("node < 30").select(F.col("node").alias("query"), "v", F.when(F.col("node") < 15, float("-inf")).otherwise(15.0).alias("floor"))
    found = neighbours.not_below(asked, nodes, neighbours.Written(spark, "check"), 5)
    got = {}
    for r in found.collect():
        got.setdefault(r["query"], {})[r["node"]] = r["score"]
    for q in range(30):
        s = v @ v[q]
        least = max(np.sort(s)[-5], 15 if q >= 15 else -np.inf)
        assert {i for i in range(700) if s[i] >= least} <= set(got.get(q, {})) and all(x == s[i] for i, x in got.get(q, {}).items())
    truth = neighbours.last_of_best(found.filter("query < 15"), 5, "least")
    assert neighbours.recall(found, truth, 5) == 1.0
    best_only = found.filter("query < 15").groupBy("query").agg(F.max("score").alias("score")).withColumn("node", F.col("query"))
    assert neighbours.recall(best_only, truth, 5) == 0.0
    assert neighbours.recall(found.filter("false"), truth.filter("false"), 5) == 1.0


def test_a_round_of_the_neighbour_search_runs_python_few_times(spark, monkeypatch):
    steps, keep = {}, neighbours.Written.keep

    def counted(self, df, name):
        steps[name] = df._jdf.queryExecution().optimizedPlan().toString().count("InPandas ")
        return keep(self, df, name)

    monkeypatch.setattr(neighbours.Written, "keep", counted)
    v = np.random.default_rng(7).normal(size=(300, 8))
    vectors = spark.createDataFrame(pd.DataFrame({"vec_id": range(300), "embedding": list(v)}))
    assert neighbours.nearest(vectors, F.col("vec_id") % 100 == 0).count() == 60
    assert steps["walk1"] == 1  # each costs a task a partition, in every round
    assert steps["graph1"] <= 4


def test_merged_lists_tell_what_is_new(spark):
    def part(node, held, **found):
        ids, sims = np.array([int(i[1:]) for i in found], np.int64), np.array(list(found.values()), np.float32)
        return node, ids.tobytes(), sims.tobytes(), held

    parts = [part(1, True, n2=0.9, n3=0.5), part(1, False, n3=0.5, n4=0.7, n1=1.0), part(2, True, n1=0.9), part(2, False, n1=0.9), part(3, False, n1=0.5, n4=0.5)]
    rows = {r.node: r for r in neighbours.merged(spark.createDataFrame(parts, f"{neighbours.GRAPH}, held boolean"), 2).collect()}
    lists = {n: np.frombuffer(r.near, np.int64).tolist() for n, r in rows.items()}
    assert lists == {1: [2, 4], 2: [1], 3: [1, 4]}
    assert {n: r.fresh for n, r in rows.items()} == {1: 1, 2: 0, 3: 2}
    assert rows[1].worst == pytest.approx(0.7) and rows[2].worst == -np.inf and rows[3].worst == 0.5


def test_first_lists_compare_every_order_on_its_own(spark):
    x = np.random.default_rng(8).normal(size=(700, 6))
    nodes = spark.createDataFrame(pd.DataFrame({"node": range(700), "code": neighbours.coded(x, np.abs(x).max())}))
    for tasks in (1, 4):
        found = neighbours.first_lists(nodes, 5, 3, tasks, run=32).collect()
        direction, length = neighbours.stacked(pd.Series(neighbours.coded(x, np.abs(x).max())))
        seen = {}
        for r in found:
            near, sim = np.frombuffer(r.near, np.int64), np.frombuffer(r.sim, np.float32)
            assert r.node not in near and len(set(near)) == len(near) <= 5
            assert np.allclose(sim, (direction[near] @ direction[r.node]) * length[near], atol=1e-5)
            seen[r.node] = seen.get(r.node, 0) + (len(near) == 5)
        assert set(seen) == set(range(700)) and min(seen.values()) >= 1 and sum(seen.values()) >= 0.95 * 3 * 700


def brute_components(texts, n, percent):
    sets = {d: decontaminate.real_shingles(words(t), n) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(sorted(d for d in sets if sets[d]), 2):
        shared = len(sets[a] & sets[b])
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}


def test_near_duplicates_equal_brute_force(spark):
    texts = dict(given("documents", "doc_id", "text"))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op9_near_duplicates(spark, SMALL).collect()}
    assert got == brute_components(texts, 2, 80)


def test_chains_and_large_groups(spark):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 120)]
    texts = {}
    for k in range(700):  # all near the base, some by a chain only
        own = list(base)
        for at in rng.integers(0, 120, 1 + k % 6):
            own[at] = f"n{k}-{at}"
        texts[k] = " ".join(own)
    chain = [f"c{k}" for k in range(60)]
    for k in range(40):
        texts[1000 + k] = " ".join(chain)
        chain[k % 60] = f"d{k}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicate_classes(docs, 2, 80).collect()}
    assert got == brute_components(texts, 2, 80)


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c"), (5, "a b c"), (4, "A  b\tC"), (9, None), (8, ""), (7, " \n"), (3, "one"), (2, "ONE"), (2, "a b c"), (1, "x " * 30_000)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, set_id string")
    out = sorted([tuple(r) for r in near_duplicates.near_duplicate_classes(docs, 2).collect()], key=str)
    assert out == sorted([(None, 2, None, True), (5, 2, 2, False), (4, 2, 2, False), (9, 0, 9, True), (8, 0, 8, True), (7, 0, 7, True), (3, 1, 2, False), (2, 1, 2, True), (2, 2, 2, True), (1, 1, 1, True)], key=str)
    kept = near_duplicates.deduplicated(docs, 2)
    assert kept.columns == docs.columns and kept.count() == 7
    assert near_duplicates.near_duplicate_classes(docs.filter("false")).count() == 0


def test_deduplication_judges_rows(spark):
    rows = [(3, "a b c"), (5, "a b c"), (5, "unique text"), (7, "p q r"), (7, "p q r"), (None, "u v w"), (None, "u v w"), (None, "x y z"), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(3, "a b c"), (5, "unique text"), (7, "p q r"), (None, "u v w"), (None, "x y z"), (None, ""), (None, "")]
    assert sorted(map(tuple, near_duplicates.deduplicated(docs).collect()), key=str) == sorted(want, key=str)


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 102), (102, 101), (7, 7), (200, 201), (201, 200)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(k, 0) for k in range(51)} | {(k, 100) for k in (100, 101, 102)} | {(200, 200), (201, 200)}


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs, now = dict(given("documents", "doc_id", "text", folder=folder)), spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicates", "decontamination", "packing"]
    labels = dict(given("labels", "doc_id", "quality", folder=folder))
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = near_duplicates.Written(spark, "test").keep(stage(spark, now, folder), "stage")
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in now.select("doc_id").collect()})
    good = [d for d, q in labels.items() if q]
    assert sum(d in kept[0] for d in good) > 0.97 * len(good) and sum(d in kept[0] for d, q in labels.items() if not q) < 0.2 * (len(labels) - len(good))
    classes = brute_components({d: docs[d] for d in kept[0]}, 5, 80)
    assert kept[1] == {d for d, (_, _, own) in classes.items() if own}
    items = [decontaminate.real_shingles(decontaminate.lowered(t), 5) for (t,) in given("benchmark", "text", folder=folder)]
    leaks = {d for d in kept[1] if any(len(i & decontaminate.real_shingles(decontaminate.lowered(docs[d]), 5)) >= 0.8 * len(i) for i in items)}
    assert kept[2] == kept[1] - leaks and leaks
    out = corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()
    assert {r.doc_id for r in out} == kept[2]
