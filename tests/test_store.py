"""Stored artefacts: a second session over the same ledger fits nothing, a changed one shares nothing."""

import pytest
from pyspark.sql import functions as F

from basketspark.operators import boosting, recommend, segment, value
from basketspark.plans import store
from basketspark.plans.workspace import Workspace
from basketspark.session import scratch_dir
from basketspark.sources.order_tables import ledger_from_orders

SMALL = "/root/testdata/sf0.001"


def test_content_digest_sees_rows_and_not_their_order(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None), (2, "b", None)], "i int, s string, x double")
    one = store.content_digest(df)
    assert store.content_digest(df.repartition(5)) == store.content_digest(df.orderBy(F.desc("i"))) == one
    changed = [df.filter("i = 1"), df.union(df), df.distinct(), df.withColumn("x", F.coalesce("x", F.lit(0.0))), df.withColumnRenamed("x", "y"), df.filter("false")]
    digests = [store.content_digest(d) for d in changed]
    assert one not in digests and len(set(digests)) == len(digests)


def test_register_keeps_complete_artefacts_only(spark):
    root = f"{scratch_dir(spark)}/store-test"
    kept = store.ArtefactStore(spark, root, "d1")
    with pytest.raises(ZeroDivisionError):
        kept.table("t", lambda: 1 / 0)
    assert store.ArtefactStore(spark, root, "d1").entries == {}
    assert kept.table("t", lambda: spark.range(3)).count() == 3
    other = store.ArtefactStore(spark, root, "d1")
    assert other.table("t", lambda: 1 / 0).count() == 3  # found, so not built
    assert other.model("m", lambda: {"a": [1, 2.5]}, "json") == store.ArtefactStore(spark, root, "d1").model("m", lambda: 1 / 0, "json")
    assert store.ArtefactStore(spark, root, "d2").entries == {}
    late = store.ArtefactStore(spark, root, "d1")
    late.entries.pop("t")  # a session that has not seen the entry yet: the first one counts
    assert late.table("t", lambda: spark.range(9)).count() == 3


def test_digest_of_a_derived_ledger_is_that_of_its_tables(spark):
    def digest(*tables):
        return Workspace(spark, lambda: 1 / 0, "derived", sources=lambda: [*tables]).digest  # the ledger itself is not built for it

    one = digest(spark.range(3), spark.range(5))
    assert one == digest(spark.range(3).repartition(2), spark.range(5))
    assert len({one, digest(spark.range(4), spark.range(5)), digest(spark.range(5), spark.range(3)), digest(spark.range(3))}) == 4


def test_second_session_answers_metrics_without_a_fit(spark, monkeypatch):
    root, trees = f"{scratch_dir(spark)}/store-sessions", {"classifier": 3, "regressor": 3, "ranker": 2, "listwise": 2}

    def session(**changed):
        return Workspace(spark, lambda: ledger_from_orders(spark, SMALL), "small", store=root, **{"trees": trees, "n_init": 2, "depth": 2, **changed})

    first = session()
    rows = sorted(map(tuple, first.metrics().collect()), key=str)
    segments = first.fitted_segments()
    assert {r[0] for r in rows} == {"repurchase", "value", "recommender"}

    def refuse(*args, **kwargs):
        raise AssertionError("fitted again")

    for module, names in {boosting: ("fit",), value: ("fit_purchases", "fit_spend"), segment: ("fit_kmeans", "fit_scaler"), recommend: ("item2vec", "retrieve_top_n")}.items():
        for name in names:
            monkeypatch.setattr(module, name, refuse)
    second = session()
    assert sorted(map(tuple, second.metrics().collect()), key=str) == rows
    assert second.fitted_segments() == segments and second.value_params() == first.value_params()
    assert second.classifier().held_out == first.classifier().held_out
    assert second.scaler == first.scaler
    history = store.metrics_history(spark, root, [first.digest, "unknown"])
    assert history.count() == len(rows) and history.select("digest").distinct().collect()[0][0] == first.digest
    assert store.metrics_history(spark, root, ["unknown"]) is None
    assert session(depth=3).digest != first.digest
    with pytest.raises(AssertionError, match="fitted again"):
        session(depth=3).classifier()
