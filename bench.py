"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs shared by several operators (clean tables, item index, weights) are
written first and timed as ``clean_build``; every other figure is the median of
three runs of the operator itself, computed from those tables, never from a
cached result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from basketspark.operators import clean, features, metrics, recommend, segment, value
from basketspark.plans.workspace import Workspace
from basketspark.session import build_session
from basketspark.sources.order_tables import ledger_from_orders, vectors_from_embeddings

RUNS = 3


def consume(df) -> None:
    """Run the whole plan and drop the rows."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory="12g")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    seconds: dict[str, float] = {}

    def once(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    def median(name: str, run) -> None:
        times = []
        for _ in range(RUNS + 1):  # the first run warms up and is not counted
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    def raw():
        return ledger_from_orders(spark, folder)

    ws = Workspace(spark, raw, folder, external_vectors=lambda items: vectors_from_embeddings(spark, folder, items))
    once("clean_build_cold", lambda: ws.purchases)
    median("clean_build", lambda: clean.write_clean_tables(raw(), f"{ws.root}/bench_clean"))
    median("cleaning_report", lambda: consume(clean.cleaning_report(raw())))
    median("customer_features", lambda: consume(features.customer_features(ws.purchases, ws.returns, ws.train.cutoff)))
    median("feature_label_table", lambda: consume(features.feature_label_table(ws.purchases, ws.returns, ws.train.cutoff)))

    table = ws.features("test")
    scored = table.select("customer_id", table.repurchased.alias("y"), (1.0 / (1.0 + table.recency / 90.0)).alias("p"))
    median("rfm_quintiles", lambda: consume(segment.rfm_quintiles(ws.features("train"))))
    median("lift_table", lambda: consume(metrics.lift_table(scored)))
    median("classification_metrics", lambda: consume(metrics.classification_metrics(scored)))

    inputs = value.bgnbd_input(ws.features("train"))
    median("bgnbd_fit", lambda: value.fit_purchases(inputs))
    buying, spending = value.PurchaseParams(0.6028, 47.5292, 0.0799, 0.7127), value.SpendParams(1.896, 3.820, 544.11)
    median("clv_prediction", lambda: consume(value.clv_prediction(table, ws.test.observation, buying, spending)))

    ws.items(), ws.vectors("external"), ws.weights("test"), ws.truth("test"), ws.popular("test")
    median("purchase_weights", lambda: consume(recommend.purchase_weights(ws.test.observation, ws.items(), ws.test.cutoff)))
    median("item_stats", lambda: consume(recommend.item_stats(ws.test.observation, ws.items())))
    median("copurchase", lambda: consume(recommend.copurchase(ws.train.observation, ws.items())))
    ws.copurchase(), ws.customer_vectors("test", "external")
    candidates = ws.candidates("test", "external")
    median("cand_copurchase", lambda: consume(recommend.wanted_copurchase(ws.weights("test"), ws.copurchase(), candidates)))
    median("retrieve_top_n", lambda: consume(recommend.retrieve_top_n(ws.customer_vectors("test", "external"), ws.vectors("external"))))
    median("rank_metrics", lambda: consume(metrics.rank_metrics(recommend.baseline_repeat(ws.weights("test")), ws.truth("test"))))

    total = round(sum(v for k, v in seconds.items() if k != "clean_build_cold"), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").split("/")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
