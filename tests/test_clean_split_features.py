"""Known answers for cleaning, snapshots and features, and the invariants behind them."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketspark.operators import clean, features, split
from basketspark.sources import ledger
from basketspark.sources.ledger import LEDGER_SCHEMA

DAY = datetime


def row(invoice="1", code="22423", qty=1, at=DAY(2011, 1, 1), price="1.00", customer=1, text="thing", country="UK"):
    return (invoice, code, text, qty, at, Decimal(price) if price is not None else None, customer, country)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def purchases_frame(spark, rows):
    return raw_frame(spark, rows).withColumn("line_total", clean.line_total())


def test_report_counts_every_step_in_order(spark):
    rows = [
        row(), row(),  # exact duplicate
        row(invoice="2", at=None), row(invoice="3", price=None), row(invoice="4", qty=None),
        row(invoice="5", code="post"), row(invoice="6", code="gift_0001_20"),
        row(invoice="7", code="12"), row(invoice="8", code=None),
        row(invoice="9", customer=None),
        row(invoice="C10", qty=-1), row(invoice="c11"), row(invoice="12", qty=0), row(invoice=None),
        row(invoice="13", price="0.00"), row(invoice="14", price="0.001"),
    ]
    purchases, returns, report = clean.clean_transactions(raw_frame(spark, rows))
    removed = {r["step_no"]: (r["rows_before"], r["rows_after"], r["removed"]) for r in report.collect()}
    assert [removed[i][2] for i in range(1, 9)] == [0, 1, 3, 2, 2, 1, 4, 1]
    assert removed[1] == (16, 16, 0) and removed[8][1] == 2
    assert {r["invoice"] for r in purchases.collect()} == {"1", "14"}
    # a null invoice with positive quantity is on neither side
    assert {r["invoice"] for r in returns.collect()} == {"C10", "c11", "12"}


def test_clean_tables_drop_copies_where_the_ledger_is_laid_out(spark, tmp_path):
    rows = [(f"{'C' if i % 9 == 0 else ''}{i % 40}", f"{10000 + i % 7}", "thing", 1 + i % 3, datetime(2020, 1, 1 + i % 20), 2, i % 5 or None, "UK") for i in range(400)]
    schema = "invoice string, stock_code string, description string, quantity int, invoice_date timestamp_ntz, price decimal(12,4), customer_id long, country string"
    raw = spark.createDataFrame([(*r[:5], Decimal(r[5]), *r[6:]) for r in rows * 2], schema).repartition(6)
    clean.write_clean_tables(raw, f"{tmp_path}/clean")
    stored = spark.read.parquet(f"{tmp_path}/clean")
    lines = clean.valid_lines(raw).withColumn("side", F.when(F.col("is_return"), "returns").otherwise("purchases"))
    assert sorted(map(str, stored.select(*clean.LEDGER_COLUMNS, "line_total", "side").collect())) == sorted(
        map(str, lines.select(*clean.LEDGER_COLUMNS, "line_total", "side").collect()))
    plan = clean.laid_out(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2 and plan.count("Exchange rangepartitioning") == 1  # the other is the test's own


def test_write_clean_tables_and_returns(spark, tmp_path):
    raw = raw_frame(spark, [row(), row(invoice="C2", qty=-2, price="3.50"), row(invoice="3", price="0")])
    found = clean.load_returns(spark, str(tmp_path / "t"), raw).collect()
    assert [(r["invoice"], r["line_total"]) for r in found] == [("C2", Decimal("-7.0000"))]
    assert clean.read_purchases(spark, str(tmp_path / "t")).count() == 1
    only = raw_frame(spark, [row()])
    assert clean.load_returns(spark, str(tmp_path / "u"), only).count() == 0


def test_return_features_obey_the_cutoff(spark):
    returns = purchases_frame(spark, [row("C1", qty=-1, price="10"), row("C2", qty=-1, price="50", at=DAY(2011, 12, 1))])
    assert [tuple(r) for r in clean.return_features(returns, DAY(2011, 6, 1)).collect()] == [(1, 1, 10.0)]
    assert clean.return_features(returns, DAY(2010, 1, 1)).count() == 0


def test_normalise_headers_text_and_types(spark):
    df = spark.createDataFrame(
        [(" 536365 ", "85123A", "x\t", "6", "2010-12-01 08:26:00", "2.55", "17850.0", "UK"), ("1", "2", "d", "bad", "12/1/2010 8:26", "?", "zz", None)],
        "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, UnitPrice string, CustomerID string, Country string",
    )
    a, b = ledger.normalise(df).collect()
    assert (a["invoice"], a["description"], a["quantity"], a["price"], a["customer_id"]) == ("536365", "x", 6, Decimal("2.5500"), 17850)
    assert a["invoice_date"] == b["invoice_date"] == DAY(2010, 12, 1, 8, 26)
    assert b["quantity"] is None and b["price"] is None and b["customer_id"] is None
    with pytest.raises(ValueError, match="price"):
        ledger.normalise(df.drop("UnitPrice"))


def test_cached_ledger_is_built_once_unless_forced(spark, tmp_path):
    path, built = str(tmp_path / "raw"), []

    def build():
        built.append(1)
        return raw_frame(spark, [row()] * len(built))

    assert ledger.load_cached(spark, path, build).count() == 1
    assert ledger.load_cached(spark, path, build).count() == 1 and len(built) == 1
    assert ledger.load_cached(spark, path, build, force=True).count() == 2


def test_cutoffs():
    assert split.derive_cutoffs(DAY(2011, 12, 9, 12, 50)) == (DAY(2011, 6, 12), DAY(2011, 9, 10))


def test_snapshot_known_answer(spark):
    rows = [row("1", at=DAY(2011, 1, 1), price="10", customer=1), row("2", at=DAY(2011, 7, 1), price="20", customer=2),
            row("3", at=DAY(2011, 1, 15), price="30", customer=3), row("4", at=DAY(2011, 7, 15), price="40", customer=3)]
    snap = split.make_snapshot(purchases_frame(spark, rows), "2011-06-01")
    assert {tuple(r) for r in snap.labels.collect()} == {(1, 0, 0.0), (3, 1, 40.0)}
    assert {r[0] for r in split.eligible_customers(snap).collect()} == {1, 3}


def test_features_known_answer(spark):
    rows = [row("A", "11111", at=DAY(2011, 1, 1), price="10"), row("B", "22222", at=DAY(2011, 2, 1), price="20"),
            row("C", "33333", at=DAY(2011, 7, 1), price="30")]
    p = purchases_frame(spark, rows)
    got = features.feature_label_table(p, p.limit(0), DAY(2011, 6, 1)).first()
    assert (got["monetary"], got["frequency"], got["recency"], got["repurchased"], got["future_spend"]) == (30.0, 2, 120, 1, 30.0)
    assert got["n_returns"] == 0 and got["avg_days_between_orders"] == got["tenure"]


def test_days_are_whole_elapsed_periods(spark):
    p = purchases_frame(spark, [row(at=DAY(2011, 6, 9, 23))])
    assert features.customer_features(p, p.limit(0), DAY(2011, 6, 12)).first()["recency"] == 2


def test_leakage_invariants(ws):
    for snap in ws.snapshots.values():
        assert snap.observation.agg(F.max("invoice_date")).first()[0] < snap.cutoff
        assert snap.labels.filter((F.col("future_spend") > 0) != (F.col("repurchased") == 1)).count() == 0
    assert ws.train.window_end <= ws.test.cutoff
    assert split.eligible_customers(ws.train).join(split.eligible_customers(ws.test), "customer_id", "left_anti").count() == 0


def test_feature_invariants(ws):
    f = ws.features("test")
    assert f.count() == f.select("customer_id").distinct().count() == split.eligible_customers(ws.test).count()
    bad = (F.col("recency") < 0) | (F.col("spend_last_90d") > F.col("monetary") + 1e-6) | (F.col("orders_last_90d") > F.col("frequency"))
    bad = bad | (F.col("avg_days_between_orders").isNull() != (F.col("frequency") == 1))
    for c in features.FEATURE_COLUMNS:
        if c != "avg_days_between_orders":
            bad = bad | F.col(c).isNull()
    assert f.filter(bad).count() == 0


def test_timeline_keeps_last_eight_past_orders(ws):
    t = split.customer_timeline(ws.train)
    past = t.filter("period = 'past'").groupBy("customer_id").agg(F.count(F.lit(1)).alias("shown"), F.max("n_past").alias("n"))
    assert past.filter(F.col("shown") != F.least(F.col("n"), F.lit(8))).count() == 0


def test_numbers_the_ledger_cannot_hold_are_named_not_changed(spark):
    from basketspark.sources import ledger

    numbers = [("3", "2.55"), ("0.5", "1"), ("2.7", "1"), ("-4", "250000000"), ("1e1", "0.00004"), ("x", "0"), (None, None), ("6", "0.0012"), ("3", "2.5500000000000003")]
    raw = spark.createDataFrame([(str(i), "A", "d", q, "2011-01-01 10:00", p, "1", "UK") for i, (q, p) in enumerate(numbers)], ledger.LEDGER_COLUMNS)
    got = {r["invoice"]: (r["quantity"], None if r["price"] is None else float(r["price"])) for r in ledger.normalise(raw).collect()}
    assert got == {"0": (3, 2.55), "1": (None, 1), "2": (None, 1), "3": (-4, None), "4": (10, None), "5": (None, 0), "6": (None, None), "7": (6, 0.0012), "8": (3, 2.55)}
    assert tuple(ledger.rejected_numbers(raw).first()) == (2, 2)
