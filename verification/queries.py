"""Every operator as a query over the given tables: name -> function(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.functions.vectors import unit
from basketspark.operators import boosting, clean, features, metrics, recommend, repurchase, segment, split, value
from basketspark.operators.features import FEATURE_COLUMNS, RFM_COLUMNS
from basketspark.plans.workspace import Workspace
from basketspark.sources import ledger, serving
from basketspark.sources.order_tables import ledger_from_orders, ledger_tables, read_table, vectors_from_embeddings
from basketspark.streaming.scoring import score_requests

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters used where a query must not depend on a fit.
FIXED_CENTROIDS = [(-0.9, 0.9, 0.9), (0.6, 0.2, 0.3), (-0.4, -1.0, -0.9), (1.1, -1.2, -1.1)]
FIXED_BUYING = value.PurchaseParams(r=0.6028, alpha=47.5292, a=0.0799, b=0.7127)
FIXED_SPENDING = value.SpendParams(p=1.896, q=3.820, v=544.11)
EFFECT_CENTRES = [300.0, 7.0, 600000.0, 90000.0, 1900.0, 25.0, 650.0, 90.0, 350.0, 26000.0, 0.5, 2.0, 50000.0]
EFFECT_SCALES = [-251.3, 5.3, 400003.7, 70001.9, 907.1, 21.7, 503.3, 61.3, -307.1, 40009.3, 1.3, -3.1, -60013.1]

_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """One workspace per session and folder, so tables and models with many consumers are built once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _workspaces:
        _workspaces[key] = Workspace(
            spark, lambda: ledger_from_orders(spark, folder), folder,
            external_vectors=lambda items: vectors_from_embeddings(spark, folder, items),
            vector_source=lambda: read_table(spark, folder, "embeddings"), sources=lambda: ledger_tables(spark, folder),
        )
    return _workspaces[key]


def query(name: str):
    """Register a function of (workspace, spark, folder)."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(workspace(spark, folder), spark, folder)
        return fn

    return register


# Integer columns that hold nulls in some result; engines hand these back differently.
NULLABLE_INTEGERS = {"segment_id"}


def with_digits(df: DataFrame, weight: str) -> DataFrame:
    """A weight of any magnitude as its decimal logarithm to eight places (0 when the weight is 0)."""
    return df.withColumn(weight, F.when(F.col(weight) > 0, F.round(F.log10(weight), 8)).otherwise(0.0))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines, decimals as doubles, dates as text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double" or kind.startswith("decimal"):
            c = F.round(c.cast("double"), places).alias(name)
        elif kind in ("date", "timestamp_ntz"):
            c = c.cast("string").alias(name)
        elif name in NULLABLE_INTEGERS and kind in ("int", "bigint"):
            c = c.cast("double").alias(name)
        out.append(c)
    return df.select(*out)


def ledger_out(df: DataFrame) -> DataFrame:
    """Ledger rows for comparison; customer_id and quantity may be null here."""
    wide = [c for c in ("customer_id", "quantity") if c in df.columns]
    return rounded(df.withColumns({c: F.col(c).cast("double") for c in wide}))


def fixed_scores(ws: Workspace) -> DataFrame:
    """Test customers with label y, spend and a score p that both engines compute alike."""
    return ws.features("test").select(
        "customer_id", F.col("repurchased").alias("y"), "future_spend", "spend_last_90d", "frequency", "avg_order_value",
        (F.lit(1.0) / (F.lit(1.0) + F.col("recency") / F.lit(90.0))).alias("p"),
    )


def fixed_value(ws: Workspace) -> DataFrame:
    """A value estimate both engines compute alike: recent spend plus a share of the order value."""
    return ws.features("test").select("customer_id", "future_spend", (F.col("spend_last_90d") * 0.5 + F.col("avg_order_value") * 0.25).alias("p"))


# --- sources and sinks ---

@query("ledger_read")
def _(ws, spark, folder):
    path = f"{ws.root}/ledger_csv"
    headers = {"invoice": "Invoice", "stock_code": "StockCode", "description": "Description", "quantity": "Quantity",
               "invoice_date": "InvoiceDate", "price": "Price", "customer_id": "Customer ID", "country": "Country"}
    text = ws.raw().withColumn("invoice_date", F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"))
    text.withColumnsRenamed(headers).write.mode("overwrite").option("header", True).csv(path)
    return ledger_out(ledger.normalise(ledger.read_csv(spark, path)))


@query("ledger_union")
def _(ws, spark, folder):
    raw = ws.raw()
    years = [r[0] for r in raw.select(F.year("invoice_date")).distinct().orderBy(F.year("invoice_date")).collect()]
    sheets = [raw.filter(F.year("invoice_date") == y) for y in years]
    return ledger.union_sheets(sheets).groupBy("country", F.year("invoice_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("units"))


@query("ledger_normalise")
def _(ws, spark, folder):
    raw = ws.raw()
    dirty = raw.select(
        F.concat(F.lit("  "), F.col("invoice"), F.lit("\t")).alias("InvoiceNo"), F.concat(F.col("stock_code"), F.lit(" ")).alias("StockCode"),
        F.concat(F.lit(" "), F.col("description")).alias("Description"),
        F.when(F.col("quantity") % 11 == 0, "n/a").otherwise(F.col("quantity").cast("string")).alias("Quantity"),
        F.date_format("invoice_date", "M/d/yyyy H:mm").alias("InvoiceDate"),
        F.when(F.col("quantity") % 13 == 0, "?").otherwise(F.col("price").cast("string")).alias("UnitPrice"),
        F.when(F.col("customer_id") % 7 == 0, "unknown").otherwise(F.concat(F.col("customer_id").cast("string"), F.lit(".0"))).alias("CustomerID"),
        F.concat(F.col("country"), F.lit("\n")).alias("Country"),
    )
    return ledger_out(ledger.normalise(dirty))


@query("ledger_cached")
def _(ws, spark, folder):
    cached = ledger.load_cached(spark, f"{ws.root}/ledger_cached", ws.raw)
    return rounded(cached.groupBy("invoice").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("units"), F.sum("price").alias("price_sum")))


@query("clean_tables_write")
def _(ws, spark, folder):
    path = f"{ws.root}/clean_tables"
    clean.write_clean_tables(ws.raw(), path)
    return rounded(spark.read.parquet(path).groupBy("side", "customer_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("line_total").alias("total")))


@query("returns_read")
def _(ws, spark, folder):
    return ledger_out(clean.load_returns(spark, f"{ws.root}/returns_read", ws.raw()))


@query("customer_serving_table")
def _(ws, spark, folder):
    table = serving.customer_serving_table(ws.features("test"), ws.test)
    return rounded(serving.write_serving(table, f"{ws.root}/serve_customers"))


@query("segment_params_table")
def _(ws, spark, folder):
    centroids, names = ws.fitted_segments()
    params = segment.segment_params(spark, ws.scaler, centroids, names, str(ws.train.cutoff.date()))
    return rounded(serving.write_serving(params, f"{ws.root}/serve_segments"))


@query("segment_params_check")
def _(ws, spark, folder):
    return segment.segment_params_check(ws.features("test"), ws.kmeans(), ws.scaler)


@query("clv_serving_table")
def _(ws, spark, folder):
    return rounded(serving.write_serving(serving.clv_serving_table(ws.clv_scored(), ws.test), f"{ws.root}/serve_clv"))


@query("shap_serving_table")
def _(ws, spark, folder):
    stored = serving.write_serving(serving.shap_serving_table(ws.contributions(), ws.test), f"{ws.root}/serve_shap")
    names = F.array(*[F.lit(c) for c in FEATURE_COLUMNS])
    return rounded(stored.select("customer_id", F.posexplode("contributions").alias("pos", "effect"), "base_value", "as_of").select(
        "customer_id", names[F.col("pos")].alias("feature"), "effect", "base_value", "as_of"))


@query("recs_serving_table")
def _(ws, spark, folder):
    table = serving.recs_serving_table(ws.served_lists(), recommend.owned_pairs(ws.weights("test")), ws.test)
    return rounded(serving.write_serving(table, f"{ws.root}/serve_recs"))


# --- cleaning ---

@query("clean_dedup")
def _(ws, spark, folder):
    return ledger_out(clean.drop_duplicates(ws.raw()))


@query("clean_required")
def _(ws, spark, folder):
    # The derived ledger has no nulls here, so unparsable text supplies them.
    dirty = ws.raw().withColumns({
        "quantity": F.when(F.col("quantity") % 11 != 0, F.col("quantity")), "price": F.when(F.col("quantity") % 13 != 0, F.col("price")),
    })
    return ledger_out(clean.has_required(dirty))


@query("clean_non_product")
def _(ws, spark, folder):
    return ledger_out(ws.raw().filter(clean.is_product_code()))


@query("clean_code_format")
def _(ws, spark, folder):
    return ledger_out(ws.raw().filter(clean.is_well_formed()))


@query("clean_has_customer")
def _(ws, spark, folder):
    return ledger_out(ws.raw().filter(F.col("customer_id").isNotNull()))


@query("returns_split")
def _(ws, spark, folder):
    return ws.raw().withColumn("is_return", clean.is_return()).groupBy("invoice", "is_return").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("units"))


@query("clean_price")
def _(ws, spark, folder):
    return ledger_out(ws.raw().filter(~clean.is_return() & (F.col("price") > 0)))


@query("line_total")
def _(ws, spark, folder):
    return rounded(ws.raw().select("invoice", "stock_code", "quantity", "price", clean.line_total().alias("line_total")))


@query("purchases_sorted")
def _(ws, spark, folder):
    return ledger_out(clean.purchases_sorted(ws.purchases))


@query("cleaning_report")
def _(ws, spark, folder):
    return clean.cleaning_report(ws.raw())


@query("return_features")
def _(ws, spark, folder):
    return rounded(clean.return_features(ws.returns, ws.test.cutoff))


@query("clean_summary")
def _(ws, spark, folder):
    return rounded(clean.clean_summary(ws.purchases))


# --- temporal ---

@query("cutoffs")
def _(ws, spark, folder):
    return rounded(split.cutoff_table(ws.purchases))


@query("snapshot_observation")
def _(ws, spark, folder):
    return ledger_out(ws.train.observation)


@query("snapshot_future")
def _(ws, spark, folder):
    return ledger_out(ws.train.future)


@query("eligible_customers")
def _(ws, spark, folder):
    return split.eligible_customers(ws.train)


@query("snapshot_labels")
def _(ws, spark, folder):
    return rounded(ws.train.labels)


@query("snapshot_summary")
def _(ws, spark, folder):
    return rounded(split.snapshot_summary(ws.train))


@query("train_test_snapshots")
def _(ws, spark, folder):
    parts = [s.labels.select(F.lit(s.name).alias("snapshot"), "*") for s in (ws.train, ws.test)]
    return rounded(parts[0].unionByName(parts[1]))


@query("population_overlap")
def _(ws, spark, folder):
    return split.population_overlap(ws.purchases, ws.train, ws.test)


@query("customer_timeline")
def _(ws, spark, folder):
    return rounded(split.customer_timeline(ws.train))


@query("timeline_candidates")
def _(ws, spark, folder):
    return rounded(split.timeline_candidates(ws.train))


@query("base_rate_shift")
def _(ws, spark, folder):
    return rounded(split.snapshot_summary(ws.train).unionByName(split.snapshot_summary(ws.test)).select("snapshot", "n_customers", "repurchase_rate"))


# --- features ---

@query("feat_core")
def _(ws, spark, folder):
    rolled = features.customer_rollup(ws.purchases, ws.train.cutoff).join(features.product_breadth(ws.purchases, ws.train.cutoff), "customer_id")
    return rounded(rolled.select("customer_id", "frequency", "monetary", "n_products", "n_items", "first_purchase", "last_purchase"))


@query("feat_recency_tenure")
def _(ws, spark, folder):
    return features.recency_tenure(features.customer_rollup(ws.purchases, ws.train.cutoff), ws.train.cutoff).select("customer_id", "recency", "tenure")


@query("feat_ratios")
def _(ws, spark, folder):
    return rounded(features.order_ratios(features.customer_rollup(ws.purchases, ws.train.cutoff)).select("customer_id", "avg_order_value", "avg_basket_value"))


@query("feat_gap")
def _(ws, spark, folder):
    rolled = features.recency_tenure(features.customer_rollup(ws.purchases, ws.train.cutoff), ws.train.cutoff)
    return rounded(features.order_gap(rolled).select("customer_id", "avg_days_between_orders"))


@query("feat_recent")
def _(ws, spark, folder):
    return rounded(features.customer_rollup(ws.purchases, ws.train.cutoff).select("customer_id", "spend_last_90d", "orders_last_90d"))


@query("feat_returns")
def _(ws, spark, folder):
    return rounded(features.with_returns(split.eligible_customers(ws.train), ws.returns, ws.train.cutoff))


@query("customer_features")
def _(ws, spark, folder):
    return rounded(features.customer_features(ws.purchases, ws.returns, ws.train.cutoff))


@query("feature_label_table")
def _(ws, spark, folder):
    return rounded(features.feature_label_table(ws.purchases, ws.returns, ws.train.cutoff))


@query("feature_summary")
def _(ws, spark, folder):
    return rounded(features.feature_summary(ws.features("train")))


@query("target_profile")
def _(ws, spark, folder):
    return rounded(features.target_profile(ws.features("train"), "train").unionByName(features.target_profile(ws.features("test"), "test")))


# --- segmentation ---

def fixed_labels(ws: Workspace) -> DataFrame:
    return ws.segment_labels(FIXED_CENTROIDS)


def fixed_named(ws: Workspace) -> DataFrame:
    """Train customers with fixed-centroid segment, its name and their quintile score."""
    def build():
        labels = fixed_labels(ws)
        names = segment.segment_names(segment.segment_profile(ws.features("train"), labels))
        return labels.join(F.broadcast(names), "segment").join(segment.rfm_quintiles(ws.features("train")), "customer_id").select(
            "customer_id", "segment", "segment_name", "rfm_score")
    return ws.table("fixed_named", build)


@query("rfm_prepared")
def _(ws, spark, folder):
    return rounded(segment.prepare(ws.features("train"), ws.scaler))


@query("scaler_params")
def _(ws, spark, folder):
    return rounded(segment.scaler_table(ws.features("train")))


@query("kmeans_fit")
def _(ws, spark, folder):
    return rounded(ws.segment_labels(segment.centroids_of(ws.kmeans())))


@query("choose_k")
def _(ws, spark, folder):
    return rounded(segment.choose_k(ws.features("train"), range(2, 9)))


@query("silhouette")
def _(ws, spark, folder):
    return rounded(segment.silhouette(fixed_labels(ws)))


@query("scaling_comparison")
def _(ws, spark, folder):
    return rounded(segment.scaling_comparison(ws.features("train")))


@query("segment_profile")
def _(ws, spark, folder):
    return rounded(segment.segment_profile(ws.features("train"), fixed_labels(ws)), 2)


@query("segment_names")
def _(ws, spark, folder):
    return segment.segment_names(segment.segment_profile(ws.features("train"), fixed_labels(ws)))


@query("rfm_quintiles")
def _(ws, spark, folder):
    return segment.rfm_quintiles(ws.features("train"))


@query("segment_crosstab")
def _(ws, spark, folder):
    return segment.segment_crosstab(fixed_named(ws))


@query("segment_score_summary")
def _(ws, spark, folder):
    return rounded(segment.segment_score_summary(fixed_named(ws)))


@query("ambiguous_middle")
def _(ws, spark, folder):
    return rounded(segment.ambiguous_middle(fixed_named(ws)))


FIXED_NAMES = ["Champions", "At-risk high-value", "New / Low-value", "Lapsed / One-off"]


@query("segment_assign")
def _(ws, spark, folder):
    return rounded(segment.segment_assign(ws.features("test").select("customer_id", *RFM_COLUMNS), ws.scaler, FIXED_CENTROIDS, FIXED_NAMES), 4)


@query("segment_known")
def _(ws, spark, folder):
    ids = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    return rounded(segment.segment_known(ids, ws.features("test"), ws.scaler, FIXED_CENTROIDS, FIXED_NAMES), 4)


def rfm_requests(ws: Workspace) -> DataFrame:
    """Request rows as text, some of them broken by rule."""
    cid = F.col("customer_id")
    return ws.features("test").select(
        "customer_id",
        F.when(cid % 10 == 1, "yesterday").when(cid % 10 == 2, "-5").otherwise(F.col("recency").cast("string")).alias("recency"),
        F.when(cid % 10 == 3, "0").otherwise(F.col("frequency").cast("string")).alias("frequency"),
        F.when(cid % 10 == 4, F.lit(None)).otherwise(F.col("n_items").cast("string")).alias("monetary"),
    )


@query("rfm_validate")
def _(ws, spark, folder):
    return rounded(segment.rfm_validate(rfm_requests(ws)))


@query("segment_requests")
def _(ws, spark, folder):
    return rounded(score_requests(rfm_requests(ws), ws.scaler, FIXED_CENTROIDS, FIXED_NAMES), 4)


# --- repurchase ---

@query("average_precision")
def _(ws, spark, folder):
    return rounded(metrics.average_precision(fixed_scores(ws)))


@query("roc_auc")
def _(ws, spark, folder):
    return rounded(metrics.roc_auc(fixed_scores(ws)))


@query("brier")
def _(ws, spark, folder):
    return rounded(metrics.brier(fixed_scores(ws)))


@query("base_and_mean")
def _(ws, spark, folder):
    return rounded(metrics.base_and_mean(fixed_scores(ws)))


@query("classification_metrics")
def _(ws, spark, folder):
    rule = repurchase.baseline_recency(ws.features("test")).withColumn("y", F.col("repurchased"))
    return rounded(repurchase.contender_table({"inverse recency": fixed_scores(ws), "recency rule": rule}))


@query("lift_table")
def _(ws, spark, folder):
    return rounded(metrics.lift_table(fixed_scores(ws)))


@query("baseline_recency")
def _(ws, spark, folder):
    return repurchase.baseline_recency(ws.features("test")).select("customer_id", "p")


@query("baseline_logistic")
def _(ws, spark, folder):
    return rounded(ws.logistic_scored().select("customer_id", "y", "p"))


@query("holdout_split")
def _(ws, spark, folder):
    return boosting.with_holdout(ws.features("train")).groupBy("repurchased", "is_val").agg(
        F.count(F.lit(1)).alias("customers"), F.min("customer_id").alias("first_id"), F.sum("customer_id").alias("id_sum"))


@query("gbt_classifier")
def _(ws, spark, folder):
    return rounded(ws.repurchase_scored().select("customer_id", "y", "p"))


@query("early_stopping")
def _(ws, spark, folder):
    model = ws.classifier()
    kept, measured = model.n_trees, model.held_out
    before = measured[kept - 2] if kept > 1 else None
    return rounded(ws.features("train").agg(
        F.count(F.lit(1)).alias("customers"), F.lit(model.rounds_allowed).alias("trees_allowed"), F.lit(len(measured)).alias("trees_tried"),
        F.lit(kept).alias("trees_kept"), F.lit(measured[kept - 1]).alias("best_pr_auc"), F.lit(before).cast("double").alias("pr_auc_one_round_earlier")))


@query("isotonic_calibration")
def _(ws, spark, folder):
    return rounded(ws.calibrated())


@query("calibration_halves")
def _(ws, spark, folder):
    return repurchase.with_calibration_half(ws.features("test").select("customer_id"))


@query("calibration_report")
def _(ws, spark, folder):
    return rounded(repurchase.calibration_report(ws.calibrated()))


@query("shap_contributions")
def _(ws, spark, folder):
    c = ws.contributions()
    total = F.aggregate("contributions", F.col("base_value"), lambda s, x: s + x)
    raw = ws.repurchase_scored().select("customer_id", F.log(F.col("p") / (1 - F.col("p"))).alias("raw_score"))
    return rounded(c.select("customer_id", "base_value", total.alias("explained")).join(raw, "customer_id"))


@query("shap_global")
def _(ws, spark, folder):
    return rounded(boosting.mean_absolute_effect(ws.contributions(), FEATURE_COLUMNS))


def fixed_effects(ws: Workspace) -> DataFrame:
    effects = F.array(*[
        (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(m)) / F.lit(s) for c, m, s in zip(FEATURE_COLUMNS, EFFECT_CENTRES, EFFECT_SCALES)
    ])
    return ws.features("test").select("customer_id", effects.alias("contributions"))


@query("top_drivers")
def _(ws, spark, folder):
    return rounded(boosting.top_drivers(fixed_effects(ws), ws.features("test"), FEATURE_COLUMNS), 4)


@query("feature_importance")
def _(ws, spark, folder):
    return rounded(boosting.importance_table(ws.classifier(), FEATURE_COLUMNS, spark))


@query("contender_table")
def _(ws, spark, folder):
    return rounded(ws.repurchase_contenders())


@query("score_decile")
def _(ws, spark, folder):
    return rounded(repurchase.score_decile(fixed_scores(ws).select("customer_id", "p")))


@query("repurchase_scores")
def _(ws, spark, folder):
    rates = [ws.features(n).agg(F.avg("repurchased")).first()[0] for n in ("train", "test")]
    table = repurchase.repurchase_scores(ws.repurchase_scored(), ws.contributions(), str(ws.test.cutoff.date()), *rates)
    return table.withColumn("top_drivers", F.to_json("top_drivers"))


# --- value ---

def fixed_predicted(ws: Workspace) -> DataFrame:
    return ws.table("fixed_predicted", lambda: value.expected_purchases(value.bgnbd_input(ws.features("test")), FIXED_BUYING))


@query("bgnbd_input")
def _(ws, spark, folder):
    return value.bgnbd_input(ws.features("train"))


@query("bgnbd_input_violations")
def _(ws, spark, folder):
    return value.input_violations(value.bgnbd_input(ws.features("train")))


@query("repeat_order_value")
def _(ws, spark, folder):
    return rounded(value.repeat_order_value(ws.train.observation))


@query("bgnbd_fit")
def _(ws, spark, folder):
    buying, spending = ws.value_params()
    return rounded(value.params_table(spark, buying, spending).select("r", "alpha", "a", "b"))


@query("gamma_gamma_fit")
def _(ws, spark, folder):
    buying, spending = ws.value_params()
    return rounded(value.params_table(spark, buying, spending).select("p", "q", "v"))


@query("gg_validity_guard")
def _(ws, spark, folder):
    loaded = value.load_params(value.params_table(spark, *ws.value_params()))
    return ws.features("test").agg(F.count(F.lit(1)).alias("customers"), (F.lit(loaded[1].q) > 1).alias("mean_exists"))


@query("expected_purchases")
def _(ws, spark, folder):
    return rounded(fixed_predicted(ws).select("customer_id", "direct_purchases", "expected_purchases"))


@query("undefined_fill")
def _(ws, spark, folder):
    return rounded(value.undefined_fill(fixed_predicted(ws)).select("customer_id", "expected_purchases", "was_undefined"))


@query("expected_order_value")
def _(ws, spark, folder):
    return rounded(value.expected_order_value(value.bgnbd_input(ws.features("test")), value.repeat_order_value(ws.test.observation), FIXED_SPENDING).select(
        "customer_id", "expected_value"))


@query("clv_prediction")
def _(ws, spark, folder):
    return rounded(ws.clv_scored())


@query("clv_prediction_fixed")
def _(ws, spark, folder):
    return rounded(value.clv_prediction(ws.features("test"), ws.test.observation, FIXED_BUYING, FIXED_SPENDING).select("customer_id", "p"), 4)


@query("p_alive")
def _(ws, spark, folder):
    return rounded(value.bgnbd_input(ws.features("test")).select("customer_id", value.p_alive(FIXED_BUYING).alias("p_alive")))


@query("bgnbd_coverage")
def _(ws, spark, folder):
    return rounded(value.bgnbd_coverage(fixed_predicted(ws)))


@query("params_round_trip")
def _(ws, spark, folder):
    buying, spending = ws.value_params()
    again = value.load_params(ws.table("params_round_trip", lambda: value.params_table(spark, buying, spending)))
    one, two = (value.clv_prediction(ws.features("test"), ws.test.observation, *p).select("customer_id", "p") for p in ((buying, spending), again))
    both = one.join(two.withColumnRenamed("p", "p_again"), "customer_id")
    return both.agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("p") != F.col("p_again")).alias("changed"))


@query("gbt_regressor")
def _(ws, spark, folder):
    return rounded(ws.regressor_scored(False).select("customer_id", "future_spend", "p"))


@query("gbt_regressor_log")
def _(ws, spark, folder):
    return rounded(ws.regressor_scored(True).select("customer_id", "future_spend", "p"))


@query("hurdle_fit")
def _(ws, spark, folder):
    clf, reg = ws.hurdle()
    return ws.features("train").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("future_spend") > 0).alias("spenders"),
        F.lit(clf.n_trees).alias("classifier_trees"), F.lit(reg.n_trees).alias("regressor_trees"))


@query("hurdle_predict")
def _(ws, spark, folder):
    return rounded(ws.hurdle_scored().select("customer_id", "p_buys", "amount", "p"))


@query("baseline_mean")
def _(ws, spark, folder):
    return rounded(value.baseline_mean(ws.features("train"), ws.features("test")).select("customer_id", "p"))


@query("baseline_last90")
def _(ws, spark, folder):
    return rounded(value.baseline_last90(ws.features("test")).select("customer_id", "p"))


@query("regression_metrics")
def _(ws, spark, folder):
    return rounded(metrics.regression_metrics(fixed_value(ws), "future_spend", "p"), 5)


@query("value_decile_table")
def _(ws, spark, folder):
    return rounded(metrics.value_decile_table(fixed_value(ws), "future_spend", "p"), 4)


@query("value_contenders")
def _(ws, spark, folder):
    return rounded(ws.value_contenders())


@query("value_decile")
def _(ws, spark, folder):
    return value.value_decile(fixed_value(ws).select("customer_id", "p")).select("customer_id", "value_decile")


@query("value_scores")
def _(ws, spark, folder):
    mae = {r["contender"]: r["mae"] for r in ws.value_contenders().collect()}
    return value.value_scores(ws.clv_scored(), ws.hurdle_scored(), str(ws.test.cutoff.date()), mae["BG/NBD + Gamma-Gamma"], mae["hurdle P(buy) x E[spend]"])


@query("independence_check")
def _(ws, spark, folder):
    return rounded(value.independence_check(ws.features("train")))


@query("gg_population_mean")
def _(ws, spark, folder):
    return rounded(value.population_mean_check(value.repeat_order_value(ws.train.observation), FIXED_SPENDING))


@query("p_alive_summary")
def _(ws, spark, folder):
    return rounded(value.p_alive_summary(value.bgnbd_input(ws.features("test")), FIXED_BUYING))


# --- recommender ---

EXT = "external"


@query("baskets")
def _(ws, spark, folder):
    # Contents of the lists; a basket of thousands of lines comes in several parts, so parts are summed.
    return recommend.baskets(ws.train.observation).select("invoice", F.explode("items").alias("stock_code")).groupBy("invoice", "stock_code").agg(
        F.count(F.lit(1)).alias("times_in_basket"))


@query("corpus_stats")
def _(ws, spark, folder):
    return rounded(recommend.corpus_stats(ws.train.observation, ws.items()))


@query("item2vec")
def _(ws, spark, folder):
    text = F.array_join(F.transform("vector", lambda x: F.format_number(x, 6)), " ")
    return ws.vectors("learned").select("item_idx", "stock_code", text.alias("vector"))


@query("item_vectors")
def _(ws, spark, folder):
    stored = read_table(spark, folder, "embeddings")
    return rounded(stored.select("vec_id", F.posexplode(unit(F.col("embedding"))).alias("pos", "value")))


@query("item_index")
def _(ws, spark, folder):
    return recommend.item_index(ws.train.observation)


@query("purchase_weights")
def _(ws, spark, folder):
    return with_digits(recommend.purchase_weights(ws.test.observation, ws.items(), ws.test.cutoff), "weight")


@query("customer_vectors")
def _(ws, spark, folder):
    return rounded(recommend.customer_vectors(ws.weights("test"), ws.vectors(EXT)).select("customer_id", F.posexplode("vector").alias("pos", "value")))


@query("retrieve_top_n")
def _(ws, spark, folder):
    return rounded(recommend.retrieve_top_n(ws.customer_vectors("test", EXT), ws.vectors(EXT)), 9)


@query("item_stats")
def _(ws, spark, folder):
    return rounded(recommend.item_stats(ws.test.observation, ws.items()))


@query("popularity_order")
def _(ws, spark, folder):
    return recommend.popularity_order(ws.item_stats("test"))


@query("copurchase")
def _(ws, spark, folder):
    return recommend.copurchase(ws.train.observation, ws.items())


@query("owned_copurchase")
def _(ws, spark, folder):
    # The full product is the largest table here; it is computed whole and compared per customer.
    return recommend.owned_copurchase(ws.weights("test"), ws.copurchase()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("co_score").alias("score_sum"), F.max("co_score").alias("score_max"),
        F.sum(F.col("co_score") * F.col("item_idx")).alias("weighted_sum"))


@query("candidates")
def _(ws, spark, folder):
    return recommend.build_candidates(ws.weights("test"), ws.retrieved("test", EXT), ws.popular("test")).select(
        "customer_id", "item_idx", "from_retrieval", "from_history", "from_popular")


@query("cand_emb_similarity")
def _(ws, spark, folder):
    return rounded(recommend.candidate_similarity(ws.candidates("test", EXT), ws.customer_vectors("test", EXT), ws.vectors(EXT)).select(
        "customer_id", "item_idx", "emb_similarity"), 9)


@query("cand_emb_rank")
def _(ws, spark, folder):
    return recommend.candidate_similarity(ws.candidates("test", EXT), ws.customer_vectors("test", EXT), ws.vectors(EXT)).select(
        "customer_id", "item_idx", "emb_rank")


@query("cand_popularity")
def _(ws, spark, folder):
    return rounded(recommend.candidate_item_facts(ws.candidates("test", EXT), ws.item_stats("test")).select(
        "customer_id", "item_idx", "log_units", "log_buyers", "price"))


@query("cand_history")
def _(ws, spark, folder):
    return with_digits(recommend.candidate_history(ws.candidates("test", EXT)).select(
        "customer_id", "item_idx", "weight_before", "bought_before", "times_bought_before", "lines_bought_before"), "weight_before")


@query("cand_copurchase")
def _(ws, spark, folder):
    return rounded(recommend.candidate_copurchase(ws.candidates("test", EXT), ws.co_scores("test", EXT)).select(
        "customer_id", "item_idx", "copurchase"))


@query("cand_copurchase_rank")
def _(ws, spark, folder):
    return recommend.candidate_copurchase(ws.candidates("test", EXT), ws.co_scores("test", EXT)).select(
        "customer_id", "item_idx", "copurchase_rank")


@query("cand_price_fit")
def _(ws, spark, folder):
    facts = recommend.candidate_item_facts(ws.candidates("test", EXT), ws.item_stats("test"))
    return rounded(recommend.candidate_price_fit(facts, ws.weights("test"), ws.item_stats("test")).select("customer_id", "item_idx", "price_vs_customer_avg"))


@query("cand_customer_context")
def _(ws, spark, folder):
    return recommend.candidate_context(ws.candidates("test", EXT), ws.features("test")).select("customer_id", "item_idx", "cust_frequency", "cust_recency")


@query("candidate_features")
def _(ws, spark, folder):
    rows = recommend.candidate_features(
        ws.candidates("test", EXT), ws.customer_vectors("test", EXT), ws.vectors(EXT), ws.weights("test"), ws.item_stats("test"),
        ws.co_scores("test", EXT), ws.features("test"))
    return rounded(with_digits(rows, "weight_before"), 9)


@query("candidate_labels")
def _(ws, spark, folder):
    return recommend.label_candidates(ws.candidates("test", EXT), ws.truth("test")).select("customer_id", "item_idx", "label")


@query("candidate_balance")
def _(ws, spark, folder):
    return rounded(recommend.candidate_balance(recommend.label_candidates(ws.candidates("test", EXT), ws.truth("test")), "test"))


@query("group_split")
def _(ws, spark, folder):
    return recommend.group_split(ws.weights("train").select("customer_id").distinct())


@query("group_sizes")
def _(ws, spark, folder):
    return recommend.group_sizes(ws.candidates("test", EXT))


@query("ranker_pointwise")
def _(ws, spark, folder):
    return rounded(ws.ranked_candidates().select("customer_id", "item_idx", "pointwise"))


@query("ranker_listwise")
def _(ws, spark, folder):
    return rounded(ws.ranked_candidates().select("customer_id", "item_idx", "listwise"))


@query("ranker_importance")
def _(ws, spark, folder):
    return rounded(boosting.importance_table(ws.pointwise(), recommend.CANDIDATE_FEATURES, spark))


def fixed_ranking(ws: Workspace) -> DataFrame:
    """Candidates with a score both engines compute alike."""
    return ws.candidates("test", EXT).select(
        "customer_id", "item_idx",
        (F.col("weight_before") * 2 + F.col("from_popular") * 0.3 + F.col("from_retrieval") * 0.2 + 1.0 / (1 + F.col("item_idx"))).alias("score"))


@query("top_k")
def _(ws, spark, folder):
    return recommend.top_k(fixed_ranking(ws))


@query("truth_pairs")
def _(ws, spark, folder):
    return recommend.truth_pairs(ws.test.future, ws.items())


@query("owned_pairs")
def _(ws, spark, folder):
    return recommend.owned_pairs(ws.weights("test"))


@query("rank_metrics")
def _(ws, spark, folder):
    return rounded(metrics.rank_metrics(recommend.baseline_repeat(ws.weights("test")), ws.truth("test")))


@query("retrieval_recall")
def _(ws, spark, folder):
    return rounded(recommend.retrieval_recall(ws.retrieved("test", EXT), ws.truth("test"), ws.weights("test")))


@query("candidate_ceiling")
def _(ws, spark, folder):
    return rounded(recommend.candidate_ceiling(ws.candidates("test", EXT), ws.truth("test")))


@query("baseline_popular")
def _(ws, spark, folder):
    return recommend.baseline_popular(ws.weights("test").select("customer_id").distinct(), ws.popular("test"))


@query("baseline_repeat")
def _(ws, spark, folder):
    return recommend.baseline_repeat(ws.weights("test"))


@query("baseline_copurchase")
def _(ws, spark, folder):
    parts = [recommend.baseline_copurchase(ws.weights("test"), ws.co_scores("test"), ws.n_items(), exclude_own=own).withColumn("excludes_own", F.lit(own))
             for own in (False, True)]
    return parts[0].unionByName(parts[1])


@query("baseline_stage1")
def _(ws, spark, folder):
    return recommend.baseline_stage1(ws.retrieved("test", EXT))


@query("truth_new")
def _(ws, spark, folder):
    return recommend.truth_new(ws.truth("test"), recommend.owned_pairs(ws.weights("test")))


@query("recs_new_only")
def _(ws, spark, folder):
    best = recommend.baseline_popular(ws.weights("test").select("customer_id").distinct(), ws.popular("test"), 200)
    return recommend.recs_new_only(best, recommend.owned_pairs(ws.weights("test")))


@query("candidates_fresh")
def _(ws, spark, folder):
    return recommend.candidates_fresh(recommend.candidate_history(ws.candidates("test", EXT))).select("customer_id", "item_idx")


@query("reco_contenders")
def _(ws, spark, folder):
    return rounded(ws.reco_table())


@query("reco_baselines")
def _(ws, spark, folder):
    return rounded(ws.reco_contenders(EXT, with_models=False))


@query("repeat_share")
def _(ws, spark, folder):
    return rounded(recommend.repeat_share(ws.train.observation, ws.train.future))


@query("item_description")
def _(ws, spark, folder):
    return recommend.item_description(ws.train.observation)


@query("similar_items")
def _(ws, spark, folder):
    stored = recommend.normalised_vectors(read_table(spark, folder, "embeddings"), "vec_id", "embedding")
    return rounded(recommend.similar_items(stored, 8, "vec_id"))


@query("recommendation_lists")
def _(ws, spark, folder):
    return recommend.recommendation_lists(
        recommend.top_k(fixed_ranking(ws)), ws.weights("test"), ws.items(), recommend.item_description(ws.train.observation))


@query("customer_page")
def _(ws, spark, folder):
    return rounded(serving.customer_page(ws.features("test"), limit=100000, offset=10))


# After the others, whose models and tables it reads.
@query("metrics_table")
def _(ws, spark, folder):
    return rounded(ws.metrics())
