"""One run over one ledger: written intermediate tables and fitted models, built on first use.

Every table with several consumers is written once to a store on shared storage
and read back, so later stages get column pruning and filter pushdown, lineage
stays short and a lost executor costs a re-read instead of a re-computation.
Fitted objects (parameters, trees) and metric rows are stored beside them under a
digest of the ledger's content and the parameters, so a later session over the
same ledger fits nothing again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.operators import boosting, clean, features, metrics, recommend, repurchase, segment, split, value
from basketspark.plans.store import ArtefactStore, artefact_digest, default_store
from basketspark.sources import serving
from basketspark.sources.ledger import read_if_present

SNAPSHOTS = ("train", "test")


class Workspace:
    """Ledger in, analysis tables out.

    ``trees`` bounds the boosting rounds per model family; the operators'
    own defaults are larger and apply when a family is not listed. ``store`` is
    the folder of stored artefacts (see :mod:`basketspark.plans.store`);
    ``sources`` are the tables that ``raw`` is derived from, by this library's code:
    with them it is their content that the digest is made of, and the ledger need not
    be joined for it;
    ``vector_source`` is the table behind ``external_vectors``, whose content
    then is part of the digest.
    """

    def __init__(self, spark: SparkSession, raw: Callable[[], DataFrame], key: str = "ledger", window_days: int = split.WINDOW_DAYS,
                 trees: dict[str, int] | None = None, n_init: int = 10, depth: int = 6,
                 external_vectors: Callable[[DataFrame], DataFrame] | None = None,
                 vector_source: Callable[[], DataFrame] | None = None, store: str | None = None,
                 sources: Callable[[], list[DataFrame]] | None = None):
        self.spark, self.raw, self.window_days, self.key = spark, raw, window_days, key
        self.trees, self.n_init, self.depth = trees or {}, n_init, depth
        self.external_vectors, self.vector_source, self.store_folder = external_vectors, vector_source, store
        self.sources = sources or (lambda: [self.raw()])
        self._tables: dict[str, DataFrame] = {}
        self._models: dict[str, object] = {}

    @cached_property
    def digest(self) -> str:
        parameters = {"key": self.key, "window_days": self.window_days, "trees": self.trees, "n_init": self.n_init, "depth": self.depth}
        return artefact_digest(parameters, *self.sources(), *([self.vector_source()] if self.vector_source else []))

    @cached_property
    def store(self) -> ArtefactStore:
        return ArtefactStore(self.spark, self.store_folder or default_store(self.spark), self.digest)

    @property
    def root(self) -> str:
        return self.store.root

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.store.table(name, build)
        return self._tables[name]

    def model(self, name: str, fit: Callable[[], object], kind: str = "json"):
        if name not in self._models:
            self._models[name] = self.store.model(name, fit, kind)
        return self._models[name]

    # --- ledger and snapshots ---

    @cached_property
    def clean_path(self) -> str:
        return self.store.path_of("clean", lambda path: clean.write_clean_tables(self.raw(), path))

    @cached_property
    def purchases(self) -> DataFrame:
        return clean.read_purchases(self.spark, self.clean_path)

    @cached_property
    def returns(self) -> DataFrame:
        found = read_if_present(self.spark, f"{self.clean_path}/side=returns")
        return found if found is not None else self.purchases.limit(0)

    @cached_property
    def snapshots(self) -> dict[str, split.Snapshot]:
        return dict(zip(SNAPSHOTS, split.train_test_snapshots(self.purchases, self.window_days)))

    @property
    def train(self) -> split.Snapshot:
        return self.snapshots["train"]

    @property
    def test(self) -> split.Snapshot:
        return self.snapshots["test"]

    def features(self, name: str) -> DataFrame:
        """Features, first purchase and both labels of a snapshot."""
        cut = self.snapshots[name].cutoff
        return self.table(f"features_{name}", lambda: features.customer_features(
            self.purchases, self.returns, cut, self.window_days, keep_first_purchase=True))

    # --- segmentation (fitted on the train snapshot) ---

    @cached_property
    def scaler(self) -> segment.Scaler:
        return self.model("scaler", lambda: segment.fit_scaler(self.features("train")), "scaler")

    def kmeans(self, k: int = 4):
        return self.model(f"kmeans_{k}", lambda: segment.fit_kmeans(segment.prepare(self.features("train"), self.scaler), k, self.n_init), "kmeans")

    def segment_labels(self, centroids) -> DataFrame:
        return segment.assign_labels(segment.prepare(self.features("train"), self.scaler), centroids)

    def segment_name_list(self, centroids) -> list[str]:
        """Names in segment order (one row per segment on the driver)."""
        prof = segment.segment_profile(self.features("train"), self.segment_labels(centroids))
        rows = {r["segment"]: r["segment_name"] for r in segment.segment_names(prof).collect()}
        return [rows.get(i, "") for i in range(len(centroids))]

    def fitted_segments(self):
        centroids = segment.centroids_of(self.kmeans())
        return centroids, self.model("segment_names", lambda: self.segment_name_list(centroids))

    # --- repurchase ---

    def classifier(self):
        return self.model("classifier", lambda: repurchase.fit_classifier(self.features("train"), self.trees.get("classifier", 600)), "ensemble")

    def repurchase_scored(self) -> DataFrame:
        """Test snapshot with label ``y`` and model probability ``p``."""
        return self.table("repurchase_scored", lambda: repurchase.score(self.classifier(), self.features("test")).withColumn("y", F.col("repurchased")))

    def logistic_scored(self) -> DataFrame:
        return self.table("logistic_scored", lambda: repurchase.baseline_logistic(self.features("train"), self.features("test")).withColumn("y", F.col("repurchased")))

    def repurchase_contenders(self) -> DataFrame:
        rule = repurchase.baseline_recency(self.features("test")).withColumn("y", F.col("repurchased"))
        return self.table("repurchase_contenders", lambda: repurchase.contender_table(
            {"recency rule": rule, "logistic regression": self.logistic_scored(), "boosted trees": self.repurchase_scored()}))

    def calibrated(self) -> DataFrame:
        return self.table("calibrated", lambda: repurchase.calibrate(self.repurchase_scored().select("customer_id", "y", "p")))

    def contributions(self) -> DataFrame:
        return self.table("contributions", lambda: boosting.contributions(self.classifier(), self.features("test"), features.FEATURE_COLUMNS))

    # --- value ---

    def value_params(self) -> tuple[value.PurchaseParams, value.SpendParams]:
        def fit():
            inputs = self.table("bgnbd_input_train", lambda: value.bgnbd_input(self.features("train")))
            repeat = value.repeat_order_value(self.train.observation)
            return value.fit_purchases(inputs), value.fit_spend(inputs, repeat)
        return self.model("value_params", fit, "value")

    def clv_scored(self) -> DataFrame:
        def build():
            served = value.clv_prediction(self.features("test"), self.test.observation, *self.value_params(), days=self.window_days)
            return served.join(self.features("test").select("customer_id", "future_spend"), "customer_id")
        return self.table("clv_scored", build)

    def regressor_scored(self, log_target: bool) -> DataFrame:
        name = "regressor_log" if log_target else "regressor_raw"
        model = self.model(name, lambda: value.fit_regressor(self.features("train"), log_target, self.trees.get("regressor", 2000)), "ensemble")
        return self.table(f"{name}_scored", lambda: value.predict_regressor(model, self.features("test"), log_target))

    def hurdle(self):
        train = self.features("train")
        return (self.model("hurdle_buys", lambda: value.fit_hurdle_classifier(train, self.trees.get("classifier", 600)), "ensemble"),
                self.model("hurdle_amount", lambda: value.fit_hurdle_regressor(train, self.trees.get("regressor", 2000)), "ensemble"))

    def hurdle_scored(self) -> DataFrame:
        return self.table("hurdle_scored", lambda: value.predict_hurdle(*self.hurdle(), self.features("test")))

    def value_contenders(self) -> DataFrame:
        train, test = self.features("train"), self.features("test")
        return self.table("value_contenders", lambda: value.value_contenders({
            "always the mean": value.baseline_mean(train, test), "repeat last 90d": value.baseline_last90(test),
            "BG/NBD + Gamma-Gamma": self.clv_scored(), "boosted (raw)": self.regressor_scored(False),
            "boosted (log target)": self.regressor_scored(True), "hurdle P(buy) x E[spend]": self.hurdle_scored(),
        }))

    # --- recommender: item space and co-purchase come from train and are reused for test ---

    def items(self) -> DataFrame:
        return self.table("items", lambda: recommend.item_index(self.train.observation))

    def n_items(self) -> int:
        return self.model("n_items", lambda: self.items().count())

    def vectors(self, space: str) -> DataFrame:
        def build():
            if space == "external":
                return recommend.normalised_vectors(self.external_vectors(self.items()), "item_idx", "raw").join(
                    self.items().select("item_idx", "stock_code"), "item_idx")
            return recommend.item2vec(recommend.baskets(self.train.observation), self.items())
        return self.table(f"vectors_{space}", build)

    def weights(self, name: str) -> DataFrame:
        snap = self.snapshots[name]
        return self.table(f"weights_{name}", lambda: recommend.purchase_weights(snap.observation, self.items(), snap.cutoff))

    def copurchase(self) -> DataFrame:
        return self.table("copurchase", lambda: recommend.copurchase(self.train.observation, self.items()))

    def co_scores(self, name: str, space: str | None = None) -> DataFrame:
        """Co-purchase scores of each customer's best items and, with a ``space``, of all candidates found in it."""
        return self.table(f"co_scores_{name}_{space}", lambda: recommend.wanted_copurchase(
            self.weights(name), self.copurchase(), self.candidates(name, space) if space else None))

    def item_stats(self, name: str) -> DataFrame:
        return self.table(f"item_stats_{name}", lambda: recommend.item_stats(self.snapshots[name].observation, self.items()))

    def popular(self, name: str) -> DataFrame:
        return self.table(f"popular_{name}", lambda: recommend.popularity_order(self.item_stats(name)))

    def customer_vectors(self, name: str, space: str) -> DataFrame:
        return self.table(f"customer_vectors_{name}_{space}", lambda: recommend.customer_vectors(self.weights(name), self.vectors(space)))

    def retrieved(self, name: str, space: str) -> DataFrame:
        return self.table(f"retrieved_{name}_{space}", lambda: recommend.retrieve_top_n(self.customer_vectors(name, space), self.vectors(space)))

    def candidates(self, name: str, space: str) -> DataFrame:
        return self.table(f"candidates_{name}_{space}", lambda: recommend.build_candidates(
            self.weights(name), self.retrieved(name, space), self.popular(name)))

    def truth(self, name: str) -> DataFrame:
        return self.table(f"truth_{name}", lambda: recommend.truth_pairs(self.snapshots[name].future, self.items()))

    def featured(self, name: str, space: str) -> DataFrame:
        """Candidates with all ranking signals and their label."""
        return self.table(f"featured_{name}_{space}", lambda: recommend.label_candidates(recommend.candidate_features(
            self.candidates(name, space), self.customer_vectors(name, space), self.vectors(space), self.weights(name),
            self.item_stats(name), self.co_scores(name, space), self.features(name)), self.truth(name)))

    def pointwise(self):
        return self.model("pointwise", lambda: recommend.fit_pointwise(
            recommend.group_split(self.featured("train", "learned")), self.trees.get("ranker", 500), self.depth), "ensemble")

    def listwise(self):
        return self.model("listwise", lambda: recommend.fit_listwise(
            recommend.group_split(self.featured("train", "learned")), self.trees.get("listwise", 500), self.depth), "ensemble")

    def ranked_candidates(self) -> DataFrame:
        """Test candidates with both ranker scores."""
        def build():
            rows = boosting.predict_probability(self.pointwise(), self.featured("test", "learned"), recommend.CANDIDATE_FEATURES, "pointwise")
            return boosting.predict_listwise(self.listwise(), rows, recommend.CANDIDATE_FEATURES, "listwise").select(
                "customer_id", "item_idx", "bought_before", "pointwise", "listwise")
        return self.table("ranked_candidates", build)

    def lists(self, space: str = "learned", with_models: bool = True) -> dict[str, DataFrame]:
        """Recommendation lists over all items, per method."""
        w = self.weights("test")
        out = {
            "most popular": recommend.baseline_popular(w.select("customer_id").distinct(), self.popular("test")),
            "co-purchase": recommend.baseline_copurchase(w, self.co_scores("test"), self.n_items()),
            "repeat what they bought": recommend.baseline_repeat(w),
            "stage 1 only": recommend.baseline_stage1(self.retrieved("test", space)),
        }
        if with_models:
            ranked = self.ranked_candidates()
            out["two-stage (pointwise)"] = recommend.top_k(ranked, score="pointwise")
            out["two-stage (listwise)"] = recommend.top_k(ranked, score="listwise")
        return out

    def lists_new(self, space: str = "learned", with_models: bool = True) -> dict[str, DataFrame]:
        """The same methods restricted to products new to the customer."""
        w = self.weights("test")
        owned = recommend.owned_pairs(w)
        everyone = w.select("customer_id").distinct()
        out = {
            "most popular": recommend.recs_new_only(recommend.baseline_popular(everyone, self.popular("test"), recommend.N_CANDIDATES), owned),
            "co-purchase": recommend.baseline_copurchase(w, self.co_scores("test"), self.n_items(), exclude_own=True),
            "repeat what they bought": recommend.baseline_repeat(w).filter(F.lit(False)),
            "stage 1 only": recommend.recs_new_only(self.retrieved("test", space).select("customer_id", "item_idx", "rank"), owned),
        }
        if with_models:
            fresh = recommend.candidates_fresh(self.ranked_candidates())
            out["two-stage (pointwise)"] = recommend.top_k(fresh, score="pointwise")
            out["two-stage (listwise)"] = recommend.top_k(fresh, score="listwise")
        return out

    def reco_contenders(self, space: str = "learned", with_models: bool = True) -> DataFrame:
        """Two metric tables (all items, new items) by method."""
        truth = self.truth("test")
        fresh = recommend.truth_new(truth, recommend.owned_pairs(self.weights("test")))
        out = None
        for scope, lists, answer in (("all items", self.lists(space, with_models), truth), ("new items", self.lists_new(space, with_models), fresh)):
            tagged = reduce(DataFrame.unionByName, [df.select(F.lit(m).alias("contender"), "customer_id", "item_idx", "rank") for m, df in lists.items()])
            rows = metrics.rank_metrics_by(tagged, answer, list(lists)).select(F.lit(scope).alias("scope"), "*")
            out = rows if out is None else out.unionByName(rows)
        return out

    def reco_table(self) -> DataFrame:
        return self.table("reco_contenders", self.reco_contenders)

    def served_lists(self) -> DataFrame:
        return self.table("served_lists", lambda: recommend.top_k(self.ranked_candidates(), score="pointwise"))

    def metrics(self) -> DataFrame:
        """All metric rows of the run, kept in the store: a session that finds them there fits nothing."""
        def build():
            dates = (str(self.train.cutoff.date()), str(self.test.cutoff.date()))
            reco = self.reco_table().withColumn("contender", F.concat_ws(": ", "scope", "contender")).drop("scope")
            return serving.metrics_table({"repurchase": self.repurchase_contenders(), "value": self.value_contenders(), "recommender": reco}, *dates)
        return self.table("metrics", build)
