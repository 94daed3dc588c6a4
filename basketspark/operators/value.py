"""Customer value over the label window: probabilistic pair, boosted challengers, evaluation inputs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.functions.hypergeometric import hyp2f1
from basketspark.functions.ranks import attach_by_score, exact_quantiles, score_ranks
from basketspark.operators import boosting, metrics
from basketspark.operators.features import FEATURE_COLUMNS
from basketspark.operators.split import WINDOW_DAYS
from basketspark.session import cut_lineage


@dataclass(frozen=True)
class PurchaseParams:
    """Purchase process: gamma(r, alpha) rates across customers, beta(a, b) dropout."""

    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class SpendParams:
    """Order value: gamma-gamma with shape p, mixing shape q, scale v. The mean exists only for q > 1."""

    p: float
    q: float
    v: float

    def __post_init__(self):
        if not self.q > 1:
            raise ValueError(f"spend model has q={self.q:.4f} <= 1, so its mean does not exist")

    @property
    def population_mean(self) -> float:
        return self.v * self.p / (self.q - 1)


def bgnbd_input(features: DataFrame) -> DataFrame:
    """(customer_id, x, t_x, t_total): repeat orders, age at the last order, age at the cutoff."""
    return features.select(
        "customer_id", (F.col("frequency") - 1).cast("double").alias("x"),
        (F.col("tenure") - F.col("recency")).cast("double").alias("t_x"), F.col("tenure").cast("double").alias("t_total"),
    )


def input_violations(rows: DataFrame) -> DataFrame:
    """Rows that cannot come from a leak-free snapshot; must count zero."""
    return rows.agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("t_x") > F.col("t_total")).alias("recency_after_end"),
        F.count_if(F.col("x") < 0).alias("negative_frequency"),
    )


def repeat_order_value(observation: DataFrame) -> DataFrame:
    """Mean order value without the first order, for customers with a second one.

    The first order is found with ``min_by``, so the whole thing is two
    mergeable aggregates and no customer's orders are ever sorted in one task.
    """
    orders = observation.groupBy("customer_id", "invoice").agg(F.sum("line_total").alias("value"), F.min("invoice_date").alias("placed"))
    per = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min_by("value", F.struct("placed", "invoice")).alias("first")
    )
    return per.filter("n > 1").select(
        "customer_id", ((F.col("total") - F.col("first")).cast("double") / (F.col("n") - 1)).alias("repeat_value")
    )


# --- maximum likelihood: batches of parameter vectors per pass --------------------------------

def _newton(objective: Callable[[np.ndarray], np.ndarray], start: np.ndarray, max_iter: int = 40, tol: float = 1e-8) -> np.ndarray:
    """Damped Newton on a function evaluated many points at a time (one Spark pass per batch)."""
    theta, h, dim = np.array(start, float), 1e-3, len(start)
    eye = np.eye(dim) * h
    pairs = [(i, j) for i in range(dim) for j in range(i)]
    for _ in range(max_iter):
        probes = [theta] + [theta + e for e in eye] + [theta - e for e in eye]
        probes += [theta + eye[i] + eye[j] for i, j in pairs] + [theta - eye[i] - eye[j] for i, j in pairs]
        f = objective(np.array(probes))
        up, down = f[1:dim + 1], f[dim + 1:2 * dim + 1]
        grad, hess = (up - down) / (2 * h), np.diag((up - 2 * f[0] + down) / h**2)
        for k, (i, j) in enumerate(pairs):
            both, neither = f[2 * dim + 1 + k], f[2 * dim + 1 + len(pairs) + k]
            hess[i, j] = hess[j, i] = (both + neither + 2 * f[0] - up[i] - down[i] - up[j] - down[j]) / (2 * h**2)
        values, vectors = np.linalg.eigh(hess)
        values = np.maximum(np.abs(values), 1e-8)
        steps = []
        for damping in (0.0, 1e-3, 1e-2, 1e-1, 1.0, 10.0):
            step = -vectors @ ((vectors.T @ grad) / (values + damping))
            # long multiples cross the flat valleys of a parameter that tends to zero
            for stretch in (0.3, 1.0, 4.0):
                move = step * stretch
                steps.append(move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-12)))
        trial = objective(theta + np.array(steps))
        trial = np.where(np.isfinite(trial), trial, np.inf)
        best = int(np.argmin(trial))
        if not trial[best] < f[0] - tol * max(1.0, abs(f[0])):
            break
        theta = theta + steps[best]
    return theta


def _batched_mean(stats: DataFrame, columns: list[str], terms: Callable[[pd.DataFrame, np.ndarray], np.ndarray]):
    """Function from parameter vectors to weighted mean log-likelihoods: one aggregate per call."""
    total = stats.agg(F.sum("n")).first()[0]

    def evaluate(thetas: np.ndarray) -> np.ndarray:
        params = np.exp(thetas)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros(len(params))
            for pdf in batches:
                weight = pdf["n"].to_numpy(float)
                for i, vector in enumerate(params):
                    with np.errstate(all="ignore"):
                        sums[i] += float((weight * terms(pdf, vector)).sum())
            yield pd.DataFrame({"i": range(len(params)), "s": sums})

        rows = stats.select(*columns, "n").mapInPandas(partial, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
        out = np.empty(len(params))
        for r in rows:
            out[r["i"]] = r["s"] / total
        return out

    return evaluate


def _log_gamma(values: np.ndarray) -> np.ndarray:
    """lgamma through the few distinct arguments of a batch."""
    distinct, back = np.unique(values, return_inverse=True)
    return np.array([math.lgamma(v) for v in distinct])[back]


def _purchase_terms(pdf: pd.DataFrame, params: np.ndarray) -> np.ndarray:
    r, alpha, a, b = params
    x, t_x, t = (pdf[c].to_numpy(float) for c in ("x", "t_x", "t_total"))
    rate = _log_gamma(r + x) - math.lgamma(r) + r * math.log(alpha)
    stay = _log_gamma(b + x) - math.lgamma(b) - _log_gamma(a + b + x) + math.lgamma(a + b)
    alive = -(r + x) * np.log(alpha + t)
    gone = np.where(x > 0, math.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + t_x), -np.inf)
    return rate + stay + np.logaddexp(alive, gone)


def fit_purchases(inputs: DataFrame, penalty: float = 0.01) -> PurchaseParams:
    """Fit (r, alpha, a, b) by penalised maximum likelihood.

    Customers collapse to counted (x, t_x, T) cells, checkpointed because every
    pass reads them. Time is scaled so the oldest customer has age 1; the
    penalty applies to the parameters on that scale.
    """
    longest = inputs.agg(F.max("t_total")).first()[0]
    cells = cut_lineage(inputs.groupBy("x", "t_x", "t_total").agg(F.count(F.lit(1)).alias("n")).select(
        "x", (F.col("t_x") / F.lit(longest)).alias("t_x"), (F.col("t_total") / F.lit(longest)).alias("t_total"), "n"
    ))
    mean_ll = _batched_mean(cells, ["x", "t_x", "t_total"], _purchase_terms)
    theta = _newton(lambda t: -mean_ll(t) + penalty * np.exp(2 * t).sum(axis=1), np.log([1.0, 0.2, 1.0, 1.0]))
    r, alpha, a, b = np.exp(theta)
    return PurchaseParams(float(r), float(alpha * longest), float(a), float(b))


def _spend_terms(pdf: pd.DataFrame, params: np.ndarray) -> np.ndarray:
    p, q, v = params
    x, m = pdf["x"].to_numpy(float), pdf["m"].to_numpy(float)
    px = p * x
    return (
        _log_gamma(px + q) - _log_gamma(px) - math.lgamma(q) + q * math.log(v) + (px - 1) * np.log(m) + px * np.log(x)
        - (px + q) * np.log(x * m + v)
    )


def fit_spend(inputs: DataFrame, repeat_values: DataFrame, penalty: float = 0.0) -> SpendParams:
    """Fit (p, q, v) on repeaters with positive repeat value; unpenalised by default. Raises when q <= 1."""
    cells = cut_lineage(
        inputs.filter("x > 0").join(repeat_values.filter("repeat_value > 0"), "customer_id")
        .groupBy("x", F.col("repeat_value").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    )
    level = cells.agg(F.sum(F.col("m") * F.col("n")) / F.sum("n")).first()[0]
    mean_ll = _batched_mean(cells, ["x", "m"], _spend_terms)
    theta = _newton(lambda t: -mean_ll(t) + penalty * np.exp(2 * t).sum(axis=1), np.log([2.0, 3.0, level]))
    return SpendParams(*(float(z) for z in np.exp(theta)))


# --- prediction -------------------------------------------------------------------------------

def expected_purchases(inputs: DataFrame, params: PurchaseParams, days: float = WINDOW_DAYS) -> DataFrame:
    """Adds ``direct_purchases`` and ``expected_purchases`` (null where the hypergeometric term is not positive).

    The log form used in practice cannot take a non-positive term, which
    happens for recent single-order customers; the direct value stays finite.
    """
    r, alpha, a, b = params.r, params.alpha, params.a, params.b

    @F.pandas_udf("double")
    def smooth(c: pd.Series, y: pd.Series) -> pd.Series:
        found = hyp2f1(np.full(len(c), a + b - 1 - r), np.full(len(c), a - 1), c.to_numpy(float), y.to_numpy(float))
        return pd.Series(found).astype("Float64")

    x, t_x, t = F.col("x"), F.col("t_x"), F.col("t_total")
    c = F.lit(a + b - 1) + x
    # The term by Euler's transformation: its factor with x in the exponent cancels, and what is left is near one.
    y = (F.lit(alpha) + t) / (F.lit(alpha) + t + F.lit(float(days)))
    top = c / F.lit(a - 1) * (1 - F.col("hyp") * F.pow(y, F.lit(a - 1)))
    gone = F.when(x > 0, F.lit(a) / (F.lit(b - 1) + x) * F.pow((F.lit(alpha) + t) / (F.lit(alpha) + t_x), F.lit(r) + x)).otherwise(0.0)
    return (
        inputs.withColumn("hyp", smooth(c.cast("double"), y))
        .withColumn("direct_purchases", top / (1 + gone))
        .withColumn("expected_purchases", F.when(F.col("hyp") > 0, F.col("direct_purchases")))
        .drop("hyp")
    )


def undefined_fill(predicted: DataFrame) -> DataFrame:
    """Fill undefined expectations with the median of defined single-order customers, else of everyone defined."""
    value = "expected_purchases"
    fill = exact_quantiles(predicted.filter("x = 0"), value, [0.5]) or exact_quantiles(predicted, value, [0.5])
    filled = F.coalesce(F.col(value), F.lit(fill[0] if fill else None).cast("double"))
    return predicted.withColumn("was_undefined", F.col(value).isNull()).withColumn(value, filled)


def expected_order_value(inputs: DataFrame, repeat_values: DataFrame, params: SpendParams) -> DataFrame:
    """Own repeat mean shrunk toward the population mean by the number of repeat orders."""
    px = F.lit(params.p) * F.col("x")
    weight = px / (px + F.lit(params.q - 1))
    # Without a repeat order the weight is zero, so the population mean is what remains.
    own = F.coalesce(F.col("repeat_value"), F.lit(0.0))
    return inputs.join(repeat_values, "customer_id", "left").withColumn(
        "expected_value", (1 - weight) * F.lit(params.population_mean) + weight * own
    )


def p_alive(params: PurchaseParams) -> Column:
    x = F.col("x")
    odds = F.lit(params.a) / (F.lit(params.b - 1) + x) * F.pow(
        (F.lit(params.alpha) + F.col("t_total")) / (F.lit(params.alpha) + F.col("t_x")), F.lit(params.r) + x
    )
    return F.when(x == 0, F.lit(1.0)).otherwise(1 / (1 + odds))


def clv_prediction(features: DataFrame, observation: DataFrame, buying: PurchaseParams, spending: SpendParams,
                   days: int = WINDOW_DAYS) -> DataFrame:
    """Expected purchases x expected order value, with p_alive and the undefined flag."""
    counts = undefined_fill(expected_purchases(bgnbd_input(features), buying, days))
    return expected_order_value(counts, repeat_order_value(observation), spending).select(
        "customer_id", "x", "t_x", "t_total", "expected_purchases", "was_undefined", "expected_value",
        (F.col("expected_purchases") * F.col("expected_value")).alias("p"), p_alive(buying).alias("p_alive"),
    )


def bgnbd_coverage(predicted: DataFrame) -> DataFrame:
    bad = F.col("expected_purchases").isNull()
    return predicted.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("undefined"),
        F.bround(100 * F.avg(bad.cast("double")), 1).alias("pct_undefined"),
        F.coalesce(F.bool_and(F.when(bad, F.col("x") == 0)), F.lit(True)).alias("all_undefined_are_never_repeated"),
    )


def p_alive_summary(inputs: DataFrame, params: PurchaseParams) -> DataFrame:
    alive = inputs.select(p_alive(params).alias("p_alive"))
    return alive.agg(F.avg("p_alive").alias("mean_p_alive"), F.count_if(F.col("p_alive") < 0.2).alias("below_0_2"))


def population_mean_check(repeat_values: DataFrame, params: SpendParams) -> DataFrame:
    return repeat_values.agg(F.lit(params.population_mean).alias("model_mean"), F.avg("repeat_value").alias("empirical_mean"))


def params_table(spark: SparkSession, buying: PurchaseParams, spending: SpendParams) -> DataFrame:
    return spark.createDataFrame([{**asdict(buying), **asdict(spending)}], "r double, alpha double, a double, b double, p double, q double, v double")


def load_params(table: DataFrame) -> tuple[PurchaseParams, SpendParams]:
    """Parameters back from their one row; the q > 1 guard applies again."""
    row = table.first()
    return PurchaseParams(row["r"], row["alpha"], row["a"], row["b"]), SpendParams(row["p"], row["q"], row["v"])


# --- boosted challengers ----------------------------------------------------------------------

def fit_regressor(train: DataFrame, log_target: bool = False, trees: int = 2000):
    y = F.log1p("future_spend") if log_target else F.col("future_spend")
    return boosting.fit_gbt_regressor(boosting.with_holdout(train), FEATURE_COLUMNS, y, trees)


def predict_regressor(model, features: DataFrame, log_target: bool = False) -> DataFrame:
    out = boosting.predict_value(model, features, FEATURE_COLUMNS, "raw")
    value = F.expm1("raw") if log_target else F.col("raw")
    return out.withColumn("p", F.greatest(value, F.lit(0.0))).drop("raw")


def fit_hurdle_classifier(train: DataFrame, trees: int = 600):
    """P(spends anything) on everyone."""
    return boosting.fit_gbt_classifier(boosting.with_holdout(train), FEATURE_COLUMNS, (F.col("future_spend") > 0).cast("int"), trees)


def fit_hurdle_regressor(train: DataFrame, trees: int = 2000):
    """Log spend on spenders only."""
    spenders = boosting.with_holdout(train).filter("future_spend > 0")
    return boosting.fit_gbt_regressor(spenders, FEATURE_COLUMNS, F.log1p("future_spend"), trees)


def fit_hurdle(train: DataFrame, clf_trees: int = 600, reg_trees: int = 2000):
    """Both parts of the hurdle model."""
    return fit_hurdle_classifier(train, clf_trees), fit_hurdle_regressor(train, reg_trees)


def predict_hurdle(clf, reg, features: DataFrame) -> DataFrame:
    both = boosting.predict_value(reg, boosting.predict_probability(clf, features, FEATURE_COLUMNS, "p_buys"), FEATURE_COLUMNS, "log_amount")
    return both.withColumn("amount", F.expm1("log_amount")).withColumn(
        "p", F.greatest(F.col("p_buys") * F.col("amount"), F.lit(0.0))
    ).drop("log_amount")


# --- baselines and tables ---------------------------------------------------------------------

def baseline_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    """The training mean for everyone: one number, used as a literal."""
    mean = train.agg(F.avg("future_spend")).first()[0]
    return test.withColumn("p", F.lit(float(mean)))


def baseline_last90(test: DataFrame) -> DataFrame:
    return test.withColumn("p", F.col("spend_last_90d"))


def value_contenders(contenders: dict[str, DataFrame], y: str = "future_spend") -> DataFrame:
    """Metric row per contender with the best by Spearman (undefined never wins) and by MAE marked."""
    rows = reduce(DataFrame.unionByName, [
        metrics.regression_metrics(df, y, "p").withColumn("contender", F.lit(name)) for name, df in contenders.items()
    ])
    rows = cut_lineage(rows)  # one row per contender, read three times below
    best_rank = rows.filter(F.col("spearman").isNotNull()).agg(F.max_by("contender", "spearman")).scalar()
    best_mae = rows.agg(F.min_by("contender", "mae")).scalar()
    return rows.select(
        "contender", "mae", "rmse", "r2", "spearman", "mean_pred", "mean_actual",
        F.coalesce(F.col("contender") == best_rank, F.lit(False)).alias("best_by_spearman"), (F.col("contender") == best_mae).alias("best_by_mae"),
    )


def value_decile(scored: DataFrame, p: str = "p") -> DataFrame:
    """Decile from the number of customers at or above each value."""
    per = score_ranks(scored.select(p), p)
    from_top = F.col("n_rows") - F.col("first_rank") + 1
    tenth = F.least(F.lit(10), F.greatest(F.lit(1), 1 + F.floor((from_top - 1) * 10 / F.col("n_rows")))).cast("int")
    return attach_by_score(scored, per.withColumn("value_decile", tenth), p, ["value_decile"]).select(*scored.columns, "value_decile")


def value_scores(served: DataFrame, hurdle: DataFrame, as_of: str, served_mae: float, challenger_mae: float) -> DataFrame:
    """Served value and p_alive with the challenger's parts; the caveat quotes the measured errors."""
    caveat = (
        "Undefined expectations are filled with the median for single-order customers, never with zero. "
        f"Mean absolute error on the test window: {served_mae:.0f} served, {challenger_mae:.0f} challenger."
    )
    parts = hurdle.select(
        "customer_id", F.round("p_buys", 4).alias("p_buys_at_all"), F.round("amount", 2).alias("expected_amount_if_they_buy"),
        F.round("p", 2).alias("challenger_estimate"),
    )
    return value_decile(served.select("customer_id", "p", "p_alive")).join(parts, "customer_id").select(
        "customer_id", F.round("p", 2).alias("expected_spend_90d"), F.round("p_alive", 4).alias("p_still_alive"), "value_decile",
        "p_buys_at_all", "expected_amount_if_they_buy", "challenger_estimate",
        F.concat(F.lit("Expected to spend "), F.format_number("p", 0), F.lit(f" in the 90 days after {as_of}, value decile "),
                 F.col("value_decile").cast("string"), F.lit(" of 10 (1 = most valuable).")).alias("reading"),
        F.lit(caveat).alias("caveat"),
    )


def independence_check(features: DataFrame) -> DataFrame:
    """Rank correlation of order count and order value among repeaters; the spend model needs it small."""
    return metrics.spearman(features.filter("frequency > 1"), "frequency", "avg_order_value").select(
        "spearman", (F.abs("spearman") < 0.3).alias("is_small")
    )
