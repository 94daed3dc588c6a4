"""Quality classifier from trusted positives and unlabelled text (positive-unlabelled learning)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import id_remainder

CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",", "'\"`", "!?", "#$%&*", "|/\\", "()[]{}<>", ":;", "-_~^", "@+="]


def class_table() -> np.ndarray:
    """Byte -> character class; bytes beyond ASCII are one class, all others the last."""
    table = np.full(256, len(CLASSES) + 1, np.intp)
    table[128:] = len(CLASSES)
    for k, chars in enumerate(CLASSES):
        table[list(chars.encode())] = k
    return table


N_CLASSES = len(CLASSES) + 2
N_FEATURES = N_CLASSES * N_CLASSES + 11


def features(text: str | None, table: np.ndarray) -> np.ndarray:
    """Shares of character-class pairs, and measures of length, repetition and word shape, of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(N_FEATURES, np.float32)
    if not raw:
        return out
    kinds = table[np.frombuffer(raw, np.uint8)]
    pairs = np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=N_CLASSES * N_CLASSES)
    out[: N_CLASSES * N_CLASSES] = np.sqrt(pairs / max(len(raw) - 1, 1))
    found = raw.split()
    n = max(len(found), 1)
    counts = Counter(found)
    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    n_lines = max(sum(lines.values()), 1)
    lengths = np.fromiter(map(len, found), np.float64, len(found)) if found else np.zeros(1)
    out[N_CLASSES * N_CLASSES :] = [
        1.0, np.log1p(len(raw)) / 10, np.log1p(len(found)) / 10, len(counts) / n, len(counts) / np.sqrt(n) / 10, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(found, found[1:])) / n, lengths.mean() / 20, lengths.std() / 20, len(lines) / n_lines,
        sum(not w[-1:].isalnum() and w[-1:] < b"\x80" for w in found) / n,
    ]
    return out


@dataclass
class Model:
    """A linear score over standardised features; ``prior`` is the estimated share of good text."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)))


def descend(x: np.ndarray, gradient, steps: int, rate: float, decay: float) -> np.ndarray:
    """Adam from zero over all rows; ``gradient`` maps margins to their derivative of the risk.

    Rows are in single precision and products in double, a stretch of rows at a time.
    """
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(margins(x, w))
        slope = sum((part.T @ own for part, own in zip(stretches(x), stretches(g))), np.zeros(x.shape[1]))
        full = np.append(slope, g.sum()) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def stretches(x: np.ndarray, rows: int = 1024) -> Iterator[np.ndarray]:
    """``x`` in double precision, some rows at a time."""
    for lo in range(0, len(x), rows):
        yield x[lo : lo + rows].astype(np.float64)


def margins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.concatenate([part @ w[:-1] + w[-1] for part in stretches(x)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def mixture_share(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives in unlabelled text: the smallest ratio of the two samples' upper tails.

    Both samples were not used to fit the scores. The threshold is where ratio plus sampling error is least.
    """
    cuts = np.unique(positive)
    up = 1 - np.searchsorted(np.sort(positive), cuts, "left") / len(positive)
    uu = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    error = np.sqrt(np.log(4 / delta) / 2 / len(unlabelled)) + np.sqrt(np.log(4 / delta) / 2 / len(positive))
    best = int(np.argmin(uu / up + error / up))
    return float(np.clip(uu[best] / up[best], 0.01, 0.99))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 500, rate: float = 0.03, decay: float = 1e-4) -> Model:
    """Non-negative unbiased risk: prior * loss(positives as good) + max(0, loss(unlabelled as bad) - prior * loss(positives as bad)).

    The prior is estimated first: a classifier of positives against unlabelled text is fitted on one half of the
    sample and the mixture share read off the other. Where the second term falls below zero, its gradient is
    turned round, which takes back an over-fit.
    """
    both, n_p, n_u = np.vstack([positive, unlabelled]), len(positive), len(unlabelled)
    mean = both.mean(axis=0, dtype=np.float64)
    scale = np.sqrt(sum(((part - mean) ** 2).sum(axis=0) for part in stretches(both)) / len(both))
    scale[scale < 1e-6] = 1.0
    both -= mean.astype(np.float32)
    both /= scale.astype(np.float32)
    p, u = both[:n_p], both[n_p:]

    learnt = np.vstack([p[0::2], u[0::2]])
    h_p = len(p[0::2])
    h_u = len(learnt) - h_p
    label = np.r_[np.ones(h_p), np.zeros(h_u)]
    weight = np.r_[np.full(h_p, 0.5 / h_p), np.full(h_u, 0.5 / h_u)]
    w = descend(learnt, lambda z: weight * (sigmoid(z) - label), steps, rate, decay)
    del learnt
    prior = mixture_share(margins(p[1::2], w), margins(u[1::2], w))

    soft = lambda z: np.logaddexp(0, z)

    def gradient(z: np.ndarray) -> np.ndarray:
        zp, zu = z[:n_p], z[n_p:]
        bad = soft(zu).mean() - prior * soft(zp).mean()
        up, down = -prior * sigmoid(-zp) / n_p, np.r_[-prior * sigmoid(zp) / n_p, sigmoid(zu) / n_u]
        return np.r_[up, np.zeros(n_u)] + down if bad >= 0 else -down

    return Model(descend(both, gradient, steps, rate, decay), mean, scale, prior)


def fit(docs: DataFrame, labels: DataFrame, max_positives: int = 6_000, max_unlabelled: int = 12_000) -> Model | None:
    """Fit on rows whose crc32(doc_id) mod 3 is not 1: at most ``max_positives`` rows labelled good, and at most
    ``max_unlabelled`` rows of any kind whose labels are not looked at, both those of the smallest hash.

    The bounds are the only sample of the operator; ids are chosen first, so only the texts chosen are moved.
    None if there is no positive or no text to learn from.
    """
    learn = id_remainder(F.col("doc_id"), 3) != 1
    order = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    good = labels.filter((F.col("quality") == 1) & learn).select(F.col("doc_id").cast("long")).distinct()
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    good = good.join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(order, "doc_id").limit(max_positives).withColumn("good", F.lit(True))
    other = rows.filter(learn & F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(order.bitwiseXOR(F.lit(0x5555555555555555)), "doc_id").limit(max_unlabelled).withColumn("any", F.lit(True))
    chosen = good.join(other, "doc_id", "full").collect()  # at most the two bounds together
    if not any(r["good"] for r in chosen):
        return None
    chosen = docs.sparkSession.createDataFrame(chosen, "doc_id long, good boolean, any boolean")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = class_table()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "good": batch.good, "any": batch["any"], "x": [features(t, table).tobytes() for t in batch.text]})

    found = rows.join(F.broadcast(chosen), "doc_id").mapInPandas(extract, "doc_id long, good boolean, any boolean, x binary").toPandas()
    found = found.drop_duplicates("doc_id").sort_values("doc_id")
    x = np.frombuffer(b"".join(found["x"]), np.float32).reshape(len(found), N_FEATURES)
    is_good, is_any = (found[c].eq(True).to_numpy(bool) for c in ("good", "any"))
    del found
    if is_good.sum() < 2 or is_any.sum() < 2:
        return None
    return fit_pu(x[is_good], x[is_any])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` with ``quality_score`` (0 to 1) of every whole text; 1 without a model.

    Null and empty texts have the score of a text without any feature.
    """
    return docs.withColumn("quality_score", score_of(docs, model))


def score_of(docs: DataFrame, model: Model | None) -> Column:
    """The score of the column ``text`` as a column; no other column goes through Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        table, own, out = class_table(), sent.value, np.ones(len(texts))
        for lo in range(0, len(texts) if own else 0, 1000):
            out[lo : lo + 1000] = own.scores(np.vstack([features(t, table) for t in texts.iloc[lo : lo + 1000]]).astype(np.float64))
        return pd.Series(out)

    return scores(F.col("text"))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    out = score(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs, labels)).select("doc_id", "quality_score")
    return out.select(
        "doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )
