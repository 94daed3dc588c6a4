"""Language identification by interpolated Kneser-Ney character models.

A text is read as letters, lower-cased, with one space for every run of other signs. Each language has a model of
four-character runs: the counts of runs at the top, below it the number of different characters that a shorter run
was seen after. A run's hash is its four characters in 16 bits each, so that its context and its ending are shifts of
it. All languages together are stored as sorted arrays of these hashes, with a row of log probabilities (one column a
language) for every run and one of back-off weights for every context, so a position costs one search whatever the
number of languages. The language with the lowest cross-entropy a character is predicted.

A tenth of the learning documents is kept out of the counts to calibrate: they give the cross-entropies that texts of
a language and length have, beyond which a text is rejected, and the probability that a prediction with such a lead
over the second best is right.

Where the runs of all languages are too many to be sent to the tasks, nothing is left out: the same probabilities are
computed by joins for all runs that occur in the texts. The most frequent of these are sent, the others are joined
with the texts that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketspark.llm.common import Written, map_frames

ORDER = 4
CELLS = 24_000_000  # log probabilities in all tables at most: bounds what is broadcast
MOST_RUNS = 300_000  # runs of a language at most
CHARS = 1 << 19  # characters looked up together
SPACE = 32
BUCKETS = 24  # of text length, by powers of two
LEADS = 64  # bins of the lead over the second best
NO_LANGUAGE = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point the code of its lower-case letter (16 bits; those beyond share codes), a space for other signs."""
    if not _letters:
        codes = (ord(c.lower()[0]) if c.isalpha() else SPACE for c in map(chr, range(0x110000)))
        table = np.fromiter(codes, np.uint32, 0x110000)
        _letters.append(np.where(table < 1 << 16, table, 0xE000 + table % 0x1900).astype(np.uint16))
    return _letters[0]


def codes_of(text: str | None) -> np.ndarray:
    """Codes of a text: three spaces, then its letters with single spaces between words, and a space; empty without a letter."""
    if not text:
        return np.zeros(0, np.uint16)
    c = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    c = c[(c != SPACE) | (np.r_[np.uint16(SPACE), c[:-1]] != SPACE)]
    if not len(c):
        return c
    return np.r_[np.full(ORDER - 1, SPACE, np.uint16), c, np.full(int(c[-1] != SPACE), SPACE, np.uint16)]


def runs_of(codes: np.ndarray) -> np.ndarray:
    """The hash of the run that ends at each place from the fourth."""
    c = codes.astype(np.uint64)
    n = max(0, len(c) - ORDER + 1)
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out = (out << np.uint64(16)) | c[k : k + n]
    return out


def run_counts(docs: DataFrame, flush: int = 300_000) -> DataFrame:
    """lang, run, n over all of ``docs`` (lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, runs: np.ndarray) -> None:
            key, n = np.unique(runs, return_counts=True)
            if lang in held:
                key, at = np.unique(np.r_[held[lang][0], key], return_inverse=True)
                n = np.bincount(at, np.r_[held[lang][1], n]).astype(np.int64)
            held[lang] = key, n

        def sent() -> pd.DataFrame:
            parts = [pd.DataFrame({"lang": lang, "run": key.view(np.int64), "n": n}) for lang, (key, n) in held.items()]
            return pd.concat(parts) if parts else pd.DataFrame({"lang": [], "run": [], "n": []})

        for batch in batches:
            waiting: dict[str, list[np.ndarray]] = {}
            size: dict[str, int] = {}
            for lang, text in zip(batch.lang, batch.text):
                codes = codes_of(text)
                for lo in range(0, max(0, len(codes) - ORDER + 1), CHARS):
                    runs = runs_of(codes[lo : lo + CHARS + ORDER - 1])
                    waiting.setdefault(lang, []).append(runs)
                    size[lang] = size.get(lang, 0) + len(runs)
                    if size[lang] > CHARS:
                        add(lang, np.concatenate(waiting.pop(lang)))
                        size[lang] = 0
            for lang, rest in waiting.items():
                add(lang, np.concatenate(rest))
            if sum(len(key) for key, _ in held.values()) > flush:
                yield sent()
                held.clear()
        yield sent()

    return map_frames(docs, count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """One order: runs with their log2 probabilities, contexts with their log2 back-off weights, a column a language."""

    runs: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys in an ascending array, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def one_language(runs: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Per order from 1 to 4: runs, discounted shares, contexts, and the weight each context gives to the shorter order."""
    levels = []
    for order in range(ORDER, 0, -1):
        ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, first, at = np.unique(runs >> np.uint64(16), return_index=True, return_inverse=True)
        total = np.bincount(at, counts)
        kinds = np.bincount(at)
        levels.append((runs, np.maximum(counts - discount, 0) / total[at], contexts, discount * kinds / total))
        if order > 1:  # what a shorter run counts is how many different characters came before it
            runs, counts = np.unique(runs & np.uint64((1 << (16 * (order - 1))) - 1), return_counts=True)
    return levels[::-1]


class Models:
    """The models of all languages, merged by order."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        own = [one_language(*counts[lang]) for lang in self.langs]
        n = len(own)
        alphabet = len(np.unique(np.concatenate([o[0][0] for o in own]))) + 1 if own else 1
        self.levels: list[Level] = []
        shorter = np.full((1, n), 1.0 / alphabet)  # any character that no language knows
        for order in range(1, ORDER + 1 if n else 1):
            runs = np.unique(np.concatenate([o[order - 1][0] for o in own]))
            contexts = np.unique(np.concatenate([o[order - 1][2] for o in own]))
            share, weight = np.zeros((len(runs), n)), np.ones((len(contexts), n))
            for k, o in enumerate(own):
                r, s, c, w = o[order - 1]
                share[np.searchsorted(runs, r), k] = s
                weight[np.searchsorted(contexts, c), k] = w
            at = np.zeros(len(runs), np.int64) if order == 1 else np.searchsorted(last, runs & np.uint64((1 << (16 * (order - 1))) - 1))
            p = share + weight[np.searchsorted(contexts, runs >> np.uint64(16))] * shorter[at]
            self.levels.append(Level(runs, np.log2(p).astype(np.float32), contexts, np.log2(weight).astype(np.float32)))
            shorter, last = p, runs
        self.unknown = -np.log2(alphabet)

    def logs(self, runs: np.ndarray) -> np.ndarray:
        """log2 probability of the last character of each run after the others, a column a language."""
        out = np.zeros((len(runs), len(self.langs)), np.float32)
        left = np.arange(len(runs))
        for order in range(ORDER if self.levels else 0, 0, -1):
            level = self.levels[order - 1]
            own = runs[left] & np.uint64((1 << (16 * order)) - 1)
            at, met = find(level.runs, own)
            out[left[met]] += level.logs[at[met]]
            left, own = left[~met], own[~met]
            if not len(left):
                break
            at, met = find(level.contexts, own >> np.uint64(16))  # an unseen run: the context's weight, then the shorter run
            out[left[met]] += level.weights[at[met]]
        out[left] += self.unknown
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Characters predicted in each text, and bits a character for each language."""
        n, bits = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.langs)))
        held: list[tuple[int, np.ndarray]] = []
        size, most = 0, max(1, CHARS * 4 // max(4, len(self.langs)))

        def score() -> None:
            if held:
                starts = np.cumsum([0, *[len(r) for _, r in held[:-1]]])
                sums = np.add.reduceat(self.logs(np.concatenate([r for _, r in held])), starts, axis=0, dtype=np.float64)
                np.subtract.at(bits, [k for k, _ in held], sums)
            held.clear()

        for k, text in enumerate(texts):
            codes = codes_of(text)
            for lo in range(0, max(0, len(codes) - ORDER + 1), most):
                runs = runs_of(codes[lo : lo + most + ORDER - 1])
                held.append((k, runs))
                n[k] += len(runs)
                if (size := size + len(runs)) >= most:
                    score()
                    size = 0
        score()
        return n, bits / np.maximum(n, 1)[:, None]


@dataclass
class Calibration:
    """Highest usual cross-entropy by language and length, and the probability of a right prediction by its lead."""

    limits: np.ndarray
    slope: float
    start: float

    def probability(self, lead: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.start + self.slope * lead, -30, 30)))


def ranked(models: Models, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Length, best language, its cross-entropy, and its lead: log2(1 + bits that the second best needs more)."""
    return leading(*models.entropies(texts))


def leading(n: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same from lengths and bits a character for each language."""
    if not h.shape[1]:
        return n, np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
    best = np.argmin(h, axis=1)
    own = h[np.arange(len(n)), best]
    rest = np.partition(h, 1, axis=1)[:, 1] if h.shape[1] > 1 else own + 8
    return n, best, own, np.log2(1 + n * (rest - own))


def length_bucket(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), BUCKETS - 1)


def fit_models(docs: DataFrame) -> Models:
    """Models of all languages in ``docs`` (lang, text). Of a language with too many runs the most frequent are kept; :func:`identified` then takes :func:`measured_by_joins`."""
    written = Written(docs.sparkSession, "language-models")
    models = models_of(written.keep(run_counts(docs), "counts"))
    written.drop("counts")
    return models


def most_runs(langs: int) -> int:
    """Runs of a language that models sent to all tasks may hold."""
    return max(1, min(MOST_RUNS, CELLS // (2 * ORDER * max(1, langs) ** 2)))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows (lang, run, n, ...) of each language's most frequent runs, at most ``most``, those of equal counts alike."""
    by_count = counts.groupBy("lang", "n").agg(F.count("*").alias("runs"))
    at_least = Window.partitionBy("lang").orderBy(F.desc("n"))
    cut = by_count.withColumn("runs", F.sum("runs").over(at_least)).filter(F.col("runs") <= most).groupBy("lang").agg(F.min("n").alias("least"))
    return counts.join(F.broadcast(cut), "lang").filter("n >= least").drop("least")  # a row a language on the one side


def models_of(counts: DataFrame) -> Models:
    """Models from written counts (lang, run, n)."""
    kept = most_frequent(counts, most_runs(counts.select("lang").distinct().count()))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                yield pd.DataFrame({"lang": [lang], "runs": [part.run.to_numpy(np.int64).tobytes()], "n": [part.n.to_numpy(np.int64).tobytes()]})

    rows = kept.select("lang", "run", "n").mapInPandas(pack, "lang string, runs binary, n binary").collect()
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for lang in sorted({r["lang"] for r in rows}):
        runs = np.frombuffer(b"".join(r["runs"] for r in rows if r["lang"] == lang), np.uint64)
        order = np.argsort(runs)
        found[lang] = runs[order], np.frombuffer(b"".join(r["n"] for r in rows if r["lang"] == lang), np.int64)[order]
    return Models(found)


def shorter(run: Column, order: int) -> Column:
    """The last ``order`` characters of a run."""
    return run.bitwiseAND(F.lit((1 << (16 * order)) - 1).cast("long"))


def run_logs(counts: DataFrame, met: DataFrame, langs: list[str], written: Written) -> DataFrame:
    """run, n, logs for every row of ``met`` (run, n): log2 probabilities of its last character, one a language, from all ``counts`` (lang, run, n)."""
    place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int")
    levels = {ORDER: counts.select(place.alias("k"), "run", "n")}
    for order in range(ORDER - 1, 0, -1):  # what a shorter run counts is how many different characters came before it
        levels[order] = written.keep(levels[order + 1].groupBy("k", shorter(F.col("run"), order).alias("run")).agg(F.count("*").alias("n")), "level")
    alphabet = levels[1].select("run").distinct().count() + 1
    both = (F.col("ones") > 0) & (F.col("twos") > 0)
    logs = None
    for order in range(1, ORDER + 1):
        level = levels[order].withColumn("context", F.shiftrightunsigned("run", 16))
        discounts = level.groupBy("k").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
        discounts = F.broadcast(discounts.select("k", F.when(both, F.col("ones") / (F.col("ones") + 2 * F.col("twos"))).otherwise(0.5).alias("d")))  # a row a language
        contexts = level.groupBy("k", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).join(discounts, "k")
        shares = level.join(contexts, ["k", "context"]).withColumn("share", F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total"))
        shares = shares.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("k", "share"))).alias("shares"))
        weights = contexts.withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        weights = weights.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("k", "weight"))).alias("weights"))
        own = met.select("run") if order == ORDER else met.select(shorter(F.col("run"), order).alias("run")).distinct()
        own = own.withColumn("context", F.shiftrightunsigned("run", 16))
        if order == 1:
            own = own.withColumn("p", F.array_repeat(F.lit(1.0 / alphabet), len(langs)))
        else:
            own = own.withColumn("end", shorter(F.col("run"), order - 1)).join(logs.withColumnRenamed("run", "end"), "end")
        own = own.join(shares, "run", "left").join(weights, "context", "left")

        def known(x: Column, i: Column) -> Column:
            return F.coalesce(F.try_element_at("shares", i + 1), F.lit(0.0)) + F.coalesce(F.try_element_at("weights", i + 1), F.lit(1.0)) * x

        logs = written.keep(own.select("run", F.transform("p", known).alias("p")), "logs")
    return met.select("run", "n").join(logs, "run").select("run", "n", F.transform("p", lambda x: F.log2(x)).alias("logs"))


def measured_by_joins(rows: DataFrame, counts: DataFrame, langs: list[str], written: Written) -> DataFrame:
    """``rows`` (text and other columns) with n, best, h and lead (see :func:`ranked`) in place of text, by models of all ``counts``.

    The most frequent runs of the texts are looked up in place; the others, each with its count, are joined.
    """
    met = written.keep(run_counts(rows.select(F.lit("").alias("lang"), "text")), "met")
    logs = written.keep(run_logs(counts, met, langs, written), "run-logs")
    top = most_frequent(logs.withColumn("lang", F.lit("")), max(1, min(MOST_RUNS, CELLS // (2 * ORDER * len(langs))))).select("run", "logs")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"runs": [batch.run.to_numpy(np.int64).tobytes()], "logs": [np.stack(batch.logs.to_numpy()).astype(np.float64).tobytes()]})

    packed = top.mapInPandas(pack, "runs binary, logs binary").collect()
    runs = np.frombuffer(b"".join(r["runs"] for r in packed), np.uint64)
    order = np.argsort(runs)
    sent = rows.sparkSession.sparkContext.broadcast((runs[order], np.frombuffer(b"".join(r["logs"] for r in packed), np.float64).reshape(-1, len(langs))[order]))
    others = [c for c in rows.columns if c != "text"]

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_runs, own_logs = sent.value
        for batch in batches:
            found = []
            for text in batch.text:
                codes, n, bits, left = codes_of(text), 0, np.zeros(len(langs)), []
                for lo in range(0, max(0, len(codes) - ORDER + 1), CHARS):
                    run, times = np.unique(runs_of(codes[lo : lo + CHARS + ORDER - 1]), return_counts=True)
                    at, known = find(own_runs, run)
                    n += int(times.sum())
                    if known.any():
                        bits -= times[known] @ own_logs[at[known]]
                    left.append((run[~known].view(np.int64), times[~known]))
                found.append((n, bits, np.concatenate([r for r, _ in left] or [np.zeros(0, np.int64)]), np.concatenate([t for _, t in left] or [np.zeros(0, np.int64)])))
            out = batch[[*others, "row"]].copy()
            for k, name in enumerate(("n", "bits", "rest", "times")):
                out[name] = pd.Series([f[k] for f in found], index=out.index, dtype=object if k else np.int64)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*others).schema).replace("bigint", "long")
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    looked = written.keep(map_frames(numbered, look_up, f"{schema}, row long, n long, bits array<double>, rest array<long>, times array<long>"), "looked")
    rest = looked.select("row", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("row", F.col("r.rest").alias("run"), F.col("r.times").alias("times"))
    rest = rest.join(logs.select("run", "logs"), "run").groupBy("row").agg(F.array(*[F.sum(F.col("times") * F.col("logs")[k]) for k in range(len(langs))]).alias("more"))
    whole = looked.join(rest, "row", "left").withColumn("bits", F.when(F.col("more").isNull(), F.col("bits")).otherwise(F.zip_with("bits", "more", lambda a, b: a - b)))

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                n = batch.n.to_numpy(np.int64)
                _, best, h, ahead = leading(n, np.stack(batch.bits.to_numpy()) / np.maximum(n, 1)[:, None])
                yield batch[[*others, "n"]].assign(best=best, h=h, lead=ahead)

    measured = written.keep(map_frames(whole.select(*others, "n", "bits"), lead, f"{schema}, n long, best int, h double, lead double"), "measured")
    written.drop("level", "logs", "met", "run-logs", "looked")
    return measured


def calibrated(models: Models, docs: DataFrame, wrong: float = 0.002) -> Calibration:
    """Limits and probabilities from documents (lang, text) that the models have not counted.

    A limit is passed by a share of ``wrong`` of the right texts of its language and length; a class of under 50 texts
    takes that of all lengths, and a language of under 50 has none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)
    place = {lang: k for k, lang in enumerate(models.langs)}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, best, h, lead = ranked(sent.value, list(batch.text))
            right = np.array([place.get(x, -1) for x in batch.lang], np.int64) == best
            out = pd.DataFrame({"best": best, "length": length_bucket(n), "h": h, "lead": np.minimum(lead / 16 * LEADS, LEADS - 1).astype(int), "hit": right})
            yield out[n > 0]

    seen = Written(docs.sparkSession, "calibration").keep(map_frames(docs, measure, "best int, length int, h double, lead int, hit boolean"), "seen")
    return calibration_of(seen, len(models.langs), wrong)


def calibration_of(seen: DataFrame, langs: int, wrong: float = 0.002) -> Calibration:
    """The same from best, length (bucket), h, lead (bin) and hit of each text."""
    leads = seen.groupBy("lead").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits")).collect()
    top = F.percentile_approx("h", 1 - wrong, 10_000).alias("limit")
    usual = seen.filter("hit").groupBy("best", "length").agg(F.count("*").alias("n"), top).collect()
    whole = seen.filter("hit").groupBy("best").agg(F.count("*").alias("n"), top).collect()
    limits = np.full((langs, BUCKETS), np.inf)
    for r in whole:
        if r["n"] >= 50:
            limits[r["best"]] = r["limit"]
    for r in usual:
        if r["n"] >= 50:
            limits[r["best"], r["length"]] = r["limit"]
    return Calibration(limits, *logistic(leads))


def logistic(leads: list) -> tuple[float, float]:
    """Slope and start of the logistic curve of hits over leads, each side weighed with one text more, by Newton's steps."""
    x = np.array([(r["lead"] + 0.5) * 16 / LEADS for r in leads] + [0.0, 16.0])
    n = np.array([float(r["n"]) for r in leads] + [1.0, 1.0])
    hits = np.array([float(r["hits"]) for r in leads] + [0.0, 1.0])
    design, beta = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (hits - n * p) - 1e-3 * beta
        beta = beta + np.clip(np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), slope), -1, 1)
    return max(0.0, float(beta[1])), float(beta[0])


def identified(docs: DataFrame, learn: Column) -> DataFrame:
    """doc_id, lang_pred, score, bits, n_chars and accepted of every row of ``docs`` (doc_id, text, lang).

    Learned from the rows where ``learn`` holds and lang is not null; nothing but a row's text enters its prediction.
    ``lang_pred``: the language with the fewest bits a character, ties to the first by name; ``und`` for null and empty
    texts and those without a letter (score 0, no bits), and for all where nothing could be learned. ``score``:
    calibrated probability that it is right. ``accepted``: whether its bits are usual for the language and length; a
    caller that must not guess takes the others as unknown. Every row is judged, repeated ones alike.
    """
    spark, written = docs.sparkSession, Written(docs.sparkSession, "language-models")
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    teaches = learn & F.col("lang").isNotNull() & F.col("text").isNotNull()
    kept_out = F.pmod(F.xxhash64("text"), F.lit(10)) == 0
    labelled = rows.filter(teaches).select("lang", "text")
    counts = written.keep(run_counts(labelled.filter(~kept_out)), "counts")
    own_runs = {r["lang"]: r["runs"] for r in counts.groupBy("lang").agg(F.count("*").alias("runs")).collect()}

    def judged(doc_id: pd.Series, n: np.ndarray, best: np.ndarray, h: np.ndarray, lead: np.ndarray, langs: list[str], own: Calibration) -> pd.DataFrame:
        names = np.array([*langs, NO_LANGUAGE], object)
        some = (n > 0) & (len(langs) > 0)
        usual = some & (h <= own.limits[best, length_bucket(n)]) if len(langs) else some
        return pd.DataFrame({
            "doc_id": doc_id, "lang_pred": names[np.where(some, best, len(langs))], "score": np.where(some, own.probability(lead), 0.0),
            "bits": pd.Series(h).where(some), "n_chars": n, "accepted": usual,
        })

    schema = "doc_id long, lang_pred string, score double, bits double, n_chars long, accepted boolean"
    if max(own_runs.values(), default=0) <= most_runs(len(own_runs)):
        models = models_of(counts)
        written.drop("counts")
        known = spark.sparkContext.broadcast((models, calibrated(models, labelled.filter(kept_out))))

        def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            models, own = known.value
            for batch in batches:
                yield judged(batch.doc_id, *ranked(models, list(batch.text)), models.langs, own)

        return map_frames(rows.select("doc_id", "text"), predict, schema)

    langs = sorted(own_runs)
    tests = F.coalesce(teaches & kept_out, F.lit(False)).alias("tests")
    measured = measured_by_joins(rows.select("doc_id", "text", "lang", tests), counts, langs, written)
    written.drop("counts")
    place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
    length = F.least(F.floor(F.log2(F.greatest("n", F.lit(1)))), F.lit(BUCKETS - 1)).cast("int")
    seen = measured.filter("tests AND n > 0").select("best", length.alias("length"), "h", F.least(F.floor(F.col("lead") / 16 * LEADS), F.lit(LEADS - 1)).cast("int").alias("lead"), (place == F.col("best")).alias("hit"))
    calibration = calibration_of(seen, len(langs))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield judged(batch.doc_id, *(batch[c].to_numpy() for c in ("n", "best", "h", "lead")), langs, calibration)

    return map_frames(measured.select("doc_id", "n", "best", "h", "lead"), judge, schema)
