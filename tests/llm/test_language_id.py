"""Language identification: the models against plain Kneser-Ney, held-out accuracy, odd rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.llm import language_id as L
from basketspark.llm import queries

SMALL = "/root/testdata/sf0.01"


def read(text):
    out = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
    return "   " + " ".join(out.split()) + " " if out.split() else ""


def plain_models(rows, order=4):
    """lang -> function(run) -> probability of its last character, and the alphabet; straight from the definition."""
    top = defaultdict(Counter)
    for lang, text in rows:
        t = read(text)
        top[lang].update(t[i : i + order] for i in range(len(t) - order + 1))
    tables, signs = {}, set()
    for lang, counts in top.items():
        tables[lang] = {order: counts}
        for k in range(order - 1, 0, -1):
            tables[lang][k] = Counter(g[1:] for g in tables[lang][k + 1])
        signs |= set(tables[lang][1])

    def model(own):
        discounts = {}
        for k, t in own.items():
            ones, twos = sum(c == 1 for c in t.values()), sum(c == 2 for c in t.values())
            discounts[k] = ones / (ones + 2 * twos) if ones and twos else 0.5

        def p(run):
            if not run:
                return 1 / (len(signs) + 1)
            t, d = own[len(run)], discounts[len(run)]
            same = [c for g, c in t.items() if g[:-1] == run[:-1]]
            if not same:
                return p(run[1:])
            return max(t[run] - d, 0) / sum(same) + d * len(same) / sum(same) * p(run[1:])

        return p

    return {lang: model(own) for lang, own in tables.items()}


def models_of(spark, rows):
    return L.fit_models(spark.createDataFrame(rows, "lang string, text string").repartition(3))


def test_models_equal_plain_kneser_ney(spark, monkeypatch):
    rows = [("en", "The cat sat on the mat. The Cat!"), ("en", "that hat; a bat 42"), ("de", "Die Katze saß auf der Matte"), ("fr", "漢字 çà\U00020000 là"), ("fr", "")]
    models, plain = models_of(spark, rows), plain_models(rows)
    texts = ["the cat, die Katze", "zzz qqq", "漢 ß", "", None, "12 .", "a"]
    monkeypatch.setattr(L, "CHARS", 5)
    n, h = models.entropies(texts)
    for k, text in enumerate(texts):
        t = read(text)
        runs = [t[i : i + 4] for i in range(len(t) - 3)] if t else []
        assert n[k] == len(runs)
        for j, lang in enumerate(models.langs):
            assert h[k, j] == pytest.approx(-sum(math.log2(plain[lang](r)) for r in runs) / max(1, len(runs)), rel=1e-5)
    for level in models.levels:
        assert (np.diff(level.runs.astype(object)) > 0).all() and (np.diff(level.contexts.astype(object)) > 0).all()
    whole = [sum(p(run + c) for c in {x for _, t in rows for x in read(t)}) for p in plain.values() for run in ("the", " ka", "")]
    assert max(whole) <= 1.0 + 1e-9


def test_most_frequent_runs_are_kept(spark, monkeypatch):
    rows = [("a", "abab abab cdcd"), ("b", "xy")]
    monkeypatch.setattr(L, "MOST_RUNS", 3)
    counts = Counter(read(rows[0][1])[i : i + 4] for i in range(len(read(rows[0][1])) - 3))
    kept = models_of(spark, rows).levels[-1].runs
    assert 0 < len(kept) <= 6
    least = sorted(counts.values())[-3:][0]
    assert all(c >= least for c in counts.values() if c == max(counts.values()))


@pytest.mark.parametrize("runs, cells", [(40, L.CELLS), (L.MOST_RUNS, 2000)])
def test_runs_that_are_not_sent_count_alike(spark, monkeypatch, runs, cells):
    rng = np.random.default_rng(8)
    pools = {"en": "the cat sat on the mat and that hat was there".split(), "de": "die Katze saß auf der Matte und dieser Hut war da".split(), "fr": "le chat était là sur ce tapis 漢字 \U00020000".split()}
    langs = [["en", "de", "fr"][k % 3] for k in range(400)]
    rows = [(k, " ".join(rng.choice(pools[lang], int(rng.integers(1, 30)))) + ("," if k % 2 else ""), lang) for k, lang in enumerate(langs)]
    rows += [(None, None, "en"), (2**53 + 1, "", None), (1000, "12 .", "de"), (1001, "zzz qqq 漢 die hat", None), (1001, "zzz qqq 漢 die hat", None), (1002, "chat die " * 300, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)

    def found():
        return sorted(([r.doc_id or -1, r.n_chars], r.lang_pred, r.accepted, r.score, r.bits if r.bits is not None else -1) for r in L.identified(df, F.col("doc_id") < 1000).collect())

    want = found()
    monkeypatch.setattr(L, "MOST_RUNS", runs)
    monkeypatch.setattr(L, "CELLS", cells)
    monkeypatch.setattr(L, "CHARS", 50)
    got = found()
    assert len(got) == len(rows) and [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-3) and [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-5)


def test_held_out_accuracy_and_inputs(spark):
    out = queries.op11_language_id(spark, SMALL)
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.accepted for r in rows) >= 0.95 * len(rows)


def test_odd_rows(spark):
    en, de = "the cat and the dog went to the market " * 3, "der Hund und die Katze gingen zum Markt " * 3
    ids = [None, 2**53 + 1, 2**53 + 3]
    learned = [(k, f"{t} {k}x", lang, k) for k, (t, lang) in enumerate([(en, "en"), (de, "de")] * 40)]
    odd = [(i, t, "en", 0) for i, t in zip(ids, [None, "", " 12 .,"])] + [(7, de, "en", 0), (7, de, "en", 0), (8, "der Hund und die Katze gingen " * 40_000, None, 0), (9, "漢字かな", None, 0)]
    df = spark.createDataFrame(learned + odd, "doc_id long, text string, lang string, bits int").coalesce(1)
    rows = L.identified(df, F.col("doc_id") < 100).collect()
    assert len(rows) == len(learned) + len(odd)
    got = [(r.doc_id, r.lang_pred, r.score > 0) for r in rows[len(learned) :]]
    assert got == [(None, "und", False), (ids[1], "und", False), (ids[2], "und", False), (7, "de", True), (7, "de", True), (8, "de", True), (9, got[-1][1], True)]
    nothing = L.identified(df, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert L.identified(df.filter("false"), F.lit(True)).collect() == []
    one = L.identified(df.filter("lang = 'en' AND text IS NOT NULL"), F.lit(True)).collect()
    assert {r.lang_pred for r in one if r.n_chars} == {"en"}


def test_rejection_turns_strange_texts_away(spark):
    rng = np.random.default_rng(2)
    own = [(k, " ".join(rng.choice("the a cat dog sat on mat with and of to in house".split(), 40)), "en") for k in range(1500)]
    strange = [(5000 + k, " ".join("".join(rng.choice(list("qxzjkwv"), 7)) for _ in range(25)), None) for k in range(50)]
    df = spark.createDataFrame(own + strange, "doc_id long, text string, lang string")
    rows = L.identified(df, F.col("doc_id") < 5000).collect()
    assert sum(r.accepted for r in rows if r.doc_id < 5000) >= 1480
    assert not any(r.accepted for r in rows if r.doc_id >= 5000)
