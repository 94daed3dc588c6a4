"""Monotone regression over score ranges against plain pooling on one list."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.functions.isotonic import fit_isotonic, interpolate


def plain(y, p):
    """(lo, hi, mean) blocks by pooling adjacent violators on one sorted list."""
    blocks = []
    for s in np.unique(p):
        own = y[p == s]
        lo, total, n = s, own.sum(), len(own)
        while blocks and blocks[-1][2] / blocks[-1][3] >= total / n:
            lo, _, t, m = blocks.pop()
            total, n = total + t, n + m
        blocks.append((lo, s, total, n))
    return [(lo, hi, t / n) for lo, hi, t, n in blocks]


def cases():
    rng = np.random.default_rng(11)
    p = rng.random(3000)
    yield "noisy", (rng.random(3000) < p).astype(float), p
    yield "few scores", (rng.random(3000) < 0.4).astype(float), np.round(p, 1)
    yield "falling", 1 - p, p
    yield "rising", p, p
    yield "sawtooth", (p * 8) % 1, p
    yield "one row", np.array([1.0]), np.array([0.5])


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small inputs would be one range otherwise, and borders would go untested."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("name,y,p", list(cases()), ids=[c[0] for c in cases()])
def test_blocks_and_values_equal_plain_pooling(spark, name, y, p):
    rows = spark.createDataFrame(list(zip(map(float, y), map(float, p))), "y double, p double").repartition(8)
    blocks = fit_isotonic(rows, F.col("y"), F.col("p"))
    got, want = sorted(map(tuple, blocks.collect())), plain(y, p)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12) and len(got) == len(want)
    asked = np.r_[np.linspace(-0.2, 1.2, 301), np.full(200, 0.5)]
    scored = interpolate(blocks, spark.createDataFrame([(i, float(a)) for i, a in enumerate(asked)], "id long, p double"), "p", "v").toPandas().sort_values("id")
    knots = sorted({(at, v) for lo, hi, v in want for at in (lo, hi)})
    assert len(scored) == len(asked) and np.allclose(scored["v"], np.interp(asked, *zip(*knots)), atol=1e-9)


def test_missing_scores_and_no_rows(spark):
    rows = spark.createDataFrame([(1.0, None), (None, 0.2), (0.0, float("nan")), (1.0, 0.7)], "y double, p double")
    blocks = fit_isotonic(rows, F.col("y"), F.col("p"))
    assert [tuple(b) for b in blocks.collect()] == [(0.7, 0.7, 1.0)]
    assert sorted(r.v is None for r in interpolate(blocks, rows, "p", "v").collect()) == [False, False, True, True]
    none = fit_isotonic(rows.filter("false"), F.col("y"), F.col("p"))
    assert none.count() == 0 and {r.v for r in interpolate(none, rows, "p", "v").collect()} == {None}
