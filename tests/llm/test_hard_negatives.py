"""Hard negatives against a plain search over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>, n int, v string"


def plain(rows, anchors, positives=5, negatives=10, low=30, high=90):
    taken = {(i, label, tuple(math.floor(256 * x) for x in e)) for i, label, e in rows}
    out = []
    for i, label, q in taken:
        if not anchors(i):
            continue
        scored = sorted((-sum(map(int.__mul__, q, v)), j, other) for j, other, v in taken if j != i)
        for s, p, other in [x for x in scored if x[2] == label][:positives]:
            found = [(j, -t) for t, j, o in scored if o != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, p, k + 1, j, -s, t) for k, (j, t) in enumerate(found)]
    return sorted(set(out))


def mined(spark, rows, **parameters):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0, **parameters).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 7))
    x = centres[rng.integers(0, 6, 400)] + rng.normal(size=(400, 7)) * 0.2
    x[50:90] = x[50]  # equal vectors: ties
    x[100:120] = 0
    ids = [*range(398), 2**53 + 1, 2**53 + 3]
    return [(i, int(rng.integers(0, 4)), e.tolist()) for i, e in zip(ids, x)]


@pytest.mark.parametrize("cell, block, group, step", [(256, 2048, 256, 16), (8, 7, 11, 2)])
def test_equals_plain_search(spark, rows, monkeypatch, cell, block, group, step):
    for name, value in (("CELL", cell), ("BLOCK", block), ("GROUP", group), ("STEP", step)):
        monkeypatch.setattr(H, name, value)
    odd = [(None, 1, [1.0] * 7), (10, None, [1.0] * 7), (20, 1, None), (30, 1, [1.0, None, *[0.0] * 5]), (40, 2, [math.nan] * 7), (50, 2, [math.inf] * 7), (60, 1, []), (70, 1, [1.0])]
    rows = [*rows, rows[10], rows[10], (20, 3, [0.5] * 7)]  # rows alike, and another row of an anchor's id
    assert mined(spark, [*rows, *odd]) == plain(rows, lambda i: i % 10 == 0)


def test_empty_and_single(spark, rows):
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == []
    few = rows[:12]
    assert mined(spark, few, low=0, high=100, positives=50, negatives=50) == plain(few, lambda i: i % 10 == 0, 50, 50, 0, 100)


def test_one_component_and_large_values(spark):
    rows = [(i, i % 2, [float(i) * 1e5]) for i in range(40)]  # scores beyond 2**53
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(0, 1, [1e9, 1e9]), (1, 1, [1e9, 1e9])])


def test_certified_windows_leave_cells_unread(spark, rows, monkeypatch, tmp_path):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(500, 8)) * 0.05 + c for c in 4 * rng.normal(size=(12, 8))])
    df = spark.createDataFrame([(i, i // 1000, e.tolist(), 0, "") for i, e in enumerate(x)], SCHEMA)
    books, blocks, half, d, exact = H.build_index(H.usable(df, 256), H.Written(spark, "test"))
    index = H.Index(books, blocks.toPandas(), half, d, exact)
    assert sum(b[2] for b in index.blocks) == len(x)
    read, real = [], index.read
    index.read = lambda b: (read.append(index.blocks[b][2]), real(b))[1]
    ids, labels, v = np.array([3]), np.array([0]), np.floor(256 * x[[3]]).astype(np.int64)
    out = H.mine(index, ids, labels, v, 5, 10, 30, 90)
    assert sum(read) < 2 * len(x) and len(out)
    walk, seen = H.Walk(index, v[0].astype(float)), []
    while walk.heap:
        bound = walk.bound()
        for cell in walk.cells(-np.inf):
            for b in range(index.cells[cell], index.cells[cell + 1]):
                lo, hi = walk.span(index, cell, b)
                s = real(b)[2] @ v[0]
                assert lo <= s.min() and s.max() <= min(hi, bound + 1e-3)
                seen.append(b)
    assert sorted(seen) == list(range(len(index.blocks)))
