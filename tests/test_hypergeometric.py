"""The hypergeometric term against sums of 60 digits."""

from decimal import Decimal, localcontext

import numpy as np
import pytest

from basketspark.functions.hypergeometric import hyp2f1
from basketspark.operators import value


def summed(p, q, c, y):
    with localcontext() as ctx:
        ctx.prec = 60
        p, q, c, z = Decimal(p), Decimal(q), Decimal(c), 1 - Decimal(y)
        term = total = Decimal(1)
        n = 0
        while n < 40 or abs(term) > abs(total) * Decimal(10) ** -30:
            term *= (p + n) * (q + n) / ((c + n) * (n + 1)) * z
            total += term
            n += 1
        return float(total)


def test_values_agree_with_long_sums():
    cases = [
        (a + b - 1 - r, a - 1, a + b - 1 + x, y)
        for a, b, r in [(0.8, 2.5, 0.25), (0.05, 0.3, 2.0), (3.5, 4.0, 0.7), (1.25, 2.0, 0.25)]  # the last: whole exponents at one
        for x in (0, 1, 7, 12, 500) for y in (1.0, 0.9, 0.5, 0.3, 0.004)
    ]
    np.testing.assert_allclose(hyp2f1(*np.array(cases).T), [summed(*c) for c in cases], rtol=1e-12)


@pytest.mark.parametrize("y", [1e-3, 1e-6, 1e-9, 1e-12, 1e-300])
def test_values_close_to_one(y):
    # 2F1(1, 1; 2; z) = -log(1 - z) / z and 2F1(-s, 1; 1; z) = (1 - z)^s
    np.testing.assert_allclose(hyp2f1(1, 1, 2, y), -np.log(y) / (1 - y), rtol=1e-10)
    np.testing.assert_allclose(hyp2f1(-0.01, 1, 1, y), y**0.01, rtol=1e-10)


def test_undefined_values_end():
    assert np.isnan(hyp2f1([1, 1, np.nan], [1, 1, 1], [0, -1, 2], [0.3, 0.7, 0.5])).all() and len(hyp2f1([], [], [], [])) == 0


def test_every_customer_has_an_expectation(spark):
    params = value.PurchaseParams(0.25, 1e-7, 0.8, 2.5)  # so small a scale puts the term next to one
    rows = [(1, 1.0, 0.0, 0.0), (2, 2.0, 1e-6, 1e-6), (3, 3.0, 200.0, 300.0), (4, 400.0, 300.0, 300.0)]
    inputs = spark.createDataFrame(rows, "customer_id long, x double, t_x double, t_total double")
    found = {r.customer_id: r.direct_purchases for r in value.expected_purchases(inputs, params).collect()}
    assert all(found[k] is not None and found[k] > 0 for k in found)
    r, a, b = params.r, params.a, params.b
    t, days = 300.0, float(value.WINDOW_DAYS)
    y = (params.alpha + t) / (params.alpha + t + days)
    term = summed(r + 3, b + 3, a + b + 2, y)  # the untransformed term
    gone = a / (b + 2) * ((params.alpha + t) / (params.alpha + 200)) ** (r + 3)
    assert found[3] == pytest.approx((a + b + 2) / (a - 1) * (1 - term * y ** (r + 3)) / (1 + gone), rel=1e-9)
