"""The registered queries: a second engine agrees, contracts hold."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

QUICK = ["cleaning_report", "customer_features", "feature_label_table", "rfm_quintiles", "lift_table", "value_decile_table", "copurchase",
         "retrieve_top_n", "candidate_features", "reco_baselines", "expected_purchases", "regression_metrics"]


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.count() == 150 and df.columns[0] == "customer_id"


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 150


@pytest.mark.parametrize("name", QUICK)
def test_second_engine_agrees(spark, name):
    from verification.compare import compare

    assert compare(spark, SMALL, [name]) == {name: "ok"}
