"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from suite.compare import differences

MODELS = {"lr_scores", "rf_scores", "gbt_scores", "rf_cv", "rf_cv_forward", "sampled_control", "model_comparison"}


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, sf_dir, duck, name):
    frame = contract.queries()[name](spark, sf_dir)
    assert differences(frame, duck, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql()) - MODELS))
def test_rows_only(spark, sf_dir, name):
    assert len(contract.queries()[name](spark, sf_dir).collect()) > 0


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
