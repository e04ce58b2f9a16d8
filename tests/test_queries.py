"""Every registered query against its SQL, and the driver contract."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from plimsoll.plans.oracles import ORACLES
from plimsoll.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns == [
        "category", "severity_tier", "support_pos", "precision", "recall", "f1", "roc_auc", "pr_auc"]
