"""The subpackage's queries against their SQL, and the entry points."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
import corpus_pipeline
from plimsoll.llm.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry_has_every_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry_module.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert entry_module.queries()["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(entry_module.oracle_sql())
