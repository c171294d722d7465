"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_module
import suite
from suite.compare import compare, duck
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(suite.ORACLES))
def test_query_equals_sql(spark, con, name):
    verdict, n_rows = compare(spark, con, name, DATA)
    assert verdict == "ok"
    assert n_rows > 0


def test_every_query_has_sql():
    assert set(suite.QUERIES) == set(suite.ORACLES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(suite.QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["split", "speaker_id", "n"]
    test = [(r.speaker_id, r.n) for r in result.where("split = 'test'").collect()]
    assert sorted(test) == [("de_src10", 1), ("de_src11", 1)]
