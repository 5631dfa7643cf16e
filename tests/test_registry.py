import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
from paylane.demo import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_every_query_has_a_counterpart():
    assert set(registry.QUERIES) - set(registry.ORACLES) == WITHOUT_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_row_count(spark):
    assert contract.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_duckdb(spark, con, name):
    ok, text = check.compare(spark, con, name, SF)
    assert ok, text
