from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["label", "count", "percentage"]


def test_every_query_has_its_sql_or_a_test_that_stands_for_it():
    named = entry_points.corpus.TESTED_BY if entry_points.corpus else {}
    assert set(entry_points.queries()) == set(entry_points.oracle_sql()) | set(named)
    for place in named.values():
        file, test = place.split("::")
        assert f"def {test}(" in (Path(__file__).parents[1] / file).read_text(), place


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = compare(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict
