"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    assert entry.entry(spark).columns == ["qid", "rank", "vec_id", "score"]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    status, _, _, note = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert status == "OK" and " type " not in note, f"{status} {note}"
