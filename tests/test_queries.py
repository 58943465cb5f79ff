"""Every registered query against its SQL, and the contract of the entry module."""

import __spark_entry__ as entry
import pytest
from oracle import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["volume_id", "tilt_idx", "num_rays", "ray", "gate", "q"] and frame.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_round_trip_of_files(spark, sf_dir):
    rows = QUERIES["rda_round_trip"](spark, sf_dir).collect()
    assert rows and all(r["files"] > 0 and r["different"] == 0 for r in rows)
