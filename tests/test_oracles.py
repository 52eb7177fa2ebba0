"""Every registered query against the SQL that states its result."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from millrace.registry import ORACLES, QUERIES
from tests.compare import assert_same, connect

# Row counts known independently of both engines' answers to the same question.
KNOWN_ROWS = {
    "scan_parquet": 15_000,
    "filter_sql": 3_943,
    "dedupe_latest": 45_832,
    "dedupe_noop": 60_000,
    "dq_notnull": 14_845,
    "dq_regex": 14_551,
    "dq_cascade_valid": 13_816,
    "dq_cascade_reject": 780,
    "dq_flag_valid": 14_216,
    "dq_flag_reject": 784,
    "reject_union": 433,
    "rejects_partitioned": 1_568,
    "curated_merge": 15_000,
    "merge_whole_table": 15_000,
    "full_load_own_stamp": 15_000,
    "full_load_rejects_by_hour": 155,
    "full_load_cascade": 13_816,
    "full_load": 26_186,
    "full_load_rejects": 13_104,
    "incremental_load": 45_832,
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    rows = assert_same(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert rows > 0
    if sf_dir.endswith("sf0.01") and name in KNOWN_ROWS:
        assert rows == KNOWN_ROWS[name]


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert "order_key" in df.columns
