"""Queries whose results SQL states, against that SQL; and that every operator is there."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from millrace.llm.queries import ORACLES, QUERIES
from tests.compare import assert_same, connect


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) > 0
