"""Every registered query against its SQL in DuckDB, over whole tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from tidemark.plans import ENTRIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, duck, name):
    ok, text = check.compare(spark, duck, name, SF_DIR)
    assert ok, text


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["customer_id", "window_start", "window_end", "total_fee", "event_count"]
