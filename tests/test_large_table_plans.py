"""The plans of large tables against DuckDB: chunks of 20 rows make every table large."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

from tidemark.operators.scan import ROWS_SETTING  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
CUT = [
    "running_spend", "features", "cart_write_ttl", "cart_readwrite_ttl", "cart_stale_visible", "counter_rate", "counter_increase",
    "busy_10m", "sequence_gaps", "sequence_disorder", "arrival_disorder", "enrich_rate_asof", "target_down_1m", "fraud_burst_then_large", "journey",
]


@pytest.fixture
def small_chunks(spark):
    spark.conf.set(ROWS_SETTING, "20")
    yield spark
    spark.conf.unset(ROWS_SETTING)


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", CUT)
def test_cut_query(small_chunks, duck, name):
    ok, text = check.compare(small_chunks, duck, name, SF_DIR)
    assert ok, text
