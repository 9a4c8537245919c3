"""Registered queries against DuckDB. A sample by default, all with TIFFIN_ALL=1."""

import os
from pathlib import Path

import pytest
from compare import check, connect

from tiffin.catalog import ORACLE, QUERIES

ROOT = Path("/root/testdata/sf0.001")
SAMPLE = ["d06_fct_orders", "d07_fct_deliveries", "d19_shifts_merged", "d20_order_cents",
          "d13_orders_shell", "a16_tie_out", "j09_fee_precedence_asof", "m04_scd2_snapshot",
          "u03_quarantine", "w09_largest_remainder", "k04_vector_top_k", "m01_upsert",
          "t05_change_feed_to_silver", "a18_scores", "q05_one_accepted_broken"]
KEYS = sorted(QUERIES) if os.environ.get("TIFFIN_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("key", KEYS)
def test_matches(spark, con, key):
    from __spark_entry__ import queries
    ok, note, _ = check(spark, con, key, queries()[key], ORACLE.get(key), ROOT)
    assert ok, note
