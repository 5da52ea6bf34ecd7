"""Every registered query against its oracle SQL on the driver tables."""

import os

import pytest
from compare import compare

import __spark_entry__ as entry
from packwatch.operators.keyed import HOT_ROWS_SETTING

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
# queries whose operators treat keys with many rows in another way
SLICED = [
    "tukey_quartiles",
    "pack_exception_report",
    "class_state_limits",
    "charge_last_n",
    "charge_end_pattern",
    "cell_histogram",
    "current_histogram",
    "spread_trend",
    "resistance_drop",
    "resistance_windows",
    "bms_windows",
    "signal_functions",
    "self_discharge",
    "bms_inputs",
    "stream_last_n",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    assert compare(spark, FOLDER, name, entry.queries()[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", SLICED)
def test_equals_oracle_with_hot_keys(spark, name):
    spark.conf.set(HOT_ROWS_SETTING, "20")
    try:
        assert compare(spark, FOLDER, name, entry.queries()[name], ORACLES[name]) == ""
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
