"""Every registered query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from bedside.operators.slices import SLICE_ROWS

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# one query per scan-based operator, run again with every series cut into slices
SLICED = [
    "W1_reset_epochs", "W3_state_runs", "A1_parameter_times", "W4_threshold_alarms", "W9_sensor_off_codes",
    "W21_cardiac_alarms", "A17_drift_alerts", "J1_cuff_pairs", "J4_activity_grid", "J15_time_axis",
    "J15_sequence_of_time", "A23_robust_spread", "W8_device_islands", "W13_merged_intervals",
    "W14_marks_to_intervals", "U11_on_off_delays", "U8_beat_similarity", "W12_gap_fill", "A22_collected_results",
    "J10_optical", "J10_pressure",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_twin(spark, con, name):
    ok, _, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok is not False, note


@pytest.mark.parametrize("name", SLICED)
def test_matches_twin_when_sliced(spark, con, name):
    spark.conf.set(SLICE_ROWS, "4")
    try:
        ok, _, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    finally:
        spark.conf.unset(SLICE_ROWS)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
