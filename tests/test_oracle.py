"""Queries match their SQL twins in DuckDB on the smallest driver tables
(row count, column names, order-insensitive values).

A representative subset runs here; ``python tools/oracle_check.py`` runs
every registered twin (the driver's correctness gate) at sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

SQL = entry.oracle_sql()
SUBSET = [
    "bind_panel", "bind_cells", "features_full", "dedup_keep_first", "agg_describe", "agg_histogram",
    "agg_box_by_group", "agg_corr_matrix", "agg_trend", "win_roll3_events", "flag_anomaly", "sort_keys",
    "clean_winsorize", "clean_impute", "recon_exceptions", "join_outer_metrics", "fn_string_norm",
    "grid_unpivot_banded", "grid_positional", "parse_period_label", "src_rename_coerce", "split_chrono",
    "cv_expanding_folds", "ml_rank", "scenario_kpis", "scenario_grid",
]


@pytest.mark.parametrize("name", SUBSET)
def test_matches_oracle(spark, duck, name):
    r = compare(spark, duck, name, entry.queries()[name], SQL[name], SF_SMALL)
    assert r["ok"], r


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())
    assert set(SUBSET) <= set(SQL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "yield_lag1" in df.columns
