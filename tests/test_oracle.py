"""Every catalogue query against its DuckDB oracle on the driver's tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare_oracle as co  # noqa: E402
from fleet_fixtures import SF_SMALL  # noqa: E402
from fleetpulse.plans.catalog import all_queries  # noqa: E402
from fleetpulse.plans.oracle import all_sql  # noqa: E402

SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return co.duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(all_queries())
    assert SQL.items() <= entry.oracle_sql().items() and all_queries().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    res = co.compare(spark, name, entry.queries()[name], SQL[name], SF_SMALL, con)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["unit_code", "region", "timestamp", "temp_c", "unit_mean", "z_score",
                          "cooler_condition"]
    assert df.count() == 51  # FIXTURES.md §3: 51 anomalies on M1 at sf0.001


def test_expected_stand_in_figures(spark):
    q = entry.queries()
    k = q["anomaly_kpis"](spark, SF_SMALL).first()
    assert tuple(k) == (51, 15, 9)
    assert q["urgent_units"](spark, SF_SMALL).first()[0] == 8
    assert q["unit_raw_readings"](spark, SF_SMALL).count() == 60


NO_BROADCAST = ["fleet_overview_by_region", "zscore_anomalies_all", "multi_fault_readings_topk",
                "kpi_fleet", "condition_value_counts", "hourly_pattern_halfeven",
                "maintenance_ranking", "dq_constraints", "moving_average_all_units"]


@pytest.mark.parametrize("name", NO_BROADCAST)
def test_matches_oracle_beyond_broadcast_bounds(spark, con, name, no_broadcast):
    """The shuffle-join / per-unit paths taken when no side passes the size check."""
    res = co.compare(spark, name, entry.queries()[name], SQL[name], SF_SMALL, con)
    assert res["status"] == "ok", res
