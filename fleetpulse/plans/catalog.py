"""The named queries: each operator bound to a stand-in fleet.

Every entry is ``fn(spark, sf_dir) -> DataFrame`` over the whole given
tables.  M1 = events fleet, M2 = lineitem fleet, M3 = embeddings matrix (see
``fleetpulse.sources.standins``).  Parameters that the reference fixes for its
own data are set to the stand-in's equivalents: the drilldown unit is the
first unit of each fleet and the "urgent" threshold on M2 is 41 (at 20 no
M2 unit qualifies, which would test nothing).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C
from fleetpulse.operators import analytics as A
from fleetpulse.operators import marts as D
from fleetpulse.operators.state import KEYS, UnitState, merge, unit_state
from fleetpulse.plans.runner import readings_enriched
from fleetpulse.sources import standins as S

M1_UNIT = "Customer#000000000"
M2_UNIT = "Supplier#000000000"
M2_URGENT_THRESHOLD = 41

Query = Callable[[SparkSession, str], DataFrame]


def _m1(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(S.events_readings(spark, sf_dir), S.events_units(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _m2(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(S.lineitem_readings(spark, sf_dir), S.lineitem_units(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _m2_state(fn) -> Query:
    """The query on the fleet's per-unit state in place of its readings."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(UnitState(unit_state(S.lineitem_readings(spark, sf_dir))), S.lineitem_units(spark, sf_dir))
    return run


def _readings_only(fleet, fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fleet(spark, sf_dir))
    return run


def _some_nan(readings: DataFrame) -> DataFrame:
    """The readings with NaN for every 97th temperature."""
    value = F.when(F.col("reading_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("avg_temp_c"))
    return readings.withColumn("avg_temp_c", value)


def analytics_queries() -> dict[str, Query]:
    """A1–A10 (canonical SQL forms) and the runner's shortened variants."""
    return {
        # A1
        "fleet_overview_by_region": _m2(A.fleet_overview_by_region),
        # A2
        "condition_breakdown": _readings_only(S.lineitem_readings, A.condition_breakdown),
        # A3
        "worst_units_topk": _m2(lambda r, u: A.rank_units(r, u, k=10)),
        # A4
        "condition_temperature_stats": _readings_only(
            S.lineitem_readings, A.condition_temperature_stats),
        # A5
        "hourly_pattern": _readings_only(S.events_readings, A.hourly_pattern),
        # A6
        "zscore_anomalies_topk": _m1(lambda r, u: A.zscore_anomalies(r, u, top=15)),
        # A7
        "condition_power_profile": _readings_only(S.lineitem_readings, A.condition_power_profile),
        # A8
        "multi_fault_readings_topk": _m2(lambda r, u: A.multi_fault(r, u, top=10)),
        # A9 and its all-unit form
        "zscore_anomalies_nan": _m1(lambda r, u: A.zscore_anomalies(_some_nan(r), u)),
        "readings_enriched": _m1(readings_enriched),
        "moving_average_unit": _m1(lambda r, u: A.moving_average(r, u, M1_UNIT, top=20)),
        "moving_average_all_units": _m1(lambda r, u: A.moving_average(r, u)),
        # A10
        "site_failure_summary": _m2(A.site_failure_summary),
        # Runner variants (shortened copies run by the batch runner).
        "run_fleet_overview": _m2(lambda r, u: A.fleet_overview_by_region(
            r, u, A.OVERVIEW_METRICS[:2])),
        "run_condition_distribution": _readings_only(
            S.lineitem_readings, lambda r: A.condition_breakdown(r, schema.LABELS_SHORT)),
        "run_worst_units": _m2(lambda r, u: A.rank_units(r, u, k=5, with_site=False)),
        "run_healthy_vs_degraded": _readings_only(
            S.lineitem_readings, lambda r: A.condition_profile(
                r, [A.TEMPERATURE_STATS[0], A.TEMPERATURE_STATS[1], A.TEMPERATURE_STATS[4]],
                schema.LABELS_STATUS, else_label="Failing", label_name="status")),
        "run_zscore_anomalies": _m1(lambda r, u: A.zscore_anomalies(r, u, top=10)),
        "run_site_failure_rate": _m2(lambda r, u: A.site_failure_summary(
            r, u, with_condition=False)),
        "run_moving_average": _m1(lambda r, u: A.moving_average(r, u, M1_UNIT, top=15)),
    }


def mart_queries() -> dict[str, Query]:
    """The dashboard pages' data."""
    return {
        "kpi_fleet": _m2(D.fleet_kpis),
        "region_units_counts": _m2(D.region_units_counts),
        "condition_value_counts": _m2(D.condition_value_counts),
        "maintenance_ranking": _m2(D.maintenance_ranking),
        "urgent_units": _m2(lambda r, u: D.urgent_units(r, u, M2_URGENT_THRESHOLD)),
        "box_summary_by_condition": _m2(D.box_summary_by_condition),
        "box_summary_by_condition_events": _m1(D.box_summary_by_condition),
        "zscore_anomalies_all": _m1(lambda r, u: A.zscore_anomalies(r, u)),
        "anomaly_kpis": _m1(A.anomaly_kpis),
        "anomaly_points": _m1(A.anomaly_points),
        "hourly_pattern_halfeven": _m1(D.hourly_pattern_halfeven),
        "site_failure_details": _m2(D.site_failure_details),
        "site_extremes": _m2(lambda r, u: D.site_extremes(D.site_failure_details(r, u))),
        "unit_profile": lambda spark, d: D.unit_profile(S.lineitem_units(spark, d), M2_UNIT),
        # Dashboard forms of A1, A4 and A7 (other names, ELSE label, efficiency).
        "dash_region_summary": _m2(lambda r, u: A.fleet_overview_by_region(
            r, u, [("avg_temp_c", "avg_temp_c", 1), ("avg_power_w", "motor_power_w", 0),
                   ("avg_efficiency_pct", "cooling_efficiency_pct", 1)])),
        "dash_condition_stats": _readings_only(S.lineitem_readings, lambda r: A.condition_profile(
            r, [("n", None, None, None), ("mean_temp_c", "avg", "avg_temp_c", 2),
                ("min_temp_c", "min", "avg_temp_c", 2), ("max_temp_c", "max", "avg_temp_c", 2),
                ("mean_power_w", "avg", "motor_power_w", 1),
                ("mean_efficiency_pct", "avg", "cooling_efficiency_pct", 1)],
            schema.LABELS_GROUP, else_label="Failing (3%)")),
        "dash_power_efficiency": _readings_only(S.lineitem_readings, lambda r: A.condition_power_profile(
            r, [("avg_power_w", "avg", "motor_power_w", 1),
                ("avg_efficiency_pct", "avg", "cooling_efficiency_pct", 1),
                ("avg_vibration", "avg", "vibration_mm_s", 3)]).withColumn(
            "condition_text", C.with_suffix("cooler_condition"))),
        "kpi_fleet_text": _m2(D.fleet_kpis_text),
        "unit_selection_list": lambda spark, d: D.unit_codes(S.lineitem_units(spark, d)),
        "unit_drilldown_series": _m1(lambda r, u: D.unit_drilldown_series(r, u, M1_UNIT)),
        "unit_kpis": _m1(lambda r, u: D.unit_kpis(r, u, M1_UNIT)),
        "unit_raw_readings": _m1(lambda r, u: D.unit_raw_readings(r, u, M1_UNIT)),
    }


def _state_rows(state: DataFrame) -> DataFrame:
    """The state's counts and the moments of one metric, rounded."""
    m = "avg_temp_c"
    return state.select(*KEYS, "n", f"{m}_n", *[C.half_up_round(f"{m}_{x}", 3).alias(f"{m}_{x}") for x in ("sum", "min", "max", "m2")])


def _merged_halves(readings: DataFrame) -> DataFrame:
    """The state merged from those of two halves of the readings."""
    half = F.pmod(F.xxhash64("reading_id"), F.lit(2))
    return _state_rows(merge(*[unit_state(readings.filter(half == k), ["avg_temp_c"]) for k in (0, 1)]))


def state_queries() -> dict[str, Query]:
    """The per-unit state, and the grouped reports read from it."""
    def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
        readings, units = S.events_readings(spark, sf_dir), S.events_units(spark, sf_dir)
        return A.zscore_anomalies(readings, units, top=15, state=UnitState(unit_state(readings, ["avg_temp_c"])))

    return {
        "unit_state": _readings_only(S.lineitem_readings, lambda r: _state_rows(unit_state(r))),
        "unit_state_merged": _readings_only(S.lineitem_readings, _merged_halves),
        "state_fleet_overview_by_region": _m2_state(A.fleet_overview_by_region),
        "state_condition_breakdown": _m2_state(lambda s, u: A.condition_breakdown(s)),
        "state_worst_units_topk": _m2_state(lambda s, u: A.rank_units(s, u, k=10)),
        "state_condition_temperature_stats": _m2_state(lambda s, u: A.condition_temperature_stats(s)),
        "state_condition_power_profile": _m2_state(lambda s, u: A.condition_power_profile(s)),
        "state_site_failure_summary": _m2_state(A.site_failure_summary),
        "state_kpi_fleet": _m2_state(D.fleet_kpis),
        "state_region_units_counts": _m2_state(D.region_units_counts),
        "state_condition_value_counts": _m2_state(D.condition_value_counts),
        "state_maintenance_ranking": _m2_state(D.maintenance_ranking),
        "state_urgent_units": _m2_state(lambda s, u: D.urgent_units(s, u, M2_URGENT_THRESHOLD)),
        "state_site_failure_details": _m2_state(D.site_failure_details),
        "state_site_extremes": _m2_state(lambda s, u: D.site_extremes(D.site_failure_details(s, u))),
        "state_zscore_anomalies_topk": zscore,
    }


def all_queries() -> dict[str, Query]:
    from fleetpulse.plans.etl_catalog import etl_queries
    from fleetpulse.plans.sql_text import sql_queries

    out = {}
    out.update(analytics_queries())
    out.update(mart_queries())
    out.update(state_queries())
    out.update(etl_queries())
    out.update(sql_queries())
    return out
