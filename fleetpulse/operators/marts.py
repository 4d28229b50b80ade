"""Dashboard marts (D1–D16): the data behind each dashboard page.

The dashboard works on readings joined with their unit (so readings of an
unknown unit are left out); every mart here keeps that rule, either through
a per-unit partial aggregate restricted to known units or a semi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C
from fleetpulse.operators import analytics as A
from fleetpulse.operators.aggregates import mean_of, per_unit
from fleetpulse.operators.distribution import box_summary
from fleetpulse.operators.joins import attach_units, restrict_to_units, restrict_to_units_splitting
from fleetpulse.operators.state import Source
from fleetpulse.operators.windows import moving_mean

UNROUNDED_DECIMALS = 6  # unrounded means are emitted at 6 dp (engine-independent)


# ------------------------------------------------------------------- D1 – D3
# D1, D3 and D10 reduce the fact per unit (and group) first and restrict those
# rows to known units, so the fact itself never meets a join.


def fleet_kpis(readings: Source, units: DataFrame) -> DataFrame:
    """Units, readings, units with any failing reading, mean temperature."""
    total_units = units.select(F.count(F.lit(1))).scalar()
    partial = restrict_to_units(per_unit(readings, ["avg_temp_c"]), units)
    return partial.agg(
        total_units.alias("total_units"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_readings"),
        F.count_if(F.col("_fail") > 0).alias("failing_units"),
        C.half_up_round(mean_of("avg_temp_c"), UNROUNDED_DECIMALS).alias("avg_temp_c"),
    )


def fleet_kpis_text(readings: Source, units: DataFrame) -> DataFrame:
    """D1 as a page shows it: counts with thousands separators, the temperature to one place with its unit."""
    kpis = fleet_kpis(readings, units)
    return kpis.select(
        *[C.grouped_number(c, 0).alias(c) for c in ("total_units", "total_readings", "failing_units")],
        C.with_suffix(C.grouped_number("avg_temp_c", 1), " °C").alias("avg_temp_c"))


def region_units_counts(readings: Source, units: DataFrame) -> DataFrame:
    """Units and readings per region (NULL regions dropped, as pandas does)."""
    partial = attach_units(per_unit(readings), units, columns=("region",))
    out = (partial.filter(F.col("region").isNotNull()).groupBy("region")
           .agg(F.count("unit_id").alias("units"),  # one row per unit
                F.sum("_n").cast("long").alias("readings")))
    return out.orderBy(F.desc("units"), "region")


def condition_value_counts(readings: Source, units: DataFrame,
                           labels=schema.LABELS_GROUP) -> DataFrame:
    """D3: labelled frequency of cooler conditions, descending (NULL labels dropped)."""
    label = C.condition_label("cooler_condition", labels)
    partial = restrict_to_units(per_unit(readings, keys=["cooler_condition"]), units)
    out = (partial.withColumn("Condition", label).filter(F.col("Condition").isNotNull())
           .groupBy("Condition").agg(F.sum("_n").cast("long").alias("Count")))
    return out.orderBy(F.desc("Count"), "Condition")


# ------------------------------------------------------------------- D4 – D6
def maintenance_ranking(readings, units) -> DataFrame:
    """Every unit by ascending mean condition, with failure and total counts."""
    return A.rank_units(readings, units, k=None, with_failures=True)


def urgent_units(readings: Source, units: DataFrame,
                 threshold: float = schema.URGENT_CONDITION_THRESHOLD) -> DataFrame:
    """Number of units whose rounded mean condition is at most ``threshold``."""
    partial = restrict_to_units(per_unit(readings, ["cooler_condition"]), units)
    rounded = C.half_up_round(
        F.try_divide(F.col("_s_cooler_condition"), F.col("_c_cooler_condition").cast("double")), 0)
    return partial.agg(F.count_if(rounded <= F.lit(threshold)).alias("urgent_units"))


def box_summary_by_condition(readings: DataFrame, units: DataFrame,
                             metrics=("avg_temp_c", "motor_power_w"),
                             labels=schema.LABELS_STATUS) -> DataFrame:
    """Quartiles, fences and outliers of each metric per condition label."""
    known = restrict_to_units_splitting(readings, units)
    labelled = known.withColumn("condition_label", C.condition_label("cooler_condition", labels))
    return box_summary(labelled, "condition_label", list(metrics))


# ----------------------------------------------------------------- D10 – D12
HOURLY_MEANS = [("avg_temp_c", "avg_temp_c"), ("avg_power_w", "motor_power_w"),
                ("avg_efficiency", "cooling_efficiency_pct")]


def hourly_pattern_halfeven(readings: Source, units: DataFrame) -> DataFrame:
    """Hourly counts and means, all rounded to 2 dp half to even."""
    metrics = [m for _, m in HOURLY_MEANS]
    partial = per_unit(readings, metrics, keys=["hour"])
    partial = restrict_to_units(partial, units)
    out = partial.groupBy("hour").agg(
        F.sum("_n").cast("long").alias("readings"),
        *[C.even_round(mean_of(m), 2).alias(name) for name, m in HOURLY_MEANS])
    return out.orderBy("hour")


def site_failure_details(readings: Source, units: DataFrame,
                         separator: str = schema.SEPARATOR_DASHBOARD) -> DataFrame:
    """Per-site table with location, units, failures and totals."""
    out = A.group_health(readings, units, ["region", "site"], metrics=[], failures=True,
                         separator=separator)
    return out.orderBy(F.desc("failure_pct"), "location").select(
        "region", "site", "location", "units", "avg_condition", "failure_readings",
        F.col("readings").alias("total_readings"), "failure_pct")


def site_extremes(site_table: DataFrame) -> DataFrame:
    """Highest and lowest failure-rate site (ties: larger location first)."""
    key = F.struct("failure_pct", "location")
    return site_table.agg(
        F.max_by("location", key).alias("highest_location"),
        F.max("failure_pct").alias("highest_failure_pct"),
        F.min_by("location", key).alias("lowest_location"),
        F.min("failure_pct").alias("lowest_failure_pct"),
    )


# ----------------------------------------------------------------- D13 – D16
def unit_profile(units: DataFrame, unit_code: str) -> DataFrame:
    """One unit's attributes."""
    return units.filter(F.col("unit_code") == F.lit(unit_code)).select(
        "unit_code", "model", "region", "site", "install_date")


def unit_drilldown_series(readings: DataFrame, units: DataFrame, unit_code: str,
                          rows: int = schema.MOVING_AVERAGE_ROWS) -> DataFrame:
    """The unit's full ordered series, a 4-row rolling mean and a label."""
    series = A.readings_of_unit(readings, units, unit_code)
    framed = moving_mean(series, "avg_temp_c", "_mv", rows)
    enriched = attach_units(framed, units)
    return enriched.orderBy("timestamp", "reading_id").select(
        *schema.READING_COLUMNS, "unit_code", "model", "region", "site",
        C.half_up_round("_mv", UNROUNDED_DECIMALS).alias("temp_4pt_avg"),
        C.condition_label("cooler_condition", schema.LABELS_STATUS).alias("cond_label"))


def unit_kpis(readings: DataFrame, units: DataFrame, unit_code: str) -> DataFrame:
    """Mean condition, failing share (percent) and count for one unit."""
    series = A.readings_of_unit(readings, units, unit_code)
    failing = F.when(F.col("cooler_condition") == F.lit(schema.FAILING), 1.0).otherwise(0.0)
    return series.agg(
        C.half_up_round(F.avg("cooler_condition"), UNROUNDED_DECIMALS).alias("avg_condition"),
        C.half_up_round(F.avg(failing) * F.lit(100.0), UNROUNDED_DECIMALS).alias("failure_pct"),
        F.count(F.lit(1)).alias("total_readings"),
    )


RAW_COLUMNS = ["timestamp", "avg_temp_c", "pressure_bar", "motor_power_w", "vibration_mm_s",
               "cooling_efficiency_pct", "flow_rate_l_min", "cooler_condition"]


def unit_raw_readings(readings: DataFrame, units: DataFrame, unit_code: str) -> DataFrame:
    """The unit's raw readings, display columns only, in time order."""
    series = A.readings_of_unit(readings, units, unit_code)
    return series.orderBy("timestamp", "reading_id").select(*RAW_COLUMNS)


def unit_codes(units: DataFrame) -> DataFrame:
    """P10: unit codes in table order (the selection list)."""
    return units.orderBy("unit_id").select("unit_code")

