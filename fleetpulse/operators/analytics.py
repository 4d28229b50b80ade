"""Fleet analytics (A1–A10): group health, condition profiles, rankings,
hourly patterns, Z-score anomalies, multi-fault readings, moving averages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C
from fleetpulse.operators.aggregates import mean_of, per_unit, unit_mean
from fleetpulse.operators.joins import (attach_units, attach_units_splitting, fits_broadcast, join_small,
                                       join_splitting, restrict_to_units, restrict_to_units_splitting)
from fleetpulse.operators.state import Source, UnitState, condense, unit_moments
from fleetpulse.operators.windows import moving_mean, moving_mean_bounded

# (output name, metric column, decimal places) for the fleet overview.
OVERVIEW_METRICS = [("avg_temp", "avg_temp_c", 1), ("avg_power", "motor_power_w", 0),
                    ("avg_eff", "cooling_efficiency_pct", 1)]


# ------------------------------------------------------------------ A1 / A10
def group_health(readings: Source, units: DataFrame, keys: Sequence[str],
                 metrics=OVERVIEW_METRICS, failures: bool = False,
                 separator: str | None = None, condition_decimals: int = 0) -> DataFrame:
    """Units, readings and rounded means per unit attribute(s).

    ``failures`` adds avg_condition, failure_readings, total_readings and
    failure_pct (share of readings at the failing level, 1 dp); ``separator``
    adds ``location = key1 || separator || key2``.
    """
    cols = [m for _, m, _ in metrics] + (["cooler_condition"] if failures else [])
    partial = attach_units(per_unit(readings, cols), units, columns=tuple(keys))
    # One row per unit here, so counting rows counts units.
    aggs = [F.count("unit_id").alias("units"), F.sum("_n").cast("long").alias("readings")]
    aggs += [C.half_up_round(mean_of(m), k).alias(name) for name, m, k in metrics]
    if failures:
        aggs += [
            C.half_up_round(mean_of("cooler_condition"), condition_decimals).alias("avg_condition"),
            F.sum("_fail").cast("long").alias("failure_readings"),
            C.half_up_round(F.try_divide(F.sum("_fail") * F.lit(100.0),
                                         F.sum("_n").cast("double")), 1).alias("failure_pct"),
        ]
    out = partial.groupBy(*keys).agg(*aggs)
    if separator is not None:
        out = out.withColumn("location", C.location(keys[0], keys[1], separator))
    return out


def fleet_overview_by_region(readings, units, metrics=OVERVIEW_METRICS) -> DataFrame:
    """A1: units, readings, avg temp/power/efficiency per region."""
    out = group_health(readings, units, ["region"], metrics)
    return out.orderBy(F.desc("units"), "region")


def site_failure_summary(readings, units, separator: str = schema.SEPARATOR_SQL,
                         with_condition: bool = True) -> DataFrame:
    """A10: failure count and rate per (region, site)."""
    out = group_health(readings, units, ["region", "site"], metrics=[], failures=True,
                       separator=separator)
    cols = ["location", "units"] + (["avg_condition"] if with_condition else [])
    cols += ["failure_readings", "failure_pct"]
    return out.orderBy(F.desc("failure_pct"), "location").select(*cols)


# ------------------------------------------------------------- A2 / A4 / A7
def condition_breakdown(readings: Source, labels: Mapping[int, str] = schema.LABELS_EFFICIENCY) -> DataFrame:
    """A2: readings per condition level, its label, and its share of all readings.

    The total is a scalar subquery over the grouped counts, so the fact is
    scanned once: the subquery reuses the grouping's shuffle.
    """
    counts = condense(readings, ["cooler_condition"]).select("cooler_condition", F.col("_n").alias("reading_count"))
    total = counts.select(F.sum("reading_count")).scalar()
    return counts.select(
        F.col("cooler_condition").alias("condition_pct"),
        C.condition_label("cooler_condition", labels).alias("label"),
        "reading_count",
        C.half_up_round(F.try_divide(F.col("reading_count") * F.lit(100.0),
                                     total.cast("double")), 1).alias("pct_of_total"),
    ).orderBy(F.desc_nulls_last("condition_pct"))


TEMPERATURE_STATS = [
    ("n", None, None, None),
    ("mean_temp", "avg", "avg_temp_c", 2),
    ("min_temp", "min", "avg_temp_c", 2),
    ("max_temp", "max", "avg_temp_c", 2),
    ("mean_power", "avg", "motor_power_w", 1),
]


def _stat(fn: str, metric: str) -> Column:
    """A statistic of a metric from a row of ``condense``."""
    return unit_mean(metric) if fn == "avg" else F.col(f"_{fn}_{metric}")


def condition_profile(readings: Source, stats=TEMPERATURE_STATS,
                      labels: Mapping[int, str] | None = schema.LABELS_GROUP,
                      else_label: str | None = None, label_name: str = "condition_group",
                      keep_condition: bool = False, descending: bool = True) -> DataFrame:
    """Per-condition statistics, optionally labelled (ELSE label optional)."""
    condition = "cooler_condition"
    grouped = condense(readings, [condition], list(dict.fromkeys(m for _, _, m, _ in stats if m)))
    shown = [F.col("_n").alias(name) if fn is None else C.half_up_round(_stat(fn, metric), k).alias(name)
             for name, fn, metric, k in stats]
    order = F.desc_nulls_last(condition) if descending else F.asc_nulls_first(condition)
    head = [F.col(condition)] if keep_condition else []
    if labels is not None:
        head.append(C.condition_label(condition, labels, else_label).alias(label_name))
    return grouped.orderBy(order).select(*head, *shown)


def condition_temperature_stats(readings, else_label: str | None = None) -> DataFrame:
    """A4: temperature and power by condition level."""
    return condition_profile(readings, TEMPERATURE_STATS, schema.LABELS_GROUP, else_label)


POWER_PROFILE = [
    ("avg_power_w", "avg", "motor_power_w", 1),
    ("avg_vibration", "avg", "vibration_mm_s", 3),
    ("avg_efficiency", "avg", "cooling_efficiency_pct", 1),
    ("avg_cooling_kw", "avg", "cooling_power_kw", 3),
]


def condition_power_profile(readings, stats=POWER_PROFILE) -> DataFrame:
    """Power, vibration, efficiency and cooling power per condition level."""
    return condition_profile(readings, stats, labels=None, keep_condition=True,
                             descending=False)


# ------------------------------------------------------------------ A3 / D4
def rank_units(readings: Source, units: DataFrame, k: int | None = None,
               with_site: bool = True, with_failures: bool = False) -> DataFrame:
    """Units by ascending mean condition (NULL first, ties by unit_code)."""
    metrics = ["cooler_condition", "avg_temp_c", "motor_power_w"]
    cols = ("unit_code", "model", "region", "site")
    ranked = attach_units(per_unit(readings, metrics), units, columns=cols)
    out_cols = [
        "unit_code", "model", "region",
        *(["site"] if with_site else []),
        C.half_up_round(unit_mean("cooler_condition"), 0).alias("avg_condition"),
    ]
    if with_failures:
        out_cols += [
            C.half_up_round(unit_mean("avg_temp_c"), 1).alias("avg_temp_c"),
            C.half_up_round(unit_mean("motor_power_w"), 0).alias("avg_power_w"),
            F.col("_fail").alias("failure_readings"),
            F.col("_n").alias("total_readings"),
        ]
    else:
        out_cols += [
            C.half_up_round(unit_mean("avg_temp_c"), 1).alias("avg_temp"),
            C.half_up_round(unit_mean("motor_power_w"), 0).alias("avg_power"),
            F.col("_n").alias("readings"),
        ]
    out = ranked.select(*out_cols).orderBy(F.asc_nulls_first("avg_condition"), "unit_code")
    return out.limit(k) if k is not None else out


# ----------------------------------------------------------------------- A5
HOURLY_METRICS = [("avg_temp", "avg_temp_c", 2), ("avg_power", "motor_power_w", 1),
                  ("avg_efficiency", "cooling_efficiency_pct", 1)]


def hourly_pattern(readings: Source, metrics=HOURLY_METRICS) -> DataFrame:
    """A5: readings and rounded means per hour of day."""
    out = condense(readings, ["hour"], [m for _, m, _ in metrics])
    return out.select("hour", F.col("_n").alias("readings"),
                      *[C.half_up_round(unit_mean(m), k).alias(name) for name, m, k in metrics]).orderBy("hour")


# ------------------------------------------------------------- A6 / D7 – D9
def unit_stats(readings: DataFrame, metric: str = "avg_temp_c") -> DataFrame:
    """Per-unit count, mean and population std; units with std 0, NULL or NaN are dropped."""
    return (readings.groupBy("unit_id")
            .agg(F.count(metric).alias("n"), F.avg(metric).alias("mu"), F.stddev_pop(metric).alias("sigma"))
            .filter((F.col("sigma") > 0) & ~F.isnan("sigma")))


def scored_readings(readings: DataFrame, units: DataFrame, metric: str = "avg_temp_c",
                    k_sigma: float = schema.ZSCORE_THRESHOLD, stats: DataFrame | None = None) -> DataFrame:
    """Readings of known units whose |z| exceeds ``k_sigma``, with mu and z.

    ``stats`` are the units' statistics, if they are at hand (:func:`unit_stats`).

    The statistics are restricted to units that exist, so they have no more
    rows than the unit table; when that passes the size check they are
    broadcast and the fact is never shuffled.  Otherwise the join splits the
    units that the statistics show to be hot: their readings go to several
    tasks, their statistics to each of these.  A NaN reading is no reading.
    """
    known = readings.filter(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    stats = unit_stats(known, metric) if stats is None else stats
    stats = restrict_to_units(stats, units)
    if fits_broadcast(units.select("unit_id")):
        joined = known.join(F.broadcast(stats.drop("n")), "unit_id")
    else:
        joined = join_splitting(known, stats.drop("n"), "unit_id", "reading_id", stats.select("unit_id", "n"))
    z = C.zscore(metric, "mu", "sigma")
    return (joined.withColumn("_z", z).withColumn("_abs_z", F.abs(F.col("_z")))
            .filter(F.col("_abs_z") > F.lit(k_sigma)))


def _anomaly_columns(metric: str, with_region: bool):
    return [
        "unit_code", *(["region"] if with_region else []), "timestamp",
        C.half_up_round(metric, 2).alias("temp_c"),
        C.half_up_round("mu", 2).alias("unit_mean"),
        C.half_up_round("_z", 2).alias("z_score"),
        "cooler_condition",
    ]


def zscore_anomalies(readings: DataFrame, units: DataFrame, metric: str = "avg_temp_c",
                     k_sigma: float = schema.ZSCORE_THRESHOLD, top: int | None = None,
                     with_region: bool | None = None, state: UnitState | None = None) -> DataFrame:
    """A6 (``top`` set) / D7 (all): per-unit Z-score anomalies by |z| descending.

    With the readings' ``state`` the statistics come from it, and the readings are scanned once.
    """
    with_region = (top is None) if with_region is None else with_region
    hits = scored_readings(readings, units, metric, k_sigma, unit_moments(state, metric) if state else None)
    order = [F.desc("_abs_z"), F.asc("reading_id")]
    if top is not None:
        # Top-k before the unit join: only k rows meet the unit table.
        hits = hits.orderBy(*order).limit(top)
    cols = ("unit_code", "region") if with_region else ("unit_code",)
    out = attach_units(hits, units, columns=cols).orderBy(*order)
    return out.select(*_anomaly_columns(metric, with_region))


def anomaly_kpis(readings: DataFrame, units: DataFrame, metric: str = "avg_temp_c",
                 k_sigma: float = schema.ZSCORE_THRESHOLD) -> DataFrame:
    """Anomalous readings, units affected, anomalies at the failing level.

    Units are counted by ``unit_id``, which is one-to-one with the unique
    ``unit_code`` (constraint checked by the quality job).
    """
    hits = scored_readings(readings, units, metric, k_sigma)
    return hits.agg(
        F.count(F.lit(1)).alias("anomalous_readings"),
        F.count_distinct("unit_id").alias("units_affected"),
        F.count_if(F.col("cooler_condition") == F.lit(schema.FAILING)).alias("failing_anomalies"),
    )


def anomaly_points(readings, units, metric: str = "avg_temp_c",
                   k_sigma: float = schema.ZSCORE_THRESHOLD) -> DataFrame:
    """Unit, z, condition label and |z| for each anomaly."""
    z = zscore_anomalies(readings, units, metric, k_sigma, with_region=False)
    return z.select("unit_code", "z_score",
                    C.condition_label("cooler_condition", schema.LABELS_STATUS).alias("condition_label"),
                    F.abs("z_score").alias("abs_z"))


# ----------------------------------------------------------------------- A8
FAULT_COLUMNS = ["cooler_condition", "valve_condition", "unit_id", "timestamp",
                 "pump_leakage", "accumulator_bar", "avg_temp_c", "motor_power_w"]


def multi_fault(readings: DataFrame, units: DataFrame, top: int | None = 10) -> DataFrame:
    """Readings with cooler and valve degraded and a pump leak.

    Ordered by cooler, valve; ties by the rest of the row, so the top-k set is
    fixed.  The top-k is taken on readings of known units before the join.
    """
    faulty = readings.filter((F.col("cooler_condition") < 100) & (F.col("valve_condition") < 100)
                             & (F.col("pump_leakage") > 0))
    faulty = restrict_to_units_splitting(faulty, units)
    order = [F.asc_nulls_first(c) for c in FAULT_COLUMNS]
    if top is not None:
        faulty = faulty.orderBy(*order).limit(top)
    out = attach_units(faulty, units, columns=("unit_code",)).orderBy(*order)
    return out.select(
        "unit_code", "timestamp",
        F.col("cooler_condition").alias("cooler"), F.col("valve_condition").alias("valve"),
        F.col("pump_leakage").alias("pump_leak"), F.col("accumulator_bar").alias("accum"),
        F.col("avg_temp_c").alias("temp"), F.col("motor_power_w").alias("power"),
    )


# ------------------------------------------------------------------ A9 / W1
def readings_of_unit(readings: DataFrame, units: DataFrame, unit_code: str) -> DataFrame:
    """Readings of the unit(s) with ``unit_code``, found when the query runs.

    The smallest and largest id of the units with that code are scalar
    subqueries over the unit table as it is then; as bounds on the fact they
    reach the Parquet reader, which skips the row groups and pages without
    them (readings are written in order of unit).  The semi-join below any
    window leaves out units in between; only that unit's readings move.
    """
    chosen = units.filter((F.col("unit_code") == F.lit(unit_code)) & F.col("unit_id").isNotNull()).select("unit_id")
    # By order, not min and max: Spark would merge these to one subquery of two fields, which the reader can't take.
    first, last = (chosen.orderBy(order("unit_id")).limit(1).scalar() for order in (F.asc, F.desc))
    near = readings.filter((F.col("unit_id") >= first) & (F.col("unit_id") <= last))
    return join_small(near, chosen, "unit_id", "left_semi")


def moving_average(readings: DataFrame, units: DataFrame, unit_code: str | None = None,
                   rows: int = schema.MOVING_AVERAGE_ROWS, round_to: int | None = 2,
                   top: int | None = None, metric: str = "avg_temp_c",
                   out: str = "temp_moving_avg", ordered: bool | None = None) -> DataFrame:
    """Moving mean of ``metric`` over ``rows`` rows per unit.

    With ``top`` the first ``top`` rows by (timestamp, reading_id) are taken
    before the window: their frames only reach earlier rows of the same unit,
    which are inside that top set, so the result is exact.

    ``ordered`` (default: only for a single unit) sorts the output by time.
    For the whole fleet the rows stay clustered by unit in time order as the
    window leaves them, rather than paying a global sort of the entire fact.
    """
    ordered = (unit_code is not None) if ordered is None else ordered
    columns = ["unit_id", "reading_id", "timestamp", metric, "cooler_condition"]
    if unit_code is None and top is None:
        known = attach_units_splitting(readings.select(*columns), units, columns=("unit_code",))
        shown = moving_mean(known, metric, "_mv", rows)
    else:
        base = (readings_of_unit(readings, units, unit_code) if unit_code is not None
                else restrict_to_units_splitting(readings, units)).select(*columns)
        if top is not None:
            head = base.orderBy("timestamp", "reading_id").limit(top)
            framed = moving_mean_bounded(head, metric, "_mv", rows)
        else:
            framed = moving_mean(base, metric, "_mv", rows)
        shown = attach_units(framed, units, columns=("unit_code",))
    if ordered:
        shown = shown.orderBy("timestamp", "reading_id")
    rnd = (lambda c: C.half_up_round(c, round_to)) if round_to is not None else (lambda c: F.col(c))
    return shown.select(
        "unit_code", "timestamp", rnd(metric).alias("temp_c"), rnd("_mv").alias(out),
        "cooler_condition")

