"""Per-unit state: what the grouped reports need of a fact, small and mergeable.

One row per unit, hour of day and cooler condition holds the number of readings
and, of each metric, the number of values, their sum, smallest and largest, and
the second moment about their mean.  States of parts of a fact merge to the
state of the whole (:func:`merge`), so a new part needs no second look at the
rest.  A load stores the state of its readings beside them; the reports that
group by unit, region, site, condition or hour read it in place of the
readings (:func:`condense` is what they share), so a batch of them scans the
fact once or, with a stored state, not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C

#: The metrics that reports aggregate.
METRICS = ("avg_temp_c", "motor_power_w", "cooling_efficiency_pct", "vibration_mm_s", "cooling_power_kw")
KEYS = ("unit_id", "hour", "cooler_condition")


@dataclass(frozen=True)
class UnitState:
    """A state table; reports take it wherever they take readings."""

    df: DataFrame


Source = DataFrame | UnitState


def _value(metric: str) -> Column:
    """A metric's value, null if it isn't a number."""
    x = F.col(metric).cast("double")
    return F.when(~F.isnan(x), x)


def unit_state(readings: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The state of ``readings``: one scan, counted in each task before anything moves."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in metrics:
        x = _value(m)
        aggs += [F.count(x).alias(f"{m}_n"), F.sum(x).alias(f"{m}_sum"), F.min(x).alias(f"{m}_min"), F.max(x).alias(f"{m}_max"),
                 (F.var_pop(x) * F.count(x)).alias(f"{m}_m2")]
    return readings.groupBy("unit_id", C.hour_of_day("timestamp").alias("hour"), "cooler_condition").agg(*aggs)


def metrics_of(state: DataFrame) -> list[str]:
    return [c[:-3] for c in state.columns if c.endswith("_m2")]


def _merged(metric: str) -> list[Column]:
    """Number, sum, extremes and second moment of several states together.

    The moments within the states, and those of their means about the common mean.
    """
    n, total, m2 = F.col(f"{metric}_n"), F.col(f"{metric}_sum"), F.col(f"{metric}_m2")
    mean = F.when(n > 0, total / n)
    # Pairs (n, mean) fold into (n, mean, m2) one by one, so large means don't cancel.
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def joined(a: Column, b: Column) -> Column:
        away, both = b["mean"] - a["mean"], a["n"] + b["n"]
        return F.struct(both.alias("n"), (a["mean"] + away * b["n"] / both).alias("mean"),
                        (a["m2"] + b["m2"] + away * away * a["n"] * b["n"] / both).alias("m2"))

    parts = F.array_sort(F.collect_list(F.when(n > 0, F.struct(n.cast("double").alias("n"), mean.alias("mean"), m2.alias("m2")))))
    return [F.sum(n).alias(f"{metric}_n"), F.sum(total).alias(f"{metric}_sum"), F.min(f"{metric}_min").alias(f"{metric}_min"),
            F.max(f"{metric}_max").alias(f"{metric}_max"), F.when(F.sum(n) > 0, F.aggregate(parts, start, joined)["m2"]).alias(f"{metric}_m2")]


def merge(*states: DataFrame) -> DataFrame:
    """The state of all rows that ``states`` are of: a unit, hour and condition has one row per state at most."""
    every = states[0]
    for other in states[1:]:
        every = every.unionByName(other)
    return every.groupBy(*KEYS).agg(F.sum("n").alias("n"), *[a for m in metrics_of(states[0]) for a in _merged(m)])


def condense(source: Source, keys: Sequence[str | Column], metrics: Sequence[str] = ()) -> DataFrame:
    """(keys, _n, _fail, and per metric _s_, _c_, _min_, _max_): counts and sums of readings or of their state.

    ``_fail`` counts readings at the failing level.  Keys are of a state's: unit_id, hour, cooler_condition.
    """
    failing = F.col("cooler_condition") == F.lit(schema.FAILING)
    if isinstance(source, UnitState):
        aggs = [F.sum("n").cast("long").alias("_n"), F.sum(F.when(failing, F.col("n")).otherwise(0)).cast("long").alias("_fail")]
        for m in metrics:
            if m == "cooler_condition":  # a key: its value counts for all readings of the row
                level = F.col(m)
                parts = level * F.col("n"), F.when(level.isNotNull(), F.col("n")), level, level
            else:
                parts = tuple(F.col(f"{m}_{x}") for x in ("sum", "n", "min", "max"))
            aggs += [f(x).alias(f"_{name}_{m}") for f, x, name in zip((F.sum, F.sum, F.min, F.max), parts, ("s", "c", "min", "max"))]
        return source.df.groupBy(*keys).agg(*aggs)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.when(failing, 1).otherwise(0)).cast("long").alias("_fail")]
    for m in metrics:
        aggs += [F.sum(m).alias(f"_s_{m}"), F.count(m).alias(f"_c_{m}"), F.min(m).alias(f"_min_{m}"), F.max(m).alias(f"_max_{m}")]
    hour = C.hour_of_day("timestamp").alias("hour")
    return source.groupBy(*[hour if k == "hour" else k for k in keys]).agg(*aggs)


def unit_moments(state: UnitState, metric: str) -> DataFrame:
    """(unit_id, n, mu, sigma) of a metric, as ``analytics.unit_stats`` has them."""
    n, total, _, _, m2 = _merged(metric)
    per_unit = state.df.groupBy("unit_id").agg(n.alias("n"), total.alias("_sum"), m2.alias("_m2"))
    mean, spread = F.try_divide(F.col("_sum"), F.col("n").cast("double")), F.sqrt(F.try_divide(F.col("_m2"), F.col("n").cast("double")))
    return per_unit.select("unit_id", "n", mean.alias("mu"), spread.alias("sigma")).filter(F.col("sigma") > 0)
