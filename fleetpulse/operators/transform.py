"""ETL transforms (T1–T12): cycle means, assembly, fleet assignment, clocks.

The whole pipeline is one lazy plan: matrix scans → per-row means (narrow,
the wide sample arrays are dropped before any shuffle) → one shuffle on
``cycle_id`` that assembles a wide row per cycle together with its labels →
block assignment and clock arithmetic (narrow).  No global window, no RDD.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C


def cycle_means(long_df: DataFrame) -> DataFrame:
    """(cycle_id, sensor, mean) – row mean of each sample array, NaN → NULL."""
    return long_df.select("cycle_id", "sensor", C.row_mean("samples").alias("mean"))


def assemble_cycles(means: DataFrame, labels: DataFrame | None,
                    sensors: Sequence[str] = schema.SENSOR_NAMES) -> DataFrame:
    """T4: one wide row per cycle – a column per sensor mean plus the label columns.

    Sensor means and label rows go through a single ``groupBy(cycle_id)``; the
    sensor names are given explicitly, so a missing sensor shows up as NULL
    instead of changing the schema.
    """
    if "labels" in means.columns:  # a staged table already holds the label rows
        rows = means.select("cycle_id", "sensor", "mean", "labels")
    else:
        rows = means.select("cycle_id", "sensor", "mean",
                            F.lit(None).cast("array<int>").alias("labels"))
    if labels is not None:
        rows = rows.unionByName(labels.select(
            "cycle_id", F.lit("profile").alias("sensor"),
            F.lit(None).cast("double").alias("mean"), "labels"))
    with_labels = labels is not None or "labels" in means.columns
    aggs = [F.max(F.when(F.col("sensor") == F.lit(s), F.col("mean"))).alias(s) for s in sensors]
    if with_labels:
        aggs.append(F.max(F.when(F.col("sensor") == F.lit("profile"), F.col("labels"))).alias("labels"))
    wide = rows.groupBy("cycle_id").agg(*aggs)
    if not with_labels:
        return wide
    label_cols = [F.col("labels").getItem(i).cast("int").alias(c)
                  for i, c in enumerate(schema.PROFILE_COLUMNS)]
    stable = (F.col("labels").getItem(len(schema.PROFILE_COLUMNS)) == F.lit(0)).alias("is_stable")
    return wide.select("cycle_id", *sensors, *label_cols, stable)


def metric_columns(wide: DataFrame) -> DataFrame:
    """The seven rounded metrics from the assembled sensor means."""
    temps = [F.col(s) for s in schema.TEMPERATURE_SENSORS]
    avg_temp = sum(temps[1:], temps[0]) / F.lit(len(temps))
    metrics = [C.half_up_round(avg_temp, schema.AVG_TEMP_DECIMALS).alias("avg_temp_c")]
    metrics += [C.half_up_round(s, k).alias(name) for s, name, k in schema.SENSOR_METRICS]
    keep = [c for c in ("cycle_id", *schema.PROFILE_COLUMNS, "is_stable") if c in wide.columns]
    return wide.select(*keep, *metrics)


def assign_blocks(df: DataFrame, n_cycles: int | Column, n_units: int = schema.NUM_UNITS,
                  id_col: str = "cycle_id") -> DataFrame:
    """T5: contiguous blocks of ``n_cycles // n_units`` cycles per unit; rest dropped.

    Adds ``unit_id`` (1-based), ``offset`` (0-based inside the block) and
    ``reading_id`` (S11: insertion order unit-then-offset, i.e. cycle + 1).
    ``n_cycles`` may be a scalar subquery; fewer cycles than units give no rows.
    """
    total = n_cycles if isinstance(n_cycles, Column) else F.lit(n_cycles)
    per_unit = F.floor(total / F.lit(n_units)).cast("long")
    cyc = F.col(id_col)
    idx = F.floor(F.try_divide(cyc, per_unit)).cast("long")
    offset = (cyc - idx * per_unit).cast("long")
    return df.filter((cyc >= 0) & (cyc < per_unit * F.lit(n_units))).select(
        "*", (idx + F.lit(1)).alias("unit_id"), offset.alias("offset"),
        (idx * per_unit + offset + F.lit(1)).alias("reading_id"))


def add_clock(df: DataFrame, start: str = schema.START_TIMESTAMP,
              minutes: int = schema.INTERVAL_MINUTES) -> DataFrame:
    """``timestamp = start + offset × minutes`` (every unit's clock restarts)."""
    return df.withColumn("timestamp", C.ordinal_timestamp("offset", start, minutes))


def build_units(index_df: DataFrame, index_col: str = "unit_idx") -> DataFrame:
    """The unit dimension from 0-based unit indices.

    Codes are zero-padded, models and (region, site) pairs are cycled by
    index, install dates step back 30 days per unit from 180 days before
    the start date.
    """
    i = F.col(index_col).cast("long")
    regions = [r for r, _ in schema.SITES]
    sites = [s for _, s in schema.SITES]
    return index_df.select(
        (i + F.lit(1)).alias("unit_id"),
        C.unit_code(i).alias("unit_code"),
        C.cycled(i, schema.MODELS).alias("model"),
        C.cycled(i, regions).alias("region"),
        C.cycled(i, sites).alias("site"),
        C.install_date(i).alias("install_date"),
    )


def fleet_units(spark: SparkSession, n_units: int = schema.NUM_UNITS) -> DataFrame:
    """The fleet's unit table for ``n_units`` units."""
    return build_units(spark.range(n_units).withColumnRenamed("id", "unit_idx"))


def to_readings(wide: DataFrame, n_cycles: int | Column, n_units: int = schema.NUM_UNITS) -> DataFrame:
    """T5/T6 + T10/T11 on an assembled frame: the ``readings`` table."""
    blocks = add_clock(assign_blocks(metric_columns(wide), n_cycles, n_units))
    cols = []
    for f in schema.READINGS_SCHEMA.fields:
        cols.append((F.col(f.name) if f.name in blocks.columns
                     else F.lit(None)).cast(f.dataType).alias(f.name))
    return C.without_nan(blocks.select(*cols))


def transform(long_df: DataFrame, labels: DataFrame, n_cycles: int,
              n_units: int = schema.NUM_UNITS) -> tuple[DataFrame, DataFrame]:
    """Raw long matrices + labels → (units, readings), lazily."""
    wide = assemble_cycles(cycle_means(long_df), labels)
    readings = to_readings(wide, n_cycles, n_units)
    return fleet_units(long_df.sparkSession, n_units), readings
