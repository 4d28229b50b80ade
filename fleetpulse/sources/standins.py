"""Stand-in fleets built on the driver's tables.

The reference's own tables come from a sensor data set that is not present, so
three views map the given tables onto the ``units`` / ``readings`` schema:

* M1 – ``events`` as readings, ``customer ⋈ nation ⋈ region`` as units.
* M2 – ``lineitem`` as readings, ``supplier ⋈ nation ⋈ region`` as units.
* M3 – ``embeddings`` as a cycle matrix (one 64-sample row per cycle).

Each view is a lazy projection of one scan, so Catalyst prunes the columns a
query does not use and pushes its filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C
from fleetpulse.operators.joins import join_small
from fleetpulse.session import temporary_folder
from fleetpulse.sources.tables import read_table


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region → (nationkey, region, site); 25 rows in TPC-H at any scale."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = join_small(nation, region, nation.n_regionkey == region.r_regionkey)
    return geo.select(F.col("n_nationkey").alias("nationkey"),
                      F.col("r_name").alias("region"), F.col("n_name").alias("site"))


def _units(base: DataFrame, geo: DataFrame, key: str, name: str, model, nation: str) -> DataFrame:
    joined = join_small(base, geo, base[nation] == geo.nationkey)
    return joined.select(
        F.col(key).cast("long").alias("unit_id"),
        F.col(name).alias("unit_code"),
        model.alias("model"),
        F.col("region"),
        F.col("site"),
        C.install_date(F.pmod(F.col(key), F.lit(20))).alias("install_date"),
    )


# --------------------------------------------------------------------------- M1
def events_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).try_cast("double")
    eid = F.col("event_id")
    return C.without_nan(ev.select(
        eid.alias("reading_id"),
        F.col("user_id").alias("unit_id"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("value").alias("avg_temp_c"),
        (F.col("value") / 10).alias("pressure_bar"),
        (k * 25).alias("motor_power_w"),
        (k / 100).alias("vibration_mm_s"),
        (F.lit(100) - k).alias("cooling_efficiency_pct"),
        (k / 1000).alias("cooling_power_kw"),
        (F.col("value") / 2).alias("flow_rate_l_min"),
        F.when(F.col("event_type") == "error", 3).when(F.col("event_type") == "click", 20)
        .otherwise(100).cast("int").alias("cooler_condition"),
        (F.lit(100) - F.lit(9) * (eid % 4)).cast("int").alias("valve_condition"),
        (eid % 3).cast("int").alias("pump_leakage"),
        (F.lit(90) + eid % 4).cast("int").alias("accumulator_bar"),
        ((eid % 2) == 0).alias("is_stable"),
    ))


def events_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return _units(cust, _geo(spark, sf_dir), "c_custkey", "c_name",
                  F.col("c_mktsegment"), "c_nationkey")


# --------------------------------------------------------------------------- M2
def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    null_double = F.lit(None).cast("double")
    return C.without_nan(li.select(
        # Not unique: (l_orderkey, l_linenumber) repeats in this data set.
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("reading_id"),
        F.col("l_suppkey").alias("unit_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("l_quantity").alias("avg_temp_c"),
        null_double.alias("pressure_bar"),
        F.col("l_extendedprice").alias("motor_power_w"),
        F.col("l_discount").alias("vibration_mm_s"),
        (F.lit(100) * (F.lit(1) - F.col("l_discount"))).alias("cooling_efficiency_pct"),
        F.col("l_tax").alias("cooling_power_kw"),
        null_double.alias("flow_rate_l_min"),
        F.when(F.col("l_returnflag") == "R", 3).when(F.col("l_returnflag") == "N", 20)
        .when(F.col("l_returnflag") == "A", 100).cast("int").alias("cooler_condition"),
        F.when(F.col("l_discount") > 0.05, 73).otherwise(100).cast("int").alias("valve_condition"),
        F.when(F.col("l_tax") > 0.03, 1).otherwise(0).cast("int").alias("pump_leakage"),
        F.col("l_linenumber").cast("int").alias("accumulator_bar"),
        F.lit(None).cast("boolean").alias("is_stable"),
    ))


def lineitem_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    model = F.concat(F.lit("M-"), F.pmod(F.col("s_suppkey"), F.lit(4)).cast("string"))
    return _units(sup, _geo(spark, sf_dir), "s_suppkey", "s_name", model, "s_nationkey")


# --------------------------------------------------------------------------- M3
# Widths of the ten pseudo-sensors cut from each 64-sample row: different per
# sensor (nothing may depend on one width) and covering every sample.
M3_WIDTHS = [5, 6, 7, 8, 6, 7, 5, 6, 7, 7]
M3_STARTS = [sum(M3_WIDTHS[:i]) for i in range(len(M3_WIDTHS))]


def embedding_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cycle_id, samples ARRAY<DOUBLE>, label INT) from ``embeddings``."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("cycle_id"),
        F.col("embedding").cast("array<double>").alias("samples"),
        F.col("label").cast("int").alias("label"),
    )


def embedding_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (cycle_id, sensor, samples): ten consecutive slices covering the row."""
    m = embedding_matrix(spark, sf_dir)
    slices = F.array(*[
        F.struct(F.lit(name).alias("sensor"),
                 F.slice("samples", start + 1, width).alias("samples"))
        for name, start, width in zip(schema.SENSOR_NAMES, M3_STARTS, M3_WIDTHS)
    ])
    return m.select("cycle_id", F.inline(slices))


def embedding_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cycle_id, labels ARRAY<INT>): the label and four other columns that all differ."""
    m = embedding_matrix(spark, sf_dir)
    cycle = F.col("cycle_id")
    others = [F.lit(100) - F.lit(9) * (cycle % 4), cycle % 3, F.lit(90) + cycle % 5, cycle % 2]
    return m.select("cycle_id", F.array("label", *[c.cast("int") for c in others]).alias("labels"))


def embedding_text(spark: SparkSession, sf_dir: str) -> str:
    """M3 as raw text: a tab-delimited matrix per sensor and one of labels, lines in cycle order.

    Label values are written with a fraction, which reading truncates.
    """
    root = temporary_folder(spark, "raw-text")
    files = {name: file for file, name in schema.SENSOR_FILES}
    samples = embedding_sensors(spark, sf_dir)
    rows = {files[name]: samples.filter(F.col("sensor") == name) for name in schema.SENSOR_NAMES}
    rows[schema.LABEL_FILE] = embedding_labels(spark, sf_dir).select(
        "cycle_id", F.transform("labels", lambda x: x + F.lit(0.25)).alias("samples"))
    for file, matrix in rows.items():
        line = F.array_join(F.transform("samples", lambda x: x.cast("string")), "\t")
        matrix.orderBy("cycle_id").select(line).write.text(f"{root}/{file}")
    return root
