"""ETL queries (E1–E7) on the driver's tables and their DuckDB SQL.

M3 reads ``embeddings`` as a cycle matrix: ``vec_id`` is the cycle, the 64
samples are cut into ten slices of different widths (5–8, covering the whole
row) that stand for the ten sensors, and the label fills the five profile
columns.  E5 builds the unit dimension for
one unit per supplier; E7 runs the constraint job on both stand-in fleets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import columns as C
from fleetpulse.operators import quality as Q
from fleetpulse.operators import transform as T
from fleetpulse.sources import matrix as M
from fleetpulse.sources import standins as S
from fleetpulse.sources.tables import read_table

ODD_UNITS = 7  # a unit count that does not divide the cycles: remainder dropped


def _n_cycles(spark: SparkSession, sf_dir: str) -> Column:
    """The number of cycles, as a scalar subquery of the query that needs it."""
    return S.embedding_matrix(spark, sf_dir).select(F.count(F.lit(1))).scalar()


def matrix_cycle_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row mean of each cycle's samples (6 dp)."""
    m = S.embedding_matrix(spark, sf_dir)
    return m.select("cycle_id", C.half_up_round(C.row_mean("samples"), 6).alias("mean"))


def block_assignment(n_units: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Contiguous blocks of cycles per unit, remainder dropped."""
        m = S.embedding_matrix(spark, sf_dir).select("cycle_id")
        return T.assign_blocks(m, _n_cycles(spark, sf_dir), n_units).select(
            "cycle_id", "unit_id", "offset", "reading_id")
    return run


def ordinal_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each unit's 15-minute clock."""
    m = S.embedding_matrix(spark, sf_dir).select("cycle_id")
    blocks = T.add_clock(T.assign_blocks(m, _n_cycles(spark, sf_dir)))
    return blocks.select("unit_id", "cycle_id", "timestamp")


def ordinal_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per hour of day for the 7-unit fleet."""
    m = S.embedding_matrix(spark, sf_dir).select("cycle_id")
    blocks = T.add_clock(T.assign_blocks(m, _n_cycles(spark, sf_dir), ODD_UNITS))
    return (blocks.groupBy(C.hour_of_day("timestamp").alias("hour"))
            .agg(F.count(F.lit(1)).alias("readings")).orderBy("hour"))


def cycle_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per cycle (sensor means at 6 dp, label columns)."""
    wide = T.assemble_cycles(T.cycle_means(S.embedding_sensors(spark, sf_dir)),
                             S.embedding_labels(spark, sf_dir))
    sensors = [C.half_up_round(s, 6).alias(s) for s in schema.SENSOR_NAMES]
    return wide.select("cycle_id", *sensors, *schema.PROFILE_COLUMNS, "is_stable")


def unit_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: the unit table of the lineitem fleet, from supplier, nation and region."""
    return S.lineitem_units(spark, sf_dir)


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 from raw text: matrices written as tab-delimited lines, read once, checked, assembled."""
    staged = M.stage_sensor_set(spark, S.embedding_text(spark, sf_dir))
    shape = M.matrix_shape(staged, expected=schema.SENSOR_NAMES + ["profile"])
    return T.to_readings(T.assemble_cycles(staged, None), shape["n_cycles"])


def text_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time stamps written as text and parsed again."""
    text = S.events_readings(spark, sf_dir).select(
        "reading_id", C.timestamp_text(F.date_trunc("second", "timestamp")).alias("text"))
    return text.withColumn("timestamp", C.parse_timestamp("text").cast("timestamp_ntz"))


def etl_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``readings`` table the pipeline produces from the matrix."""
    wide = T.assemble_cycles(T.cycle_means(S.embedding_sensors(spark, sf_dir)),
                             S.embedding_labels(spark, sf_dir))
    return T.to_readings(wide, _n_cycles(spark, sf_dir))


def dq_constraints_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-constraint violations on the events fleet."""
    return Q.check_constraints(S.events_units(spark, sf_dir), S.events_readings(spark, sf_dir))


def dq_constraints_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-constraint violations on the lineitem fleet (its key repeats)."""
    return Q.check_constraints(S.lineitem_units(spark, sf_dir), S.lineitem_readings(spark, sf_dir))


def unit_codes_cycled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A padded code per supplier, models and sites dealt in turn."""
    key = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        key.alias("unit_id"), C.unit_code(key).alias("unit_code"), C.cycled(key, schema.MODELS).alias("model"),
        C.cycled(key, [site for _, site in schema.SITES]).alias("site"))


def etl_queries() -> dict:
    return {
        "matrix_cycle_means": matrix_cycle_means,
        "block_assignment": block_assignment(schema.NUM_UNITS),
        "block_assignment_n7": block_assignment(ODD_UNITS),
        "ordinal_timestamps": ordinal_timestamps,
        "ordinal_hour_counts": ordinal_hour_counts,
        "cycle_assembly": cycle_assembly,
        "unit_dimension": unit_dimension,
        "unit_codes_cycled": unit_codes_cycled,
        "etl_readings": etl_readings,
        "text_readings": text_readings,
        "text_timestamps": text_timestamps,
        "dq_constraints": dq_constraints_events,
        "dq_constraints_lineitem": dq_constraints_lineitem,
    }


# ----------------------------------------------------------------------- SQL
def _R(expr: str, k: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,10)), {k}) AS DOUBLE)"


def _slice(i: int) -> str:
    lo = S.M3_STARTS[i] + 1
    return f"list_avg(list_slice(s, {lo}, {lo + S.M3_WIDTHS[i] - 1}))"


MATRIX = ("m AS (SELECT vec_id AS cycle_id, CAST(embedding AS DOUBLE[]) AS s, "
          "CAST(label AS INTEGER) AS label FROM embeddings)")


LABELS = ("label AS cooler_condition, CAST(100 - 9 * (cycle_id % 4) AS INTEGER) AS valve_condition, "
          "CAST(cycle_id % 3 AS INTEGER) AS pump_leakage, CAST(90 + cycle_id % 5 AS INTEGER) AS accumulator_bar, "
          "(cycle_id % 2 = 0) AS is_stable")


def _blocks(n_units: int) -> str:
    return (MATRIX + f""",
c AS (SELECT COUNT(*) // {n_units} AS cpu FROM embeddings),
b AS (SELECT m.*, cycle_id // cpu + 1 AS unit_id, cycle_id % cpu AS "offset",
             (cycle_id // cpu) * cpu + cycle_id % cpu + 1 AS reading_id,
             TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((cycle_id % cpu) * 15 AS BIGINT))
               AS "timestamp"
      FROM m, c WHERE cpu > 0 AND cycle_id < cpu * {n_units})""")


def _cycled_sql(index: str, values: list) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{index} % {len(values)} + 1]"


def _sensor_means() -> str:
    return ", ".join(f"{_slice(i)} AS {name}" for i, name in enumerate(schema.SENSOR_NAMES))


def _dq(fleet_ctes: str) -> str:
    parts = []
    for c in Q.UNITS_NOT_NULL:
        parts.append(f"SELECT 'units.{c} not null' AS \"check\", "
                     f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS violations FROM units")
    for key, label, table in [("unit_id", "units.unit_id primary key", "units"),
                              ("unit_code", "units.unit_code unique", "units")]:
        parts.append(f"SELECT '{label}', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM "
                     f"(SELECT {key}, COUNT(*) AS n FROM {table} WHERE {key} IS NOT NULL "
                     f"GROUP BY {key} HAVING COUNT(*) > 1) d")
    for c in Q.READINGS_NOT_NULL:
        parts.append(f"SELECT 'readings.{c} not null', "
                     f"CAST(COUNT_IF(\"{c}\" IS NULL) AS BIGINT) FROM readings")
    parts.append("SELECT 'readings.reading_id primary key', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
                 "FROM (SELECT reading_id, COUNT(*) AS n FROM readings WHERE reading_id IS NOT NULL "
                 "GROUP BY reading_id HAVING COUNT(*) > 1) d")
    parts.append("SELECT 'readings.unit_id references units', CAST(COUNT(*) AS BIGINT) "
                 "FROM readings r WHERE r.unit_id IS NOT NULL AND NOT EXISTS "
                 "(SELECT 1 FROM units u WHERE u.unit_id = r.unit_id)")
    return f"WITH {fleet_ctes}\n" + "\nUNION ALL ".join(parts)


def etl_sql() -> dict:
    from fleetpulse.plans.oracle import M1, M2

    temps = " + ".join(_slice(i) for i in range(4))
    metrics = ", ".join(
        _R(_slice(schema.SENSOR_NAMES.index(s)), k) + f" AS {name}"
        for s, name, k in schema.SENSOR_METRICS)
    readings_sql = (
        f"WITH {_blocks(schema.NUM_UNITS)}\n"
        f"SELECT reading_id, unit_id, \"timestamp\", {_R(f'({temps}) / 4', 2)} AS avg_temp_c, "
        f"{metrics}, " + LABELS + " FROM b")
    return {
        "matrix_cycle_means": f"WITH {MATRIX}\nSELECT cycle_id, {_R('list_avg(s)', 6)} AS mean FROM m",
        "block_assignment": f"WITH {_blocks(schema.NUM_UNITS)}\n"
                            "SELECT cycle_id, unit_id, \"offset\", reading_id FROM b",
        "block_assignment_n7": f"WITH {_blocks(ODD_UNITS)}\n"
                               "SELECT cycle_id, unit_id, \"offset\", reading_id FROM b",
        "ordinal_timestamps": f"WITH {_blocks(schema.NUM_UNITS)}\n"
                              "SELECT unit_id, cycle_id, \"timestamp\" FROM b",
        "ordinal_hour_counts": f"WITH {_blocks(ODD_UNITS)}\n"
                               "SELECT CAST(hour(\"timestamp\") AS INTEGER) AS hour, "
                               "COUNT(*) AS readings FROM b GROUP BY 1 ORDER BY 1",
        "cycle_assembly": (
            f"WITH {MATRIX}\nSELECT cycle_id, "
            + ", ".join(_R(_slice(i), 6) + f" AS {n}" for i, n in enumerate(schema.SENSOR_NAMES))
            + ", " + LABELS + " FROM m"),
        "unit_dimension": f"WITH {M2}\nSELECT * FROM units",
        "unit_codes_cycled": (
            "SELECT s_suppkey AS unit_id, format('CLR-{:04d}', s_suppkey + 1) "
            "AS unit_code, " + _cycled_sql("s_suppkey", schema.MODELS) + " AS model, "
            + _cycled_sql("s_suppkey", [site for _, site in schema.SITES]) + " AS site FROM supplier"),
        "text_readings": readings_sql,
        "text_timestamps": f"WITH {M1}\nSELECT reading_id, strftime(date_trunc('second', \"timestamp\"), '%Y-%m-%d %H:%M:%S') AS text, "
                           "CAST(date_trunc('second', \"timestamp\") AS TIMESTAMP) AS \"timestamp\" FROM readings",
        "etl_readings": readings_sql,
        "dq_constraints": _dq(M1),
        "dq_constraints_lineitem": _dq(M2),
    }
