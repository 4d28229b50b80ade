"""Table schemas and the fixed domain values of the fleet model."""

from __future__ import annotations

from pyspark.sql import types as T

UNITS_SCHEMA = T.StructType(
    [
        T.StructField("unit_id", T.LongType(), False),
        T.StructField("unit_code", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("site", T.StringType(), False),
        T.StructField("install_date", T.DateType(), False),
    ]
)

READINGS_SCHEMA = T.StructType(
    [
        T.StructField("reading_id", T.LongType(), False),
        T.StructField("unit_id", T.LongType(), False),
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("avg_temp_c", T.DoubleType(), True),
        T.StructField("pressure_bar", T.DoubleType(), True),
        T.StructField("motor_power_w", T.DoubleType(), True),
        T.StructField("vibration_mm_s", T.DoubleType(), True),
        T.StructField("cooling_efficiency_pct", T.DoubleType(), True),
        T.StructField("cooling_power_kw", T.DoubleType(), True),
        T.StructField("flow_rate_l_min", T.DoubleType(), True),
        T.StructField("cooler_condition", T.IntegerType(), True),
        T.StructField("valve_condition", T.IntegerType(), True),
        T.StructField("pump_leakage", T.IntegerType(), True),
        T.StructField("accumulator_bar", T.IntegerType(), True),
        T.StructField("is_stable", T.BooleanType(), True),
    ]
)

READING_COLUMNS = [f.name for f in READINGS_SCHEMA.fields]
UNIT_COLUMNS = [f.name for f in UNITS_SCHEMA.fields]

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Sensor matrices (file name, short name); the last is the label matrix.
SENSOR_FILES = [
    ("TS1.txt", "ts1"),
    ("TS2.txt", "ts2"),
    ("TS3.txt", "ts3"),
    ("TS4.txt", "ts4"),
    ("PS1.txt", "ps1"),
    ("EPS1.txt", "eps1"),
    ("VS1.txt", "vs1"),
    ("CE.txt", "ce"),
    ("CP.txt", "cp"),
    ("FS1.txt", "fs1"),
]
LABEL_FILE = "profile.txt"
SENSOR_NAMES = [name for _, name in SENSOR_FILES]
TEMPERATURE_SENSORS = ["ts1", "ts2", "ts3", "ts4"]

# Single-sensor metrics: (sensor, output column, decimal places).
SENSOR_METRICS = [
    ("ps1", "pressure_bar", 2),
    ("eps1", "motor_power_w", 1),
    ("vs1", "vibration_mm_s", 3),
    ("ce", "cooling_efficiency_pct", 1),
    ("cp", "cooling_power_kw", 3),
    ("fs1", "flow_rate_l_min", 2),
]
AVG_TEMP_DECIMALS = 2

# Label matrix columns in file order; the fifth is the stable flag (0 = stable).
PROFILE_COLUMNS = ["cooler_condition", "valve_condition", "pump_leakage", "accumulator_bar"]

NUM_UNITS = 20
START_TIMESTAMP = "2024-01-01 00:00:00"
START_DATE = "2024-01-01"
INTERVAL_MINUTES = 15
INSTALL_BASE_DAYS = 180
INSTALL_STEP_DAYS = 30
UNIT_CODE_FORMAT = "CLR-%04d"

# (region, site) pairs cycled over units, then the models cycled over units.
SITES = [
    ("Auckland", "Rosedale"),
    ("Auckland", "Ponsonby"),
    ("Auckland", "Newmarket"),
    ("Wellington", "CBD"),
    ("Wellington", "Petone"),
    ("Christchurch", "Riccarton"),
    ("Christchurch", "Airport"),
    ("Hamilton", "The Base"),
    ("Hamilton", "Chartwell"),
    ("Dunedin", "George St"),
]
MODELS = ["SC-500", "DC-800", "OD-1200", "MC-300"]

# Cooler condition levels and the label sets used by the reports.
FAILING = 3
LABELS_EFFICIENCY = {100: "Full efficiency", 20: "Reduced efficiency", 3: "Near failure"}
LABELS_SHORT = {100: "Full", 20: "Reduced", 3: "Failing"}
LABELS_GROUP = {100: "Healthy (100%)", 20: "Reduced (20%)", 3: "Failing (3%)"}
LABELS_STATUS = {100: "Healthy", 20: "Reduced", 3: "Failing"}

SEPARATOR_SQL = " - "
SEPARATOR_DASHBOARD = " — "

ZSCORE_THRESHOLD = 2.0
MOVING_AVERAGE_ROWS = 4
URGENT_CONDITION_THRESHOLD = 20
