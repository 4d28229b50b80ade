"""Small hand-built fleets and raw matrix files for the tests."""

from __future__ import annotations

import datetime as dt
import os

from fleetpulse import schema

SF_SMALL = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def reading(rid, unit, minutes, temp, cond=100, **kw):
    row = {c: None for c in schema.READING_COLUMNS}
    row.update(reading_id=rid, unit_id=unit, timestamp=START + dt.timedelta(minutes=minutes),
               avg_temp_c=temp, cooler_condition=cond, valve_condition=100, pump_leakage=0,
               accumulator_bar=90, is_stable=True, motor_power_w=100.0,
               cooling_efficiency_pct=50.0)
    row.update(kw)
    return row


def unit(uid, code=None, model="SC-500", region="Auckland", site="Rosedale"):
    return {"unit_id": uid, "unit_code": code or f"CLR-{uid:04d}", "model": model,
            "region": region, "site": site, "install_date": dt.date(2023, 1, 1)}


def _nullable(st):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in st.fields])


def frames(spark, readings, units):
    """Edge tables may break the declared NOT NULLs on purpose: nullable schemas."""
    r = spark.createDataFrame([tuple(x[c] for c in schema.READING_COLUMNS) for x in readings],
                              _nullable(schema.READINGS_SCHEMA))
    u = spark.createDataFrame([tuple(x[c] for c in schema.UNIT_COLUMNS) for x in units],
                              _nullable(schema.UNITS_SCHEMA))
    return r, u


# --------------------------------------------------------------- raw matrices
SENSOR_BASE = {name: 10.0 * (i + 1) for i, name in enumerate(schema.SENSOR_NAMES)}


def zero_sum(width: int, i: int) -> list[float]:
    """A width-long pattern summing to zero (so the row mean is the base)."""
    half = [((i + j) % 5) * 0.25 for j in range(width // 2)]
    pattern = half + [-x for x in half]
    if width % 2:
        pattern.append(0.0)
    return pattern


def write_matrices(root: str, n_cycles: int, widths=(6, 12, 24), labels=None,
                   extra_lines: dict | None = None, shift=None) -> dict:
    """Sensor s, row i holds SENSOR_BASE[s] + i plus a zero-sum pattern.

    Returns {sensor: [row means]}.  ``labels(i)`` gives the 5 profile values;
    ``shift(name, i)`` adds a constant to every sample of that row.
    """
    os.makedirs(root, exist_ok=True)
    means = {}
    for k, (fname, name) in enumerate(schema.SENSOR_FILES):
        width = widths[k % len(widths)]
        lines, means[name] = [], []
        for i in range(n_cycles):
            base = SENSOR_BASE[name] + i + (shift(name, i) if shift else 0.0)
            vals = [base + p for p in zero_sum(width, i)]
            lines.append("\t".join(repr(v) for v in vals))
            means[name].append(sum(vals) / width)
        for pos, text in (extra_lines or {}).get(name, []):
            lines.insert(pos, text)
        with open(os.path.join(root, fname), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    labels = labels or (lambda i: [100 if i % 3 == 0 else (20 if i % 3 == 1 else 3),
                                   100, 0, 130, i % 2])
    with open(os.path.join(root, schema.LABEL_FILE), "w") as fh:
        fh.write("\n".join("\t".join(str(v) for v in labels(i)) for i in range(n_cycles)) + "\n")
    return means
