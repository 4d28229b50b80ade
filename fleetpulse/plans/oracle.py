"""DuckDB SQL equal in meaning to each catalogue query (the correctness oracle).

The stand-in fleets are written as CTEs over the pre-registered tables.
Rounding goes through DECIMAL(28,10) as in ``functions.columns``; shares use a
DOUBLE 100.0; integer sums are cast to BIGINT; NULL order is spelled out.
"""

from __future__ import annotations

from fleetpulse import schema
from fleetpulse.plans.catalog import M1_UNIT, M2_UNIT, M2_URGENT_THRESHOLD


def R(expr: str, k: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,10)), {k}) AS DOUBLE)"


def E(expr: str, k: int) -> str:
    return f"CAST(ROUND_EVEN(CAST({expr} AS DECIMAL(28,10)), {k}) AS DOUBLE)"


def case_label(col: str, labels: dict, otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in labels.items())
    tail = f" ELSE '{otherwise}'" if otherwise is not None else ""
    return f"CASE {whens}{tail} END"


GROUP = schema.LABELS_GROUP
STATUS = schema.LABELS_STATUS
EFFICIENCY = schema.LABELS_EFFICIENCY
SHORT = schema.LABELS_SHORT

GEO = """geo AS (
  SELECT n_nationkey AS nationkey, r_name AS region, n_name AS site
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

M1 = """readings AS (
  SELECT event_id AS reading_id, user_id AS unit_id, CAST(ts AS TIMESTAMP) AS "timestamp",
    value AS avg_temp_c, value / 10 AS pressure_bar, k * 25 AS motor_power_w,
    k / 100 AS vibration_mm_s, 100 - k AS cooling_efficiency_pct, k / 1000 AS cooling_power_kw,
    value / 2 AS flow_rate_l_min,
    CAST(CASE WHEN event_type = 'error' THEN 3 WHEN event_type = 'click' THEN 20 ELSE 100 END
         AS INTEGER) AS cooler_condition,
    CAST(100 - 9 * (event_id % 4) AS INTEGER) AS valve_condition,
    CAST(event_id % 3 AS INTEGER) AS pump_leakage,
    CAST(90 + event_id % 4 AS INTEGER) AS accumulator_bar,
    (event_id % 2 = 0) AS is_stable
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS k FROM events) e),
""" + GEO + """,
units AS (
  SELECT c_custkey AS unit_id, c_name AS unit_code, c_mktsegment AS model, region, site,
    CAST(DATE '2024-01-01' - CAST(180 + 30 * (c_custkey % 20) AS INTEGER) AS DATE) AS install_date
  FROM customer JOIN geo ON c_nationkey = nationkey)"""

M2 = """readings AS (
  SELECT l_orderkey * 8 + l_linenumber AS reading_id, l_suppkey AS unit_id,
    CAST(l_shipdate AS TIMESTAMP) AS "timestamp",
    l_quantity AS avg_temp_c, CAST(NULL AS DOUBLE) AS pressure_bar,
    l_extendedprice AS motor_power_w, l_discount AS vibration_mm_s,
    100 * (1 - l_discount) AS cooling_efficiency_pct, l_tax AS cooling_power_kw,
    CAST(NULL AS DOUBLE) AS flow_rate_l_min,
    CAST(CASE WHEN l_returnflag = 'R' THEN 3 WHEN l_returnflag = 'N' THEN 20
              WHEN l_returnflag = 'A' THEN 100 END AS INTEGER) AS cooler_condition,
    CAST(CASE WHEN l_discount > 0.05 THEN 73 ELSE 100 END AS INTEGER) AS valve_condition,
    CAST(CASE WHEN l_tax > 0.03 THEN 1 ELSE 0 END AS INTEGER) AS pump_leakage,
    CAST(l_linenumber AS INTEGER) AS accumulator_bar, CAST(NULL AS BOOLEAN) AS is_stable
  FROM lineitem),
""" + GEO + """,
units AS (
  SELECT s_suppkey AS unit_id, s_name AS unit_code, 'M-' || CAST(s_suppkey % 4 AS VARCHAR) AS model,
    region, site,
    CAST(DATE '2024-01-01' - CAST(180 + 30 * (s_suppkey % 20) AS INTEGER) AS DATE) AS install_date
  FROM supplier JOIN geo ON s_nationkey = nationkey)"""

JOIN = "FROM readings r JOIN units u ON r.unit_id = u.unit_id"
FAIL = "CAST(SUM(CASE WHEN r.cooler_condition = 3 THEN 1 ELSE 0 END) AS BIGINT)"
# Anomalies from each unit's list of values, unnested again: NULL and NaN never
# enter a list, so they can neither be scored nor move a unit's statistics.
STATS = """scored AS (
  SELECT unit_id, mu, sigma, unnest(items).i AS reading_id, unnest(items).v AS v
  FROM (SELECT unit_id, list_avg(list_transform(items, lambda x: x.v)) AS mu,
               list_stddev_pop(list_transform(items, lambda x: x.v)) AS sigma, items
        FROM (SELECT unit_id, list({'i': reading_id, 'v': avg_temp_c}) FILTER (NOT isnan(avg_temp_c)) AS items
              FROM readings GROUP BY unit_id) AS lists) AS measured
  WHERE sigma > 0),
hits AS (SELECT unit_id, reading_id, mu, sigma, (v - mu) / sigma AS z, abs(v - mu) / sigma AS absz
         FROM scored WHERE abs(v - mu) / sigma > 2.0)"""
ABSZ = "s.absz"
ZJOIN = JOIN + " JOIN hits s ON r.unit_id = s.unit_id AND r.reading_id = s.reading_id"
MOVING = ("AVG(r.avg_temp_c) OVER (PARTITION BY r.unit_id ORDER BY r.\"timestamp\", r.reading_id "
          "ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")


def w(fleet: str, body: str, extra: str = "") -> str:
    ctes = fleet + ((",\n" + extra) if extra else "")
    return f"WITH {ctes}\n{body}"


def _overview(metrics: list[tuple[str, str, int]]) -> str:
    cols = ", ".join(R(f"AVG(r.{m})", k) + f" AS {n}" for n, m, k in metrics)
    return (f"SELECT u.region, COUNT(DISTINCT u.unit_id) AS units, COUNT(*) AS readings, {cols} "
            f"{JOIN} GROUP BY u.region ORDER BY units DESC, u.region")


def _breakdown(labels) -> str:
    return (f"SELECT cooler_condition AS condition_pct, {case_label('cooler_condition', labels)} AS label, "
            "COUNT(*) AS reading_count, "
            + R("COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM readings)", 1)
            + " AS pct_of_total FROM readings GROUP BY cooler_condition "
              "ORDER BY cooler_condition DESC NULLS LAST")


def _site(sep: str, with_condition: bool = True, details: bool = False) -> str:
    head = "u.region, u.site, " if details else ""
    cond = (R("AVG(r.cooler_condition)", 0) + " AS avg_condition, ") if with_condition else ""
    total = "COUNT(*) AS total_readings, " if details else ""
    return (f"SELECT {head}u.region || '{sep}' || u.site AS location, COUNT(DISTINCT u.unit_id) AS units, "
            f"{cond}{FAIL} AS failure_readings, {total}"
            + R(f"{FAIL} * 100.0::DOUBLE / COUNT(*)", 1)
            + f" AS failure_pct {JOIN} GROUP BY u.region, u.site ORDER BY failure_pct DESC, location")


def _zscore(top: int | None, region: bool) -> str:
    reg = "u.region, " if region else ""
    lim = f" LIMIT {top}" if top else ""
    return (f"SELECT u.unit_code, {reg}r.\"timestamp\", {R('r.avg_temp_c', 2)} AS temp_c, "
            f"{R('s.mu', 2)} AS unit_mean, {R('(r.avg_temp_c - s.mu) / s.sigma', 2)} AS z_score, "
            f"r.cooler_condition {ZJOIN} ORDER BY {ABSZ} DESC, r.reading_id{lim}")


def _rank(k: int | None, site: bool = True, failures: bool = False) -> str:
    s = "u.site, " if site else ""
    if failures:
        tail = (R("AVG(r.avg_temp_c)", 1) + " AS avg_temp_c, " + R("AVG(r.motor_power_w)", 0)
                + f" AS avg_power_w, {FAIL} AS failure_readings, COUNT(*) AS total_readings")
    else:
        tail = (R("AVG(r.avg_temp_c)", 1) + " AS avg_temp, " + R("AVG(r.motor_power_w)", 0)
                + " AS avg_power, COUNT(*) AS readings")
    lim = f" LIMIT {k}" if k else ""
    return (f"SELECT u.unit_code, u.model, u.region, {s}" + R("AVG(r.cooler_condition)", 0)
            + f" AS avg_condition, {tail} {JOIN} "
              "GROUP BY u.unit_id, u.unit_code, u.model, u.region, u.site "
              f"ORDER BY avg_condition ASC NULLS FIRST, u.unit_code{lim}")


def _moving(unit: str | None, top: int | None) -> str:
    where = f" WHERE u.unit_code = '{unit}'" if unit else ""
    lim = f" LIMIT {top}" if top else ""
    return (f"SELECT u.unit_code, r.\"timestamp\", {R('r.avg_temp_c', 2)} AS temp_c, "
            f"{R(MOVING, 2)} AS temp_moving_avg, r.cooler_condition {JOIN}{where} "
            f"ORDER BY r.\"timestamp\", r.reading_id{lim}")


def _box() -> str:
    return ("""SELECT f.condition_label, f.metric, f.n, """
            + ", ".join(R(c, 6) + f" AS {a}" for c, a in [
                ("mn", "min"), ("q1", "q1"), ("med", "median"), ("q3", "q3"), ("mx", "max"),
                ("lf", "lower_fence"), ("uf", "upper_fence")])
            + """,
  CAST((SELECT COUNT(*) FROM long l WHERE l.metric = f.metric
        AND l.condition_label IS NOT DISTINCT FROM f.condition_label
        AND (l.value < f.lf OR l.value > f.uf)) AS BIGINT) AS outliers
FROM f ORDER BY f.metric, f.condition_label NULLS FIRST""")


BOX_CTES = ("lab AS (SELECT " + case_label("r.cooler_condition", STATUS)
            + """ AS condition_label, r.avg_temp_c, r.motor_power_w """ + JOIN + """),
long AS (
  SELECT condition_label, 'avg_temp_c' AS metric, CAST(avg_temp_c AS DOUBLE) AS value FROM lab
  WHERE avg_temp_c IS NOT NULL AND NOT isnan(avg_temp_c)
  UNION ALL
  SELECT condition_label, 'motor_power_w', CAST(motor_power_w AS DOUBLE) FROM lab
  WHERE motor_power_w IS NOT NULL AND NOT isnan(motor_power_w)),
s AS (
  SELECT condition_label, metric, COUNT(*) AS n, MIN(value) AS mn, MAX(value) AS mx,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
    quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY condition_label, metric),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lf, q3 + 1.5::DOUBLE * (q3 - q1) AS uf FROM s)""")


def analytics_sql() -> dict[str, str]:
    return {
        "fleet_overview_by_region": w(M2, _overview([
            ("avg_temp", "avg_temp_c", 1), ("avg_power", "motor_power_w", 0),
            ("avg_eff", "cooling_efficiency_pct", 1)])),
        "condition_breakdown": w(M2, _breakdown(EFFICIENCY)),
        "worst_units_topk": w(M2, _rank(10)),
        "condition_temperature_stats": w(M2, (
            f"SELECT {case_label('cooler_condition', GROUP)} AS condition_group, COUNT(*) AS n, "
            + R("AVG(avg_temp_c)", 2) + " AS mean_temp, " + R("MIN(avg_temp_c)", 2)
            + " AS min_temp, " + R("MAX(avg_temp_c)", 2) + " AS max_temp, "
            + R("AVG(motor_power_w)", 1) + " AS mean_power FROM readings "
              "GROUP BY cooler_condition ORDER BY cooler_condition DESC NULLS LAST")),
        "hourly_pattern": w(M1, (
            "SELECT CAST(hour(\"timestamp\") AS INTEGER) AS hour, COUNT(*) AS readings, "
            + R("AVG(avg_temp_c)", 2) + " AS avg_temp, " + R("AVG(motor_power_w)", 1)
            + " AS avg_power, " + R("AVG(cooling_efficiency_pct)", 1)
            + " AS avg_efficiency FROM readings GROUP BY 1 ORDER BY 1")),
        "zscore_anomalies_nan": w(M1.replace("value AS avg_temp_c", "CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS avg_temp_c"),
                                  _zscore(None, True), STATS),
        "readings_enriched": w(M1, f"SELECT r.*, u.unit_code, u.model, u.region, u.site {JOIN}"),
        "zscore_anomalies_topk": w(M1, _zscore(15, False), STATS),
        "condition_power_profile": w(M2, (
            "SELECT cooler_condition, " + R("AVG(motor_power_w)", 1) + " AS avg_power_w, "
            + R("AVG(vibration_mm_s)", 3) + " AS avg_vibration, "
            + R("AVG(cooling_efficiency_pct)", 1) + " AS avg_efficiency, "
            + R("AVG(cooling_power_kw)", 3) + " AS avg_cooling_kw FROM readings "
              "GROUP BY cooler_condition ORDER BY cooler_condition NULLS FIRST")),
        "multi_fault_readings_topk": w(M2, (
            "SELECT u.unit_code, r.\"timestamp\", r.cooler_condition AS cooler, "
            "r.valve_condition AS valve, r.pump_leakage AS pump_leak, r.accumulator_bar AS accum, "
            f"r.avg_temp_c AS temp, r.motor_power_w AS power {JOIN} "
            "WHERE r.cooler_condition < 100 AND r.valve_condition < 100 AND r.pump_leakage > 0 "
            "ORDER BY cooler NULLS FIRST, valve NULLS FIRST, r.unit_id NULLS FIRST, "
            "r.\"timestamp\" NULLS FIRST, pump_leak NULLS FIRST, accum NULLS FIRST, "
            "temp NULLS FIRST, power NULLS FIRST LIMIT 10")),
        "moving_average_unit": w(M1, _moving(M1_UNIT, 20)),
        "moving_average_all_units": w(M1, _moving(None, None)),
        "site_failure_summary": w(M2, _site(" - ")),
        "run_fleet_overview": w(M2, _overview([
            ("avg_temp", "avg_temp_c", 1), ("avg_power", "motor_power_w", 0)])),
        "run_condition_distribution": w(M2, _breakdown(SHORT)),
        "run_worst_units": w(M2, (
            "SELECT u.unit_code, u.model, u.region, " + R("AVG(r.cooler_condition)", 0)
            + " AS avg_condition, " + R("AVG(r.avg_temp_c)", 1) + " AS avg_temp, "
            + R("AVG(r.motor_power_w)", 0) + " AS avg_power, COUNT(*) AS readings "
            + JOIN + " GROUP BY u.unit_id, u.unit_code, u.model, u.region "
              "ORDER BY avg_condition ASC NULLS FIRST, u.unit_code LIMIT 5")),
        "run_healthy_vs_degraded": w(M2, (
            f"SELECT {case_label('cooler_condition', STATUS, 'Failing')} AS status, COUNT(*) AS n, "
            + R("AVG(avg_temp_c)", 2) + " AS mean_temp, " + R("AVG(motor_power_w)", 1)
            + " AS mean_power FROM readings GROUP BY cooler_condition "
              "ORDER BY cooler_condition DESC NULLS LAST")),
        "run_zscore_anomalies": w(M1, _zscore(10, False), STATS),
        "run_site_failure_rate": w(M2, _site(" - ", with_condition=False)),
        "run_moving_average": w(M1, _moving(M1_UNIT, 15)),
    }


def mart_sql() -> dict[str, str]:
    site_details = _site(" — ", details=True)
    return {
        "kpi_fleet": w(M2, (
            "SELECT (SELECT COUNT(*) FROM units) AS total_units, COUNT(*) AS total_readings, "
            "COUNT(DISTINCT CASE WHEN r.cooler_condition = 3 THEN r.unit_id END) AS failing_units, "
            + R("AVG(r.avg_temp_c)", 6) + f" AS avg_temp_c {JOIN}")),
        "region_units_counts": w(M2, (
            "SELECT u.region, COUNT(DISTINCT r.unit_id) AS units, COUNT(*) AS readings "
            f"{JOIN} WHERE u.region IS NOT NULL GROUP BY u.region ORDER BY units DESC, u.region")),
        "condition_value_counts": w(M2, (
            f"SELECT {case_label('r.cooler_condition', GROUP)} AS \"Condition\", COUNT(*) AS \"Count\" "
            f"{JOIN} WHERE r.cooler_condition IN (100, 20, 3) GROUP BY 1 "
            "ORDER BY \"Count\" DESC, \"Condition\"")),
        "maintenance_ranking": w(M2, _rank(None, failures=True)),
        "urgent_units": w(M2, (
            "SELECT COUNT(*) AS urgent_units FROM (SELECT " + R("AVG(r.cooler_condition)", 0)
            + f" AS avg_condition {JOIN} GROUP BY u.unit_id) t "
              f"WHERE avg_condition <= {M2_URGENT_THRESHOLD}")),
        "box_summary_by_condition": w(M2, _box(), BOX_CTES),
        "box_summary_by_condition_events": w(M1, _box(), BOX_CTES),
        "zscore_anomalies_all": w(M1, _zscore(None, True), STATS),
        "anomaly_kpis": w(M1, (
            "SELECT COUNT(*) AS anomalous_readings, COUNT(DISTINCT r.unit_id) AS units_affected, "
            f"CAST(COUNT_IF(r.cooler_condition = 3) AS BIGINT) AS failing_anomalies {ZJOIN}"), STATS),
        "anomaly_points": w(M1, (
            "SELECT u.unit_code, " + R("(r.avg_temp_c - s.mu) / s.sigma", 2) + " AS z_score, "
            + case_label("r.cooler_condition", STATUS) + " AS condition_label, ABS("
            + R("(r.avg_temp_c - s.mu) / s.sigma", 2) + f") AS abs_z {ZJOIN} "
              f"ORDER BY {ABSZ} DESC, r.reading_id"), STATS),
        "hourly_pattern_halfeven": w(M1, (
            "SELECT CAST(hour(r.\"timestamp\") AS INTEGER) AS hour, COUNT(*) AS readings, "
            + E("AVG(r.avg_temp_c)", 2) + " AS avg_temp_c, " + E("AVG(r.motor_power_w)", 2)
            + " AS avg_power_w, " + E("AVG(r.cooling_efficiency_pct)", 2)
            + f" AS avg_efficiency {JOIN} GROUP BY 1 ORDER BY 1")),
        "site_failure_details": w(M2, site_details),
        "site_extremes": w(M2, (
            "SELECT (SELECT location FROM site ORDER BY failure_pct DESC, location DESC LIMIT 1) "
            "AS highest_location, (SELECT MAX(failure_pct) FROM site) AS highest_failure_pct, "
            "(SELECT location FROM site ORDER BY failure_pct ASC, location ASC LIMIT 1) "
            "AS lowest_location, (SELECT MIN(failure_pct) FROM site) AS lowest_failure_pct"),
            f"site AS ({site_details})"),
        "dash_region_summary": w(M2, _overview([
            ("avg_temp_c", "avg_temp_c", 1), ("avg_power_w", "motor_power_w", 0),
            ("avg_efficiency_pct", "cooling_efficiency_pct", 1)])),
        "dash_condition_stats": w(M2, (
            f"SELECT {case_label('cooler_condition', GROUP, 'Failing (3%)')} AS condition_group, "
            "COUNT(*) AS n, " + R("AVG(avg_temp_c)", 2) + " AS mean_temp_c, "
            + R("MIN(avg_temp_c)", 2) + " AS min_temp_c, " + R("MAX(avg_temp_c)", 2)
            + " AS max_temp_c, " + R("AVG(motor_power_w)", 1) + " AS mean_power_w, "
            + R("AVG(cooling_efficiency_pct)", 1) + " AS mean_efficiency_pct FROM readings "
              "GROUP BY cooler_condition ORDER BY cooler_condition DESC NULLS LAST")),
        "dash_power_efficiency": w(M2, (
            "SELECT cooler_condition, " + R("AVG(motor_power_w)", 1) + " AS avg_power_w, "
            + R("AVG(cooling_efficiency_pct)", 1) + " AS avg_efficiency_pct, "
            + R("AVG(vibration_mm_s)", 3) + " AS avg_vibration, "
              "CAST(cooler_condition AS VARCHAR) || '%' AS condition_text FROM readings "
              "GROUP BY cooler_condition ORDER BY cooler_condition NULLS FIRST")),
        "kpi_fleet_text": w(M2, (
            "SELECT format('{:,}', (SELECT COUNT(*) FROM units)) AS total_units, format('{:,}', COUNT(*)) AS total_readings, "
            "format('{:,}', COUNT(DISTINCT CASE WHEN r.cooler_condition = 3 THEN r.unit_id END)) AS failing_units, "
            "format('{:,.1f}', " + R("AVG(r.avg_temp_c)", 1) + f") || ' °C' AS avg_temp_c {JOIN}")),
        "unit_selection_list": w(M2, "SELECT unit_code FROM units ORDER BY unit_id"),
        "unit_profile": w(M2, (
            "SELECT unit_code, model, region, site, install_date FROM units "
            f"WHERE unit_code = '{M2_UNIT}'")),
        "unit_drilldown_series": w(M1, (
            "SELECT r.*, u.unit_code, u.model, u.region, u.site, " + R(MOVING, 6)
            + " AS temp_4pt_avg, " + case_label("r.cooler_condition", STATUS)
            + f" AS cond_label {JOIN} WHERE u.unit_code = '{M1_UNIT}' "
              "ORDER BY r.\"timestamp\", r.reading_id")),
        "unit_kpis": w(M1, (
            "SELECT " + R("AVG(r.cooler_condition)", 6) + " AS avg_condition, "
            + R("AVG(CASE WHEN r.cooler_condition = 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
                "* 100.0::DOUBLE", 6)
            + f" AS failure_pct, COUNT(*) AS total_readings {JOIN} WHERE u.unit_code = '{M1_UNIT}'")),
        "unit_raw_readings": w(M1, (
            "SELECT r.\"timestamp\", r.avg_temp_c, r.pressure_bar, r.motor_power_w, "
            "r.vibration_mm_s, r.cooling_efficiency_pct, r.flow_rate_l_min, r.cooler_condition "
            f"{JOIN} WHERE u.unit_code = '{M1_UNIT}' ORDER BY r.\"timestamp\", r.reading_id")),
    }


STATE_TWINS = (
    "fleet_overview_by_region", "condition_breakdown", "worst_units_topk", "condition_temperature_stats",
    "condition_power_profile", "site_failure_summary", "kpi_fleet", "region_units_counts", "condition_value_counts",
    "maintenance_ranking", "urgent_units", "site_failure_details", "site_extremes", "zscore_anomalies_topk")


def state_sql() -> dict[str, str]:
    rows = (f"WITH {M2}\nSELECT unit_id, CAST(hour(\"timestamp\") AS INTEGER) AS hour, cooler_condition, COUNT(*) AS n, "
            "COUNT(avg_temp_c) AS avg_temp_c_n, " + R("SUM(avg_temp_c)", 3) + " AS avg_temp_c_sum, "
            + R("MIN(avg_temp_c)", 3) + " AS avg_temp_c_min, " + R("MAX(avg_temp_c)", 3) + " AS avg_temp_c_max, "
            + R("VAR_POP(avg_temp_c) * COUNT(avg_temp_c)", 3) + " AS avg_temp_c_m2 FROM readings GROUP BY 1, 2, 3")
    return {"unit_state": rows, "unit_state_merged": rows}


def all_sql() -> dict[str, str]:
    from fleetpulse.plans.etl_catalog import etl_sql
    from fleetpulse.plans.sql_text import FLEET

    out = {}
    out.update(analytics_sql())
    out.update(mart_sql())
    out.update(etl_sql())
    out.update(state_sql())
    out.update({f"state_{twin}": out[twin] for twin in STATE_TWINS})
    # The SQL-text forms mean the same as their DataFrame twins.
    out.update({name: out[twin] for name, (_, twin) in FLEET.items()})
    return out
