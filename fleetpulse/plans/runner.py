"""Batch runner and SQL surface.

* ``readings_enriched`` is the readings joined with four unit attributes (S7);
  ``register_views`` exposes it and the two tables as temporary views, and
  ``load_query`` runs SQL text over given frames without naming any view (S8).
* ``run_batch`` runs named queries in order, writes each result in full as
  Parquet and returns its true row count (S14).  Nothing is brought to the
  driver.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.operators.joins import attach_units_splitting
from fleetpulse.operators.state import UnitState

Report = Callable[[], DataFrame]


def readings_enriched(readings: DataFrame, units: DataFrame) -> DataFrame:
    """Every reading of a known unit, with the unit's code, model, region and site."""
    return attach_units_splitting(readings, units).select(
        *readings.columns, "unit_code", "model", "region", "site")


def register_views(spark: SparkSession, readings: DataFrame, units: DataFrame, prefix: str = "") -> None:
    """Temporary views ``readings``, ``units`` and ``readings_enriched`` (after ``prefix``)."""
    readings.createOrReplaceTempView(f"{prefix}readings")
    units.createOrReplaceTempView(f"{prefix}units")
    readings_enriched(readings, units).createOrReplaceTempView(f"{prefix}readings_enriched")


def load_query(spark: SparkSession, sql: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text over ``frames``, named in braces; the session's views stay as they are."""
    return spark.sql(sql, args=dict(args) if args else None, **frames)


def run_batch(reports: Mapping[str, Report], out_dir: str) -> dict[str, int]:
    """Write each report's whole result to ``<out_dir>/<name>``; its rows by name."""
    rows = {}
    for name, report in reports.items():
        df, path = report(), f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        rows[name] = df.sparkSession.read.schema(df.schema).parquet(path).count()
    return rows


def table_reports(readings: DataFrame, units: DataFrame, unit_code: str = "CLR-0001",
                  state: UnitState | None = None) -> dict[str, Report]:
    """The runner's reports on ``readings`` / ``units`` tables, with the original parameters.

    With the readings' ``state`` the grouped reports read that: all reports
    together then scan the readings once (the anomalies), but for the few row
    groups of the moving average's unit.
    """
    from fleetpulse import schema
    from fleetpulse.operators import analytics as A

    temps, grouped = A.TEMPERATURE_STATS, state or readings
    return {
        "run_fleet_overview": lambda: A.fleet_overview_by_region(grouped, units, A.OVERVIEW_METRICS[:2]),
        "run_condition_distribution": lambda: A.condition_breakdown(grouped, schema.LABELS_SHORT),
        "run_worst_units": lambda: A.rank_units(grouped, units, k=5, with_site=False),
        "run_healthy_vs_degraded": lambda: A.condition_profile(
            grouped, [temps[0], temps[1], temps[4]], schema.LABELS_STATUS, else_label="Failing", label_name="status"),
        "run_zscore_anomalies": lambda: A.zscore_anomalies(readings, units, top=10, state=state),
        "run_site_failure_rate": lambda: A.site_failure_summary(grouped, units, with_condition=False),
        "run_moving_average": lambda: A.moving_average(readings, units, unit_code, top=15),
    }


def main(argv=None) -> int:
    from fleetpulse.plans.catalog import all_queries
    from fleetpulse.session import get_spark

    ap = argparse.ArgumentParser(description="Write the analysis reports of a table directory.")
    ap.add_argument("sf_dir", help="folder of <table>.parquet files, or with --tables an ETL output root")
    ap.add_argument("out_dir", help="folder that gets one Parquet table per report")
    ap.add_argument("--tables", action="store_true", help="sf_dir is an ETL output root")
    ap.add_argument("--master", default=None)
    ap.add_argument("--all", action="store_true", help="every catalogue query")
    args = ap.parse_args(argv)
    spark = get_spark(args.master)
    if args.tables:
        from fleetpulse.operators.sink import read_state, read_tables

        loaded_units, loaded = read_tables(spark, args.sf_dir)
        reports = table_reports(loaded, loaded_units, state=read_state(spark, args.sf_dir))
    else:
        names = [n for n in all_queries() if args.all or n.startswith("run_")]
        reports = {n: (lambda n=n: all_queries()[n](spark, args.sf_dir)) for n in names}
    print(json.dumps(run_batch(reports, args.out_dir)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
